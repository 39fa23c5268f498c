"""Contiguous shards of near equal size, by global prefix sums of byte sizes.

Rows are put in one global order (digest of the text, then id), so that equal
texts lie together. The order is dealt out in ranges; each range's totals are
added up before it, which gives every row its global offset, and the offsets
are cut at equal targets. So a shard differs from the target by less than the
largest row, and each cut parts one group of equal texts at most.

Only narrow rows (ids, numbers, digest) are shuffled, never a text. The range
key ends with the row's id, so a group of equal texts of any size is spread
over ranges. The ranges are stored under the shared folder before they are
added up: a lost executor cannot deal them out anew.

Null text: size ``overhead``, checksum 0, a group of its own. Rows repeated in
full keep a slot each. An empty table gives an empty result; more shards than
rows leave shards empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.session import written

SHARDS = 24
OVERHEAD = 8


def text_digest(text: str = "text") -> Column:
    """MD5 of the text; a null text stands apart from an empty one."""
    return F.coalesce(F.md5(F.col(text).cast("binary")), F.lit(""))


def byte_size(text: str = "text", overhead: int = OVERHEAD) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead)


def offsets(df: DataFrame, order: list[str], size: str, ranges: int) -> DataFrame:
    """All columns, with ``row_at`` and ``byte_at``: rows and bytes before the row in the global order."""
    dealt = (df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
             .withColumn("range_no", F.spark_partition_id()).withColumn("range_row", F.monotonically_increasing_id()))
    dealt = written(dealt, "ranges")
    totals = dealt.groupBy("range_no").agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"))
    before = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = totals.select("range_no", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
                           F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"))
    inside = Window.partitionBy("range_no").orderBy("range_row")
    here = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.withColumn("row_at", F.row_number().over(inside) - 1)
            .withColumn("byte_at", F.coalesce(F.sum(size).over(here), F.lit(0)))
            .join(F.broadcast(starts), "range_no")  # one row per range
            .withColumn("row_at", F.col("row_at") + F.col("rows_before"))
            .withColumn("byte_at", F.col("byte_at") + F.col("bytes_before"))
            .drop("range_no", "range_row", "rows_before", "bytes_before"))


def assign_shards(df: DataFrame, row_id: str = "doc_id", text: str = "text", shards: int = SHARDS,
                  overhead: int = OVERHEAD, ranges: int | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row.

    ``slot`` counts from 0 without gaps inside a shard. ``law`` is ``bytes``.
    ``ranges``: into how many ranges the order is dealt (the session's shuffle
    partitions if not given); the result does not depend on it.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(row_id).alias("doc_id"), byte_size(text, overhead).alias("size"),
                     F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
                     text_digest(text).alias("digest"))
    placed = written(offsets(rows, ["digest", "doc_id"], "size", ranges), "offsets")
    total = placed.agg(F.sum("size")).first()[0] or 1
    cut = placed.withColumn("shard", F.expr(f"int(byte_at * {shards} div {total})"))
    first = cut.groupBy("shard").agg(F.min("row_at").alias("first_row"))  # one row per shard
    return (cut.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("row_at") - F.col("first_row")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
