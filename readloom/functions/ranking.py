"""Running numbers and totals over groups that may hold most of the rows.

A plain ``row_number() OVER (PARTITION BY g ORDER BY k)`` sorts each group in
one task. Here every group is first cut into key ranges; rows are numbered per
range and the range totals, a few hundred rows per group, are added on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.session import written


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    out: str = "n",
    ranges: int | None = None,
) -> DataFrame:
    """1-based number of each row within its group, in ``order``.

    The rows are dealt out by range of (group, order) and stored once, so that
    both steps see the same ranges: a group of a third of all rows is spread
    over a third of them. The ranges only decide how the work is split, the
    numbers are exact for any choice. ``order`` must identify a row within its
    group. ``ranges``: how many, by default as many as the session shuffles into.
    """
    group, order = list(group), list(order)
    key = [F.col(c) for c in (*group, *order)]
    dealt = df.repartitionByRange(*([ranges] if ranges else []), *key)
    cut = written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    cell = [*group, "_range"]
    local = cut.withColumn("_local", F.row_number().over(W.partitionBy(*cell).orderBy(*order)))
    # a group has at most one row per range here
    before = W.partitionBy(*group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*cell)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"o.{c}")) for c in cell]
    joined = local.alias("l").join(offsets.alias("o"), same)
    return joined.select(
        *[F.col(f"l.{c}") for c in df.columns],
        (F.col("l._local") + F.col("o._offset")).alias(out))


def first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of every group.

    Spark turns the filtered ``row_number`` into a group limit that runs before
    the shuffle as well, so a task sends at most ``n`` rows per group.
    """
    w = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)
