"""Text file sets as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.functions.text import path_part
from readloom.session import broadcast_if_small


def read_lines(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """``(file, pos, line)`` for every line of a file set.

    Big files stay split over tasks. ``pos`` orders the lines of a file: the
    byte offset of the split, then the order within it.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("offset"),
                 F.monotonically_increasing_id().alias("seq")).alias("pos"),
        F.col("value").alias("line"),
    )


def read_texts(
    spark: SparkSession, path: str | list[str], glob: str | None = None, recursive: bool = True
) -> DataFrame:
    """``(file, text)``, one row per file; for reports and logs of a few MB at most."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def lines_of(texts: DataFrame, *ids: str) -> DataFrame:
    """``(ids, pos, line)`` from whole texts."""
    return texts.select(*ids, F.posexplode(F.split("text", r"\r?\n")).alias("pos", "line"))


def folder_name(file: Column, position: int = -2) -> Column:
    """Sample id from the folder of a file."""
    return path_part(file, position)


def number_lines(lines: DataFrame) -> DataFrame:
    """Adds the 0-based ``line_no`` within the file.

    Lines are counted per split, and the few splits of a file are summed up.
    """
    split = lines.withColumn("_split", F.col("pos.offset"))
    sizes = split.groupBy("file", "_split").agg(
        F.count("*").alias("_n"), F.min("pos.seq").alias("_first"))
    before = W.partitionBy("file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    starts = broadcast_if_small(starts, "line-starts")
    # lines of one split are consecutive in one task, so their ids are too
    return split.join(starts, ["file", "_split"]).withColumn(
        "line_no", F.col("_base") + F.col("pos.seq") - F.col("_first")
    ).drop("_split", "_base", "_first")


def spread_lines(lines: DataFrame, scan: DataFrame) -> DataFrame:
    """Lines of a few files that cannot be split (or are small) over all cores; no shuffle when their ``scan`` has enough tasks.

    They are dealt by their place; round-robin would sort them first.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return lines.repartition(cores, "file", "pos") if scan.rdd.getNumPartitions() < cores else lines


def spread(df: DataFrame) -> DataFrame:
    """Rows of a few unsplittable files over all cores; no shuffle when the scan has enough tasks.

    For row-wise work that costs much more than moving the rows once.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
