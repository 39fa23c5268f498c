"""File listings, checksums and annotation files."""

from __future__ import annotations

import time
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions.ranking import number_rows
from readloom.functions.shipping import ship
from readloom.functions.stores import store_of
from readloom.functions.text import file_name
from readloom.session import scratch_path, written


ship(__name__)


def list_artifacts(spark: SparkSession, root: str | list[str], glob: str | None = None) -> DataFrame:
    """``(path, size, mtime)`` of a tree; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``(name, size, md5, url, valid)``; short lines are kept and marked."""
    rows = spark.read.option("sep", "\t").option("header", "true").schema(
        "name string, size string, md5 string, url string").csv(path)
    return rows.withColumn("size", F.col("size").try_cast("bigint")).withColumn(
        "valid", F.col("url").isNotNull())


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    def digest(uri: str) -> tuple[str | None, str | None]:
        md5 = hashlib.md5()
        try:
            store, path = store_of(uri)
            with store.open_input_stream(path, compression=None) as f:
                while chunk := f.read(1 << 22):
                    md5.update(chunk)
        except OSError as e:
            return None, str(e)
        return md5.hexdigest(), None

    for batch in batches:
        found = [digest(uri) for uri in batch["path"]]
        yield batch.assign(md5=[m for m, _ in found], error=[e for _, e in found])


def file_checksums(spark: SparkSession, root: str | list[str], glob: str | None = None) -> DataFrame:
    """``(path, size, md5, error, name)`` of every file.

    The listing is dealt out by path and every file is streamed in chunks, so
    its size is not limited by the size of a row. A file that cannot be read
    has no digest and says why in ``error``.
    """
    files = list_artifacts(spark, root, glob).select("path", "size").repartition("path")
    return files.mapInPandas(_digests, "path string, size bigint, md5 string, error string").withColumn(
        "name", file_name(F.col("path")))


MANIFEST_SCHEMA = "path string, size bigint, mtime timestamp, md5 string, error string"


def dealt_by_size(files: DataFrame, parts: int) -> DataFrame:
    """The files in ``parts`` partitions of about the same number of bytes: by size, back and forth.

    A file is read by one task, so the largest ones go to different tasks first.
    """
    ranked = number_rows(files.withColumn("_less", -F.col("size")), [], ["_less", "path"], "_rank").drop("_less")
    turn = F.pmod(F.col("_rank") - 1, F.lit(2 * parts)).cast("int")
    return ranked.repartitionById(parts, F.when(turn < parts, turn).otherwise(2 * parts - 1 - turn)).drop("_rank")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, size, mtime, md5, error)`` of the last run of ``update_manifest``; empty before the first."""
    versions = spark.read.schema("version bigint, target string").option("recursiveFileLookup", "true")
    try:
        last = versions.json(f"{folder}/versions").orderBy(F.col("version").desc()).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    if last is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(last.target)


def update_manifest(
    spark: SparkSession, root: str | list[str], folder: str, glob: str | None = None, parts: int | None = None
) -> DataFrame:
    """``(path, size, mtime, md5, error, state)`` of every file; only new and changed ones are read.

    ``folder`` holds what earlier runs found. A file with the path, size and time of its entry is
    ``unchanged`` and keeps its digest; others are ``new`` or ``changed``; entries without a file are ``gone``.
    A file that could not be read is tried again next time. The result becomes the manifest when all of it is
    written; a run that is cut off leaves the last one in place. Runs on one folder come one after another.
    """
    parts = parts or spark.sparkContext.defaultParallelism
    known = read_manifest(spark, folder)
    listing = written(list_artifacts(spark, root, glob).distinct(), "listing")
    old = known.where("md5 is not null").select("path", F.col("size").alias("old_size"), F.col("mtime").alias("old_mtime"), "md5")
    met = written(listing.join(old, "path", "full"), "manifest-join")
    same = (F.col("size") == F.col("old_size")) & (F.col("mtime") == F.col("old_mtime"))
    state = (F.when(F.col("size").isNull(), "gone").when(F.col("old_size").isNull(), "new")
             .when(same, "unchanged").otherwise("changed"))
    judged = met.withColumn("state", state).withColumn("error", F.lit(None).cast("string"))
    kept = judged.where(F.col("state").isin("unchanged", "gone")).select(
        "path", F.coalesce("size", "old_size").alias("size"), F.coalesce("mtime", "old_mtime").alias("mtime"), "md5", "error", "state")
    todo = judged.where(F.col("state").isin("new", "changed")).select("path", "size", "mtime", "state")
    read = dealt_by_size(todo, parts).mapInPandas(_digests, "path string, size bigint, mtime timestamp, state string, md5 string, error string")
    found = written(kept.unionByName(read), "manifest")
    target = scratch_path(spark, "manifest-version")
    found.where("state <> 'gone'").select("path", "size", "mtime", "md5", "error").write.parquet(target)
    versions = spark.range(1).select(F.lit(time.time_ns()).alias("version"), F.lit(target).alias("target"))
    versions.coalesce(1).write.mode("append").json(f"{folder}/versions")
    return found


GTF_SCHEMA = (
    "chrom string, source string, feature string, start bigint, end bigint, "
    "score string, strand string, frame string, attributes string"
)


def gtf_attribute(name: str):
    return F.regexp_extract("attributes", rf'{name}\s+"([^"]+)"', 1)


def read_gtf(
    spark: SparkSession, path: str, features: tuple[str, ...] = ("exon", "transcript")
) -> DataFrame:
    """Annotation rows with 0-based starts; rows of transcripts without an id are dropped."""
    rows = (
        spark.read.option("sep", "\t").option("comment", "#").option("quote", "").schema(GTF_SCHEMA)
        .csv(path)
        .select("*", F.struct(F.col("_metadata.file_block_start").alias("offset"),
                              F.monotonically_increasing_id().alias("seq")).alias("line_no"))
    )
    kept = rows.where(F.col("feature").isin(list(features)) & F.col("attributes").isNotNull())
    return kept.select(
        "line_no", "chrom", "feature", (F.col("start") - 1).alias("start"), "end", "strand",
        gtf_attribute("transcript_id").alias("transcript_id"),
        gtf_attribute("gene_id").alias("gene_id"),
        gtf_attribute("gene_name").alias("gene_name"),
    ).where("transcript_id <> ''")
