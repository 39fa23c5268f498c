"""File listings: mate pairing, storage forecast, checksums, expected artifacts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions import text as T

GIB = 1024**3


def compression_mix(listing: DataFrame, by: str = "project_id") -> DataFrame:
    """Gzip and plain read files per project; both kinds together are a warning."""
    gz = F.lower("path").endswith(".gz")
    return listing.groupBy(by).agg(
        F.count_if(gz).alias("n_gzip"), F.count_if(~gz).alias("n_plain")
    ).withColumn("mixed", (F.col("n_gzip") > 0) & (F.col("n_plain") > 0))


def fastq_files(listing: DataFrame) -> DataFrame:
    """Read files of a listing with their sample and mate."""
    path = F.col("path")
    return listing.where(T.file_name(path).rlike(T.FASTQ_ENDING)).select(
        "*",
        T.fastq_sample(path).alias("sample_id"),
        T.fastq_mate(path).alias("mate"),
        T.has_mate_mark(path).alias("marked"),
    )


def pair_files(listing: DataFrame) -> DataFrame:
    """One row per sample: first and second mate, size in GiB, extra files.

    Of several files for one mate the largest path is kept; ``n_conflicts``
    counts the others. Sizes are summed over the kept mates.
    """
    files = fastq_files(listing)
    one, two = F.col("mate") == "R1", F.col("mate") == "R2"
    picked = F.struct("path", "size")
    grouped = files.groupBy("sample_id").agg(
        F.max(F.when(one, picked)).alias("m1"),
        F.max(F.when(two, picked)).alias("m2"),
        (F.greatest(F.count_if(one) - 1, F.lit(0)) + F.greatest(F.count_if(two) - 1, F.lit(0)))
        .alias("n_conflicts"),
        F.bool_or("marked").alias("marked"),
    )
    size = F.coalesce(F.col("m1.size"), F.lit(0)) + F.coalesce(F.col("m2.size"), F.lit(0))
    return grouped.select(
        "sample_id", F.col("m1.path").alias("r1"), F.col("m2.path").alias("r2"),
        (size / GIB).alias("size_gib"), "n_conflicts", "marked")


def read_type(pairs: DataFrame) -> DataFrame:
    """One row: ``paired-end`` if any file carried a mate marker."""
    return pairs.agg(
        F.when(F.coalesce(F.bool_or("marked"), F.lit(False)), "paired-end")
        .otherwise("single-end").alias("read_type"),
        F.count("*").alias("n_samples"))


def dataset_summary(listing: DataFrame) -> DataFrame:
    """One row on the read files: files, folders, samples, clashes, GiB, read type.

    More than one folder, or a clash of names, calls for a sample sheet.
    """
    path = F.col("path")
    files = listing.where(T.file_name(path).rlike(T.FASTQ_ENDING)).agg(
        F.count("*").alias("n_files"),
        F.countDistinct(F.regexp_replace(path, "/?[^/]*$", "")).alias("n_folders"))
    samples = pair_files(listing).agg(
        F.count("*").alias("n_samples"),
        F.coalesce(F.sum("n_conflicts"), F.lit(0)).cast("bigint").alias("n_conflicts"),
        F.coalesce(F.sum("size_gib"), F.lit(0.0)).alias("size_gib"),
        F.when(F.coalesce(F.bool_or("marked"), F.lit(False)), "paired-end")
        .otherwise("single-end").alias("read_type"))
    both = files.unionByName(samples, True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def sample_names(listing: DataFrame, ending: str = "_1.fastq.gz") -> DataFrame:
    """Distinct samples behind the first-mate files."""
    name = T.file_name(F.col("path"))
    return listing.where(name.endswith(ending)).select(
        F.substr(name, F.lit(1), F.length(name) - len(ending)).alias("sample_id")
    ).distinct()


def storage_forecast(
    listing: DataFrame, factor: float = 5, cores: int = 8, by: str = "project_id"
) -> DataFrame:
    """Input and expected output GiB per project, with a range of hours.

    ``factor`` 5 is the output estimate, 4 the free space asked for before a run.
    """
    n, parallel = F.count("*"), max(1, cores // 2)
    batches = F.ceil(F.col("n_samples") / parallel)
    return listing.groupBy(by).agg(
        n.alias("n_files"),
        F.countDistinct("sample_id").alias("n_samples"),
        (F.sum("size") / GIB).alias("input_gib"),
    ).withColumn("output_gib", F.col("input_gib") * factor).withColumn(
        "hours_min", batches * 0.5).withColumn(
        "hours_max", batches * 1.0).withColumn(
        "cores", F.least(F.lit(cores).cast("bigint"), F.col("n_samples") * 2))


def checksum_audit(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``(name, status)``: OK, MISMATCH, MISSING, SKIP for ``N/A``, EXTRA for unlisted files.

    ``actual(name, md5)``, ``expected(name, md5)``.
    """
    a = actual.select("name", F.col("md5").alias("found"))
    e = expected.select("name", F.col("md5").alias("wanted"), F.lit(True).alias("listed"))
    both = e.join(a, "name", "full_outer")
    return both.select(
        "name",
        F.when(F.col("listed").isNull(), "EXTRA")
        .when(F.col("wanted") == "N/A", "SKIP")
        .when(F.col("found").isNull(), "MISSING")
        .when(F.lower("found") == F.lower("wanted"), "OK")
        .otherwise("MISMATCH").alias("status"))


def artifact_records(listing: DataFrame, expected: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Outputs found per sample: ``(sample_id, artifact, path, size_bytes, modified, description)``.

    ``expected`` holds ``(artifact, path ending, description)``. The endings are
    tested row by row, without a join.
    """
    path = F.col("path")
    kinds = F.array(*[
        F.when(path.endswith(ending),
               F.struct(F.lit(name).alias("artifact"), F.lit(text).alias("description")))
        for name, ending, text in expected])
    return listing.select(
        "sample_id", "path", F.col("size").alias("size_bytes"), F.col("mtime").alias("modified"),
        F.explode(F.array_compact(kinds)).alias("k"),
    ).select("sample_id", "k.artifact", "path", "size_bytes", "modified", "k.description")


def completion(samples: DataFrame, records: DataFrame) -> DataFrame:
    """``completed`` where a sample has any output, else ``incomplete``."""
    seen = records.groupBy("sample_id").agg(F.count("*").alias("n_outputs"))
    return samples.select("sample_id").join(seen, "sample_id", "left").select(
        "sample_id", F.coalesce("n_outputs", F.lit(0)).alias("n_outputs"),
        F.when(F.col("n_outputs") > 0, "completed").otherwise("incomplete").alias("status"))


def artifact_audit(expected: DataFrame, listing: DataFrame, on: list[str]) -> DataFrame:
    """Every expected artifact as present, critical_missing or optional_missing.

    ``expected`` has ``critical``; copies of a file in the listing count once.
    """
    seen = listing.groupBy(*on).agg(F.count("*").alias("n_files"), F.max("size").alias("size"))
    return expected.join(seen, on, "left").withColumn(
        "state",
        F.when(F.col("n_files").isNotNull(), "present")
        .when(F.col("critical"), "critical_missing").otherwise("optional_missing"))


def audit_summary(audited: DataFrame) -> DataFrame:
    """One row: pass, fail, warn and the whole-number success rate."""
    state = F.col("state")
    return audited.agg(
        F.count_if(state == "present").alias("n_pass"),
        F.count_if(state == "critical_missing").alias("n_fail"),
        F.count_if(state == "optional_missing").alias("n_warn"),
        F.count("*").alias("n_total"),
    ).withColumn("success_rate", F.expr("(n_pass * 100) div nullif(n_total, 0)"))


def sizes_by_directory(listing: DataFrame, directory: Column | str = "directory") -> DataFrame:
    """Bytes per top directory, largest first, with a readable size."""
    return listing.groupBy(directory).agg(F.sum("size").alias("size")).withColumn(
        "readable", T.readable_size(F.col("size"))).orderBy(F.desc("size"), directory)


def path_validation(named: DataFrame, listing: DataFrame) -> DataFrame:
    """``(name, path, exists)``."""
    seen = listing.select("path").distinct().withColumn("_seen", F.lit(True))
    return named.join(seen, "path", "left").select(
        "name", "path", F.coalesce("_seen", F.lit(False)).alias("exists"))


def newest(listing: DataFrame, by: str = "run") -> DataFrame:
    """Newest file per run."""
    return listing.groupBy(by).agg(
        F.max_by("path", F.struct("mtime", "path")).alias("path"), F.max("mtime").alias("mtime"))
