"""Trimming and alignment logs: labelled lines to one row per sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.functions import text as T
from readloom.sources.text import read_lines

# Labels of the logs.
TRIM_LABELS = {
    "total_pairs": "Total read pairs processed",
    "too_short": "Pairs that were too short",
    "passed": "Pairs written (passing filters)",
    "total_bp": "Total basepairs processed",
}
ALIGN_LABELS = {
    "total_reads": ("Number of input reads", "count"),
    "uniquely_mapped_reads": ("Uniquely mapped reads number", "count"),
    "uniquely_mapped_pct": ("Uniquely mapped reads %", "percent"),
    "multi_mapped_reads": ("Number of reads mapped to multiple loci", "count"),
    "multi_mapped_pct": ("% of reads mapped to multiple loci", "percent"),
    "unmapped_too_short": ("Number of reads unmapped: too short", "count"),
    "unmapped_too_short_pct": ("% of reads unmapped: too short", "percent"),
    "read_length": ("Average input read length", "count"),
    "mismatch_rate": ("Mismatch rate per base, %", "percent"),
}
REPORT_LABELS = {
    "input_reads": ("Number of input reads", "count"),
    "unique_mapped": ("Uniquely mapped reads number", "count"),
    "unique_mapped_pct": ("Uniquely mapped reads %", "percent"),
    "multi_mapped": ("Number of reads mapped to multiple loci", "count"),
    "multi_mapped_pct": ("% of reads mapped to multiple loci", "percent"),
    "unmapped_short": ("Number of reads unmapped: too short", "count"),
    "unmapped_short_pct": ("% of reads unmapped: too short", "percent"),
}
MONITOR_LABELS = {
    "uniquely_mapped_pct": "Uniquely mapped reads %",
    "multi_mapped_pct": "% of reads mapped to multiple loci",
    "unmapped_too_short_pct": "% of reads unmapped: too short",
    "total_reads": "Number of input reads",
}


def _last(value: Column, when: Column, pos: str = "pos") -> Column:
    """Value of the last matching line that holds one."""
    usable = when & value.isNotNull()
    return F.max_by(F.when(usable, value), F.when(usable, F.col(pos)))


def parse_trim_lines(lines: DataFrame) -> DataFrame:
    """``(sample_id, total_pairs, too_short, passed, total_bp)`` from ``(sample_id, pos, line)``."""
    line = F.col("line")
    number = T.first_number(line)
    # only labelled lines reach the aggregation
    labelled = F.lit(False)
    for label in TRIM_LABELS.values():
        labelled = labelled | line.contains(label)
    return lines.where(labelled).groupBy("sample_id").agg(*[
        _last(number, line.contains(label)).alias(name) for name, label in TRIM_LABELS.items()])


def _split_lines(lines: DataFrame) -> DataFrame:
    parts = F.split("line", r"\|")
    return lines.where(F.size(parts) == 2).select(
        "sample_id", "pos", F.trim(F.regexp_replace(parts[0], "\t", " ")).alias("key"),
        F.trim(F.regexp_replace(parts[1], "\t", " ")).alias("value"))


def parse_align_lines(lines: DataFrame, profile: str = "summary") -> DataFrame:
    """Alignment metrics per sample from ``key | value`` lines.

    ``summary``: nine metrics and the derived mapped totals; ``report``: seven,
    thousands separators allowed; ``monitor``: first match, percents kept as text.
    """
    if profile == "monitor":
        line = F.col("line")
        cells = []
        for name, label in MONITOR_LABELS.items():
            word = F.regexp_extract(line, rf"\Q{label}\E\s*\|\s*(\S+)", 1)
            hit = word != ""
            cells.append(F.min_by(F.when(hit, word), F.when(hit, F.col("pos"))).alias(name))
        return lines.groupBy("sample_id").agg(*cells)
    labels = REPORT_LABELS if profile == "report" else ALIGN_LABELS
    cells = []
    if profile == "report":
        line, source = F.col("line"), lines
        for name, (label, kind) in labels.items():
            value = (
                F.replace(F.regexp_extract(line, r"(\d[\d,]*)", 1), F.lit(","), F.lit("")).try_cast("bigint")
                if kind == "count" else F.regexp_extract(line, r"([\d.]+)%", 1).try_cast("double"))
            cells.append(_last(value, line.contains(label)).alias(name))
        return source.groupBy("sample_id").agg(*cells)
    source = _split_lines(lines)
    key, value = F.col("key"), F.col("value")
    for name, (label, kind) in labels.items():
        parsed = T.whole_number(value) if kind == "count" else T.percent(value)
        cells.append(_last(parsed, key.contains(label)).alias(name))
    out = source.groupBy("sample_id").agg(*cells)
    mapped = F.col("uniquely_mapped_reads") + F.col("multi_mapped_reads")
    return out.withColumn("total_mapped_reads", mapped).withColumn(
        "total_mapped_pct",
        F.when(F.col("total_reads") > 0,
               F.col("total_mapped_reads") / F.col("total_reads") * 100.0))


def read_trim_logs(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """Logs named ``<sample>.log``."""
    sample = F.regexp_replace(T.file_name(F.col("file")), r"\.log$", "")
    return parse_trim_lines(read_lines(spark, path, glob).withColumn("sample_id", sample))


def read_align_logs(
    spark: SparkSession, path: str, profile: str = "summary", glob: str = "*Log.final.out"
) -> DataFrame:
    """Logs in a folder named by the sample."""
    sample = T.path_part(F.col("file"), -2)
    return parse_align_lines(read_lines(spark, path, glob).withColumn("sample_id", sample), profile)


def read_logs(
    spark: SparkSession, root: str, rule: str | None = None, sample_id: str | None = None
) -> DataFrame:
    """``(file, pos, line)`` of the logs under ``root``, by rule folder and sample prefix.

    Both are path patterns, so other files are never opened. There is no limit
    on the number of files.
    """
    name = f"{sample_id}*.log" if sample_id else "*.log"
    return read_lines(spark, f"{root}/{rule}" if rule else root, name, recursive=rule is None)


def select_logs(lines: DataFrame, rule: str | None = None, sample_id: str | None = None) -> DataFrame:
    """The same choice on a table of log lines ``(file, rule, ...)``."""
    out = lines if rule is None else lines.where(F.col("rule") == rule)
    return out if sample_id is None else out.where(F.col("file").startswith(sample_id))
