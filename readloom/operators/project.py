"""Roll-up of judged samples into project-level tables.

Tables stay long: one row per sample, axis value or issue. Lists exist only in
the JSON sink, so no group of samples is ever gathered into one row here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.stats import missing_as, share


def status_summary(statuses: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals; everything that is not PASS counts as failed. One row per ``by``."""
    passed = F.count_if(F.col("status") == "PASS")
    return statuses.groupBy(*by).agg(
        F.count("*").alias("total_samples"),
        passed.alias("passed"),
        (F.count("*") - passed).alias("failed"),
        F.round(share(passed, F.count("*")), 2).alias("pass_rate"),
    )


def condition_groups(metadata: DataFrame, default: str = "Unknown") -> DataFrame:
    """``(condition, sample_id)`` rows; a missing condition gets the default."""
    return metadata.select(F.coalesce("condition", F.lit(default)).alias("condition"), "sample_id")


def metadata_to_long(
    metadata: DataFrame, id_col: str = "sample_id", columns: Sequence[str] | None = None
) -> DataFrame:
    """Wide metadata to ``(sample_id, axis, value)``; values become text."""
    names = list(columns or [c for c in metadata.columns if c != id_col])
    texts = metadata.select(
        F.col(id_col).alias("sample_id"),
        *[F.trim(F.col(f"`{c}`").cast("string")).alias(c.strip()) for c in names])
    return texts.unpivot("sample_id", [c.strip() for c in names], "axis", "value")


def merge_metadata(sheet_long: DataFrame, manifest_long: DataFrame) -> DataFrame:
    """Per key: the sheet value if the sheet has the key, else the manifest value.

    A key present in the sheet with an empty value still wins. Keys are present
    when the row exists, so NULL and ``''`` both block the fallback.
    """
    sheet = sheet_long.select("sample_id", "axis", F.lit(1).alias("source"), "value")
    manifest = manifest_long.select("sample_id", "axis", F.lit(2).alias("source"), "value")
    return (
        sheet.unionByName(manifest)
        .groupBy("sample_id", "axis")
        .agg(F.min_by(F.struct("value"), "source").alias("v"))
        .select("sample_id", "axis", "v.value")
    )


def sample_axes(
    metadata_long: DataFrame, technical: Sequence[str] = tuple(K.TECHNICAL_COLUMNS)
) -> DataFrame:
    """Analysis axes: every non-technical column with a non-empty value."""
    value = F.trim("value")
    return metadata_long.where(
        ~F.lower("axis").isin(list(technical)) & (F.col("axis") != "") & (value != "")
    ).select("axis", value.alias("value"), "sample_id")


def sample_metrics(qc: DataFrame) -> DataFrame:
    """Four metrics per sample with their defaults."""
    return qc.select(
        "sample_id",
        F.coalesce("uniquely_mapped_pct", F.lit(0.0)).alias("uniquely_mapped_pct"),
        F.coalesce("assignment_rate", F.lit(0.0)).alias("assignment_rate"),
        F.coalesce(F.col("total_reads").cast("bigint"), F.lit(0)).alias("total_reads"),
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
    )


def aggregate_stats(
    qc: DataFrame, missing: str = "zero", digits: int = 2, by: Sequence[str] = ()
) -> DataFrame:
    """Mean, min and max of both rates; a missing metric counts as 0 by default."""
    unique = missing_as(F.col("uniquely_mapped_pct"), missing)
    assign = missing_as(F.col("assignment_rate"), missing)
    return qc.groupBy(*by).agg(
        F.round(F.avg(unique), digits).alias("mean_uniquely_mapped_pct"),
        F.round(F.avg(assign), digits).alias("mean_assignment_rate"),
        F.round(F.min(unique), digits).alias("min_uniquely_mapped_pct"),
        F.round(F.max(unique), digits).alias("max_uniquely_mapped_pct"),
        F.round(F.min(assign), digits).alias("min_assignment_rate"),
        F.round(F.max(assign), digits).alias("max_assignment_rate"),
    )


def project_issues(qc: DataFrame) -> DataFrame:
    """Issue rows of FAIL samples only. ``qc`` has ``issues`` as an array."""
    failed = qc.where(F.col("status") == "FAIL")
    return failed.select("sample_id", F.explode("issues").alias("i")).select(
        "sample_id",
        F.coalesce("i.severity", F.lit("UNKNOWN")).alias("severity"),
        F.coalesce("i.message", F.lit("")).alias("message"),
    )


def align_overview(align: DataFrame, low_below: float = 70) -> DataFrame:
    """One row: samples, mean unique share (missing as 0), low samples (0 included)."""
    pct = F.col("uniquely_mapped_pct")
    return align.agg(
        F.count("*").alias("n_samples"),
        F.round(F.avg(F.coalesce(pct, F.lit(0.0))), 2).alias("avg_uniquely_mapped_pct"),
        F.count_if(pct < low_below).alias("n_low_mapping"),
    )


def low_mapping_samples(align: DataFrame, low_below: float = 70) -> DataFrame:
    return align.where(F.col("uniquely_mapped_pct") < low_below)


def biological_samples(names: DataFrame, column: str = "sample") -> DataFrame:
    """Distinct samples behind tool rows: BAM rows skipped, mate number stripped.

    Falls back to the number of rows when nothing is left.
    """
    from readloom.functions.text import strip_mate_number

    name = strip_mate_number(F.col(column))
    usable = F.when(~F.col(column).contains(".bam") & (name != ""), name)
    per_name = names.select(usable.alias("name")).groupBy("name").agg(F.count("*").alias("rows"))
    return per_name.agg(F.count("name").alias("n"), F.sum("rows").alias("rows")).select(
        F.when(F.col("n") > 0, F.col("n")).otherwise(F.coalesce("rows", F.lit(0))).alias("n_samples"))


def qc_overview(
    verdicts: DataFrame, report_files: DataFrame, align: DataFrame, low_below: float = 70
) -> DataFrame:
    """One row over sample verdicts, per-file report verdicts and alignment.

    Each part is aggregated to one row first; the parts meet as columns of a
    union, not in a join.
    """
    status = F.col("status")
    tools = verdicts.agg(
        F.count("*").alias("qc_total"),
        F.count_if(status == "PASS").alias("qc_passed"),
        F.count_if(status == "WARN").alias("qc_warned"),
        F.count_if(status == "FAIL").alias("qc_failed"),
        F.round(share(F.count_if(status == "PASS"), F.count("*")), 1).alias("qc_pass_rate"),
    )
    files = report_files.agg(
        F.count("*").alias("files_evaluated"),
        F.count_if("overall_pass").alias("files_pass"),
        F.count_if(~F.col("overall_pass")).alias("files_fail"),
    )
    aligned = align_overview(align, low_below)
    parts = tools.unionByName(files, True).unionByName(aligned, True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def batch_summary(
    runs: DataFrame, verdicts: DataFrame, align: DataFrame
) -> DataFrame:
    """Seven fields per project, with the verdict and mapping columns filled.

    ``runs(project_id, status, failed_step, duration_sec, error)``; ``verdicts``
    and ``align`` carry ``project_id``.
    """
    passed = verdicts.groupBy("project_id").agg(
        F.bool_and(F.col("status") != "FAIL").alias("qc_pass"))
    mapping = align.groupBy("project_id").agg(
        F.avg(F.coalesce("uniquely_mapped_pct", F.lit(0.0))).alias("pct"))
    return runs.join(passed, "project_id", "left").join(mapping, "project_id", "left").select(
        "project_id", "status", F.coalesce("failed_step", F.lit("")).alias("failed_step"),
        "duration_sec", "qc_pass",
        F.when(F.col("pct").isNotNull(), F.format_string("%.1f%%", "pct")).otherwise("")
        .alias("mapping_pct"),
        F.coalesce("error", F.lit("")).alias("error"),
    )


def project_rows(
    project_id: str, qc: DataFrame, axes: DataFrame, run_type: str = "rna-seq"
) -> DataFrame:
    """The project summary as ``(project_id, section, name, sample_id, value)`` rows.

    One document would hold every sample in one row; here each entry is a row,
    and the sink writes a folder per section. ``value`` is JSON text where an
    entry has several fields. Every section reads ``qc``: pass a stored table
    (``session.written``) when it is costly to compute.
    """
    statuses = qc.select("sample_id", F.coalesce("status", F.lit("UNKNOWN")).alias("status"))
    none = F.lit(None).cast("string")

    def entries(df: DataFrame, section: str) -> DataFrame:
        names = df.columns
        return df.select([F.col(c).cast("string").alias(c) for c in names]).unpivot(
            [], names, "name", "value").select(
            F.lit(section).alias("section"), "name", none.alias("sample_id"), "value")

    def per_sample(df: DataFrame, section: str, name: Column, value: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), name.alias("name"), "sample_id",
                         value.alias("value"))

    head = qc.sparkSession.range(1).select(
        F.lit("project").alias("section"), F.lit("pipeline_type").alias("name"),
        none.alias("sample_id"), F.lit(run_type).alias("value"))
    parts = [
        entries(status_summary(statuses), "qc_summary"),
        entries(aggregate_stats(qc), "aggregate_stats"),
        per_sample(statuses, "sample_statuses", F.lit("status"), F.col("status")),
        per_sample(axes, "sample_axes", F.col("axis"), F.col("value")),
        per_sample(sample_metrics(qc), "sample_metrics", F.lit("metrics"), F.to_json(F.struct(
            "uniquely_mapped_pct", "assignment_rate", "total_reads", "status"))),
        per_sample(project_issues(qc), "issues", F.col("severity"), F.col("message")),
    ]
    out = head
    for part in parts:
        out = out.unionByName(part)
    return out.select(F.lit(project_id).alias("project_id"), "*")
