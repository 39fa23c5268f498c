"""Sample sheets and manifests: conditions, replicates, metadata, conversions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.ranking import number_rows


def assign_condition(sample_id: Column, patterns: Mapping[str, Sequence[str]]) -> Column:
    """Condition whose pattern occurs in the id, without case; the last one wins."""
    folded = F.lower(sample_id)
    out = F.lit(K.UNKNOWN_CONDITION)
    for name, texts in patterns.items():
        test = F.lit(False)
        for text in texts:
            test = test | folded.contains(text.lower())
        out = F.when(test, name).otherwise(out)
    return out


def infer_condition(
    sample_id: Column,
    suffixes: Sequence[tuple[str, Sequence[str]]] = tuple(K.CONDITION_SUFFIXES),
    prefixes: Sequence[tuple[str, Sequence[str]]] = tuple(K.CONDITION_PREFIXES),
) -> Column:
    """Condition from the id: suffixes first, then prefixes, else ``unknown``."""
    tests = [(n, sample_id.endswith(t)) for n, ts in suffixes for t in ts]
    tests += [(n, sample_id.startswith(t)) for n, ts in prefixes for t in ts]
    out = F.lit(K.UNKNOWN_CONDITION)
    for name, test in reversed(tests):
        out = F.when(test, name).otherwise(out)
    return out


def number_replicates(samples: DataFrame, **split) -> DataFrame:
    """Running number of a sample within its condition, by sample id."""
    return number_rows(samples, ["condition"], ["sample_id"], "replicate", **split)


def missing_mates(pairs: DataFrame) -> DataFrame:
    """Samples without a second mate, when any sample of the data set has one.

    ``pairs(sample_id, r1, r2)``.
    """
    paired = pairs.agg(F.bool_or(F.col("r2").isNotNull())).scalar()
    return pairs.where(F.col("r2").isNull() & paired).select("sample_id")


def condition_counts(samples: DataFrame) -> DataFrame:
    assigned = samples.where(F.col("condition") != K.UNKNOWN_CONDITION)
    return assigned.groupBy("condition").agg(F.count("*").alias("n_samples"))


def unassigned(samples: DataFrame) -> DataFrame:
    return samples.where(F.col("condition") == K.UNKNOWN_CONDITION).select("sample_id")


def manifest_metadata(
    sheet: DataFrame,
    fields: Sequence[str] = tuple(K.MANIFEST_FIELDS),
    drop_falsy: bool = True,
    id_col: str = "sample_id",
) -> DataFrame:
    """``(sample_id, sample_metadata map)`` with the named fields that hold a value.

    NULL, NaN and empty text are left out; ``drop_falsy`` also leaves out a
    numeric 0 (text ``"0"`` stays).
    """
    entries = []
    types = dict(sheet.dtypes)
    for name in fields:
        if name not in types:
            continue
        col = F.col(f"`{name}`")
        keep = col.isNotNull()
        if types[name] == "string":
            keep = keep & (col != "")
        elif types[name] in ("double", "float"):
            keep = keep & ~F.isnan(col)
        if drop_falsy and types[name] not in ("string", "boolean"):
            keep = keep & (col != 0)
        entries.append(F.when(keep, F.struct(F.lit(name).alias("k"), col.cast("string").alias("v"))))
    kept = F.array_compact(F.array(*entries))
    return sheet.select(id_col, F.map_from_entries(kept).alias("sample_metadata"))


def whole_text(value: Column) -> Column:
    """Integer-valued numbers as integers: ``"3.0"`` -> ``"3"``; other text unchanged."""
    whole = value.rlike(r"^[+-]?\d+\.0*$")
    plain = F.regexp_replace(F.regexp_replace(value, r"\.0*$", ""), r"^(-?)\+?0*(?=\d)", "$1")
    return F.when(whole, F.when(plain == "-0", "0").otherwise(plain)).otherwise(value)


def sheet_metadata(
    sheet: DataFrame, fields: Sequence[str] = tuple(K.BACKFILL_FIELDS)
) -> DataFrame:
    """Metadata map per sheet row for a backfill: every non-null field."""
    entries = [
        F.when(F.col(f"`{c}`").isNotNull(),
               F.struct(F.lit(c).alias("k"), whole_text(F.col(f"`{c}`").cast("string")).alias("v")))
        for c in fields if c in sheet.columns
    ]
    return sheet.select(
        "sample_id", F.map_from_entries(F.array_compact(F.array(*entries))).alias("sheet_metadata"))


def backfill_metadata(manifests: DataFrame, sheet_meta: DataFrame) -> DataFrame:
    """Manifests with the sheet's metadata in place of their own where the sheet has the id."""
    joined = manifests.join(sheet_meta, "sample_id", "left")
    return joined.withColumn("updated", F.col("sheet_metadata").isNotNull()).withColumn(
        "sample_metadata", F.coalesce("sheet_metadata", "sample_metadata")).drop("sheet_metadata")


def not_in_sheet(manifests: DataFrame, sheet: DataFrame) -> DataFrame:
    return manifests.join(sheet.select("sample_id"), "sample_id", "left_anti").select("sample_id")


def by_library(sheet: DataFrame, library_type: str, project_id: str | None = None) -> DataFrame:
    """Rows of one library type, without case; optionally of one project."""
    out = sheet.where(F.lower("library_type") == library_type.lower())
    return out if project_id is None else out.where(F.col("project_id") == project_id)


def check_converter_columns(sheet: DataFrame) -> None:
    missing = [c for c in K.CONVERTER_REQUIRED if c not in sheet.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def _text(sheet: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")) if name in sheet.columns else F.lit("")


def to_workflow_sheet(
    sheet: DataFrame, target: str, library_type: str | None = None, project_id: str | None = None
) -> DataFrame:
    """Sheet rows in the shape another workflow reads.

    ``snakemake``: six columns; ``nextflow``: four; ``wdl``: one JSON text per
    sample with its optional keys left out when empty.
    """
    check_converter_columns(sheet)
    # Default library type per target.
    default = {"snakemake": "RNA-seq", "wdl": "WGS", "nextflow": "ATAC-seq"}[target]
    rows = by_library(sheet, library_type or default, project_id).where("sample_id <> ''")
    if target == "snakemake":
        return rows.select(
            "sample_id", "condition", "replicate", F.col("fastq_1").alias("fastq_r1"),
            _text(sheet, "fastq_2").alias("fastq_r2"), _text(sheet, "notes").alias("notes"))
    if target == "nextflow":
        return rows.select(
            F.col("sample_id").alias("sample"), "fastq_1",
            _text(sheet, "fastq_2").alias("fastq_2"), "replicate")
    filled = {c: F.when(_text(sheet, c) != "", F.col(c)) for c in ("fastq_2", "genome_build")
              if c in sheet.columns}
    doc = F.struct(
        "sample_id", "fastq_1", "read_type",
        filled.get("fastq_2", F.lit(None).cast("string")).alias("fastq_2"),
        filled.get("genome_build", F.lit(None).cast("string")).alias("reference_genome"))
    return rows.select("sample_id", F.to_json(doc).alias("sample"))


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """Raise when a selection is empty; reads at most one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def library_targets(sheet: DataFrame, project_id: str | None = None) -> DataFrame:
    """Library types of a project and the workflow each is written for."""
    rows = sheet if project_id is None else sheet.where(F.col("project_id") == project_id)
    kind = F.lower("library_type")
    return rows.select("library_type").distinct().select(
        "library_type",
        F.when(kind.contains("rna"), "snakemake")
        .when(F.col("library_type") == "WGS", "wdl")
        .when(kind.contains("atac"), "nextflow").alias("target"))


def parse_ids(sample_id: Column) -> Column:
    """Tissue, sex and genotype read from an id; ``Unknown`` where it does not say."""
    tissue = F.upper(F.regexp_extract(sample_id, K.TISSUE_IN_ID, 1))
    sex = F.upper(F.regexp_extract(sample_id, K.SEX_IN_ID, 1))
    genotype = F.upper(F.regexp_extract(sample_id, K.GENOTYPE_IN_ID, 1))
    return F.struct(
        F.when(tissue != "", tissue).otherwise("Unknown").alias("tissue"),
        F.when(sex == "M", "Male").when(sex == "F", "Female").otherwise("Unknown").alias("sex"),
        F.when(genotype == "W", "wildtype").when(genotype == "H", "heterozygous")
        .otherwise("Unknown").alias("genotype"),
    )


def id_conflicts(sheet: DataFrame, column: str = "sex") -> DataFrame:
    """Samples whose id says something else than the sheet. The sheet is right."""
    said = parse_ids(F.col("sample_id"))[column]
    return sheet.select("sample_id", said.alias("in_id"), F.col(column).alias("in_sheet")).where(
        "in_id <> 'Unknown' and in_id <> in_sheet")


def manifest_records(
    outputs: DataFrame, qc: DataFrame, metadata: DataFrame, project_id: Column | str = "project_id",
    run_type: str = "rna-seq", version: str = "1.0.0",
) -> DataFrame:
    """One manifest row per sample: outputs, QC record, metadata and next steps.

    ``outputs(sample_id, artifact, path, absolute_path, md5, size_bytes,
    modified, description)``; of several files for one artifact the newest is
    kept, so a map has one entry per kind of artifact.
    """
    from readloom.operators.sample_qc import next_steps

    entry = F.struct("path", "absolute_path", "md5", "size_bytes", "modified", "description")
    kept = outputs.groupBy("sample_id", "artifact").agg(
        F.max_by(entry, F.struct("modified", "path")).alias("entry"))
    files = kept.groupBy("sample_id").agg(F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col("artifact").alias("key"), F.col("entry").alias("value"))))).alias("final_outputs"))
    joined = metadata.join(files, "sample_id", "left").join(qc, "sample_id", "left")
    status = F.coalesce("overall_status", F.lit("UNKNOWN"))
    return joined.select(
        "sample_id",
        F.col(project_id).alias("project_id") if isinstance(project_id, str) else project_id,
        F.lit(run_type).alias("pipeline_type"),
        F.lit(version).alias("pipeline_version"),
        F.when(F.col("final_outputs").isNotNull(), "completed").otherwise("incomplete").alias("status"),
        "sample_metadata",
        "final_outputs",
        F.struct(status.alias("overall_status"), "sequencing", "alignment", "quantification",
                 "issues", "recommendations").alias("qc_metrics"),
        next_steps(status).alias("next_steps"),
    )
