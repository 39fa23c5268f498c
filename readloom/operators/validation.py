"""Sheet validation. Each check gives rows; ``validate`` unions them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.ranking import first_rows


def missing_columns(sheet: DataFrame, required: Sequence[str] = tuple(K.SHEET_REQUIRED)) -> list[str]:
    """Required columns the sheet lacks; schema only, no job."""
    return [c for c in required if c not in sheet.columns]


def unknown_columns(
    sheet: DataFrame, known: Sequence[str] = tuple(K.SHEET_REQUIRED + K.SHEET_OPTIONAL)
) -> list[str]:
    return [c for c in sheet.columns if c not in known]


def empty_values(sheet: DataFrame, required: Sequence[str] = tuple(K.SHEET_REQUIRED)) -> DataFrame:
    """``(column, n_null, n_blank)`` for every required column, in one pass."""
    present = [c for c in required if c in sheet.columns]
    counts = sheet.agg(*[
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
            F.count_if(F.trim(F.col(c).cast("string")) == "").alias("n_blank"),
        ).alias(f"c{i}") for i, c in enumerate(present)])
    cells = F.array(*[F.col(f"c{i}") for i in range(len(present))])
    return counts.select(F.explode(cells).alias("c")).select("c.*")


def duplicate_ids(sheet: DataFrame) -> DataFrame:
    """Ids on more than one row, with their row count."""
    return sheet.groupBy("sample_id").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def duplicate_rows(sheet: DataFrame) -> DataFrame:
    """All rows of duplicated ids."""
    return sheet.join(duplicate_ids(sheet).select("sample_id"), "sample_id", "left_semi")


def duplicate_summary(sheet: DataFrame) -> DataFrame:
    """One row: duplicated ids and the rows they take."""
    return duplicate_ids(sheet).agg(
        F.count("*").alias("n_ids"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))


def non_numeric(sheet: DataFrame, columns: Sequence[str] = ("replicate", "batch")) -> DataFrame:
    """``(column, sample_id, value)`` where the value is missing or not a number."""
    present = [c for c in columns if c in sheet.columns]
    texts = sheet.select("sample_id", *[F.col(c).cast("string").alias(c) for c in present])
    return texts.unpivot("sample_id", present, "column", "value").where(
        F.trim("value").try_cast("double").isNull())


def first_ids(rows: DataFrame, by: str = "column", n: int = 5) -> DataFrame:
    """The first ``n`` ids of every group, for a message; the rows stay whole."""
    return first_rows(rows, [by], ["sample_id"], n)


def bad_values(
    sheet: DataFrame, allowed: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """``(column, value, n_rows)`` outside the allowed lists; NULL and ``''`` are fine."""
    allowed = allowed or K.SHEET_ALLOWED
    present = [c for c in allowed if c in sheet.columns]
    texts = sheet.select("sample_id", *[F.col(c).cast("string").alias(c) for c in present])
    test = F.lit(False)
    for c in present:
        test = test | ((F.col("column") == c) & ~F.col("value").isin([*allowed[c], ""]))
    return (
        texts.unpivot("sample_id", present, "column", "value")
        .where(F.col("value").isNotNull() & test)
        .groupBy("column", "value").agg(F.count("*").alias("n_rows"))
    )


def missing_files(sheet: DataFrame, listing: DataFrame) -> DataFrame:
    """``(sample_id, mate, path)`` of read files that the listing does not hold."""
    files = sheet.select("sample_id", F.explode(F.array(
        F.struct(F.lit("R1").alias("mate"), F.col("fastq_1").alias("path")),
        F.struct(F.lit("R2").alias("mate"), F.col("fastq_2").alias("path")))).alias("f"),
    ).select("sample_id", "f.*").where("path is not null")
    return files.join(listing.select("path"), "path", "left_anti").select("sample_id", "mate", "path")


def sheet_summary(sheet: DataFrame) -> DataFrame:
    """One row: rows, distinct projects, distinct conditions."""
    return sheet.agg(
        F.count("*").alias("total_samples"),
        F.countDistinct("project_id").alias("projects"),
        F.countDistinct("condition").alias("conditions"),
    )


def value_counts(sheet: DataFrame, columns: Sequence[str] = ("project_id", "condition")) -> DataFrame:
    """``(column, value, n)`` of several columns in one pass."""
    texts = sheet.select("sample_id", *[F.col(c).cast("string").alias(c) for c in columns])
    return (
        texts.unpivot("sample_id", list(columns), "column", "value")
        .where("value is not null").groupBy("column", "value").agg(F.count("*").alias("n"))
    )


def project_filter_note(sheet: DataFrame, project_id: str) -> DataFrame:
    """One row: rows kept and total, with the level of the note."""
    kept = F.count_if(F.col("project_id") == project_id)
    return sheet.agg(kept.alias("n"), F.count("*").alias("total")).select(
        F.lit(project_id).alias("project_id"), "n", "total",
        F.when(F.col("n") == 0, "error").otherwise("warning").alias("level"))


def _message(level: str, code: str, message: Column) -> list[Column]:
    return [F.lit(level).alias("level"), F.lit(code).alias("code"), message.alias("message")]


def validate(
    sheet: DataFrame, listing: DataFrame | None = None, project_id: str | None = None
) -> DataFrame:
    """All checks as ``(level, code, message)`` rows; no error row means valid."""
    spark = sheet.sparkSession
    schema_notes = [("error", "missing_column", f"Missing required columns: {c}")
                    for c in missing_columns(sheet)]
    schema_notes += [("warning", "unknown_column", f"Unknown columns (will be ignored): {c}")
                     for c in unknown_columns(sheet)]
    out = spark.createDataFrame(schema_notes, "level string, code string, message string")
    if project_id is not None:
        note = project_filter_note(sheet, project_id)
        text = F.when(F.col("n") == 0, F.lit(f"No samples found for project_id: {project_id}")).otherwise(
            F.format_string(f"Filtered to project {project_id}: %d/%d samples", "n", "total"))
        out = out.unionByName(note.select(
            "level", F.lit("project").alias("code"), text.alias("message")))
        sheet = sheet.where(F.col("project_id") == project_id)
    empty = empty_values(sheet)
    nulls = empty.where("n_null > 0").select(*_message(
        "error", "null", F.format_string("Column '%s' has %d empty values", "column", "n_null")))
    blanks = empty.where("n_blank > 0").select(*_message(
        "error", "blank",
        F.format_string("Column '%s' has %d whitespace-only values", "column", "n_blank")))
    duplicates = duplicate_ids(sheet).select(*_message(
        "error", "duplicate",
        F.format_string("Duplicate sample_id found: %s (appears in %d rows)", "sample_id", "n_rows")))
    numbers = non_numeric(sheet).select(*_message(
        "warning", "non_numeric",
        F.concat(F.lit("Non-numeric "), "column", F.lit(" values in samples: "), "sample_id")))
    values = bad_values(sheet).select(*_message(
        "warning", "bad_value",
        F.concat(F.lit("Column '"), "column", F.lit("' has invalid values: "), "value")))
    for part in (nulls, blanks, duplicates, numbers, values):
        out = out.unionByName(part)
    if listing is not None:
        files = missing_files(sheet, listing).select(*_message(
            "error", "missing_file",
            F.concat("sample_id", F.lit(": "), "mate", F.lit(" not found - "), "path")))
        out = out.unionByName(files)
    return out
