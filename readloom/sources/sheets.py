"""Sample sheets: everything is read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom import constants as K


def resolve_aliases(sheet: DataFrame) -> DataFrame:
    """FASTQ columns under their common names; the first alias present is used."""
    out = sheet
    for name, aliases in K.FASTQ_ALIASES.items():
        found = next((a for a in aliases if a in out.columns), None)
        if found and found != name:
            out = out.withColumnRenamed(found, name)
    return out


def select_project(sheet: DataFrame, project_id: str | None) -> DataFrame:
    if project_id is None or "project_id" not in sheet.columns:
        return sheet
    return sheet.where(F.col("project_id") == project_id)


def read_sample_sheet(
    spark: SparkSession, path: str, project_id: str | None = None, aliases: bool = True
) -> DataFrame:
    """A sheet, tab separated for ``.tsv`` else by comma, filtered to a project."""
    sep = "\t" if path.endswith(".tsv") else ","
    sheet = select_project(
        spark.read.option("sep", sep).option("header", "true").csv(path), project_id)
    if project_id is not None and "project_id" in sheet.columns and sheet.isEmpty():
        raise ValueError(f"No samples found for project_id: {project_id}")
    return resolve_aliases(sheet) if aliases else sheet


def last_rows(rows: DataFrame, pos: str, id_col: str = "sample_id") -> DataFrame:
    """Trimmed rows with an id; of a repeated id the last row."""
    names = [c for c in rows.columns if c != pos]
    clean = rows.select(pos, *[F.trim(F.col(f"`{c}`")).alias(c.strip()) for c in names])
    values = [c.strip() for c in names if c.strip() != id_col]
    kept = clean.where((F.col(id_col) != "") & F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in values]), pos).alias("row"))
    return kept.select(id_col, "row.*")


def read_sheet_with_comments(spark: SparkSession, path: str) -> DataFrame:
    """A TSV with ``#`` comment lines and blank lines; the last row of an id wins."""
    rows = spark.read.option("sep", "\t").option("header", "true").option("comment", "#").csv(path)
    pos = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return last_rows(rows.withColumn("_pos", pos), "_pos")
