"""FastQC reports and MultiQC tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.sources.text import read_texts


def parse_fastqc(texts: DataFrame) -> DataFrame:
    """Report rows from ``(sample_id, text)``.

    Gives ``(sample_id, module, status, row_no, cells)``; a module without data
    has one row with no cells. Sections are cut inside each text, so nothing is
    ordered across rows.
    """
    sections = texts.select(
        "sample_id", F.posexplode(F.split("text", r"(?:^|\n)[ \t]*>>")).alias("section_no", "section"))
    # the part before the first marker and what follows END_MODULE lie outside modules
    sections = sections.where("section_no > 0 and not startswith(section, 'END_MODULE')")
    lines = F.transform(F.split("section", r"\r?\n"), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    head = F.split(F.get(lines, F.lit(0)), "\t")
    data = F.filter(
        F.slice(lines, F.lit(2), F.size(lines)), lambda x: (x != "") & ~x.startswith("#"))
    rows = sections.select(
        "sample_id", "section_no",
        F.get(head, F.lit(0)).alias("module"),
        F.coalesce(F.get(head, F.lit(1)), F.lit("unknown")).alias("status"),
        F.posexplode_outer(data).alias("line_no", "line"))
    return rows.select(
        "sample_id", "module", "status",
        # later sections of a repeated module follow earlier ones
        (F.col("section_no").cast("long") * (1 << 40) + F.coalesce("line_no", F.lit(0))).alias("row_no"),
        F.when(F.col("line").isNotNull(), F.split("line", "\t"))
        .otherwise(F.array().cast("array<string>")).alias("cells"))


def report_sample(file: Column) -> Column:
    """``.../<sample>_fastqc/fastqc_data.txt`` -> sample."""
    folder = F.try_element_at(F.split(file, "/"), F.lit(-2))
    return F.regexp_replace(folder, "_fastqc$", "")


def read_fastqc(spark: SparkSession, path: str, sample: Column | None = None) -> DataFrame:
    texts = read_texts(spark, path, "fastqc_data.txt")
    sample = sample if sample is not None else report_sample(F.col("file"))
    return parse_fastqc(texts.select(sample.alias("sample_id"), "text"))


def read_multiqc(spark: SparkSession, path: str, name: str = "multiqc_fastqc.txt") -> DataFrame:
    """A MultiQC table: header TSV, all columns text.

    ``path`` is the file, or a folder searched for ``name`` at any depth.
    """
    reader = spark.read.option("sep", "\t").option("header", "true")
    if not path.endswith(".txt"):
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", name)
    return reader.csv(path)
