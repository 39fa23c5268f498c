"""JSON documents of earlier runs: manifests and QC evaluations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISSUES = "array<struct<severity:string,category:string,message:string>>"
QC_METRICS = f"""struct<
  overall_status: string,
  sequencing: struct<total_reads:bigint,read_length:bigint>,
  alignment: struct<total_mapped_reads:bigint,total_mapped_pct:double,uniquely_mapped_reads:bigint,
    uniquely_mapped_pct:double,multi_mapped_reads:bigint,multi_mapped_pct:double,
    unmapped_too_short:bigint,unmapped_too_short_pct:double,mismatch_rate:double>,
  quantification: struct<assigned_reads:bigint,assignment_rate:double,
    unassigned_multimapping:bigint,unassigned_nofeatures:bigint,unassigned_ambiguity:bigint>,
  issues: {ISSUES},
  recommendations: array<string>>"""
OUTPUT_FILE = (
    "struct<path:string,absolute_path:string,md5:string,size_bytes:bigint,"
    "modified:string,description:string>"
)
MANIFEST_SCHEMA = f"""
  sample_id string, project_id string, pipeline_type string, pipeline_version string,
  execution_date string, status string, sample_metadata map<string,string>,
  final_outputs map<string,{OUTPUT_FILE}>, qc_metrics {QC_METRICS},
  next_steps array<string>, _corrupt_record string"""
# Fixed value: where a manifest lies under its project.
MANIFEST_PATH = r"/rna-seq/final_outputs/manifest\.json$"


def read_manifests(spark: SparkSession, project_dir: str) -> DataFrame:
    """All manifests of a project, one row per file with its path.

    Unreadable files stay as rows with ``_corrupt_record``; see ``split_corrupt``.
    """
    docs = (
        spark.read.schema(MANIFEST_SCHEMA)
        .option("multiLine", "true").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "manifest.json").option("mode", "PERMISSIVE")
        .json(project_dir)
    )
    return docs.withColumn("file", F.col("_metadata.file_path")).where(
        F.col("file").rlike(MANIFEST_PATH))


def split_corrupt(manifests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable manifests, and the files that were not."""
    bad = F.col("_corrupt_record").isNotNull()
    return manifests.where(~bad).drop("_corrupt_record"), manifests.where(bad).select("file")


def manifest_qc(manifests: DataFrame) -> DataFrame:
    """Flat QC row per manifest for the project roll-up."""
    q = F.col("qc_metrics")
    return manifests.select(
        F.coalesce("sample_id", F.lit("unknown")).alias("sample_id"),
        q["overall_status"].alias("status"),
        q["alignment"]["uniquely_mapped_pct"].alias("uniquely_mapped_pct"),
        q["quantification"]["assignment_rate"].alias("assignment_rate"),
        q["sequencing"]["total_reads"].alias("total_reads"),
        F.coalesce(q["issues"], F.array().cast(ISSUES)).alias("issues"),
    )


def manifest_metadata_long(manifests: DataFrame) -> DataFrame:
    """``(sample_id, axis, value)`` from the metadata maps; values are text."""
    return manifests.select(
        F.coalesce("sample_id", F.lit("unknown")).alias("sample_id"),
        F.explode("sample_metadata").alias("axis", "value"))


EVALUATION_SCHEMA = """
  samples array<struct<sample:string,status:string,recommendation:string,
    metrics:map<string,double>,issues:array<string>,warnings:array<string>>>,
  thresholds map<string,double>"""


def read_evaluation(spark: SparkSession, path: str) -> DataFrame:
    """Samples of a QC evaluation document, one row each."""
    docs = spark.read.schema(EVALUATION_SCHEMA).option("multiLine", "true").json(path)
    return docs.select(F.explode("samples").alias("s"), "thresholds").select(
        F.col("s.sample").alias("sample_id"), "s.status", "s.recommendation", "s.metrics",
        "s.issues", "s.warnings", "thresholds")
