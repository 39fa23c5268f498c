"""A corpus from raw documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; its result is stored and reread as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm import bpe, decontaminate, near_copies, queries, substring_dedup, toxicity
from readloom.session import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints two bits apart, or 0.8 of their five-word shingles in common) stays."""
    return near_copies.keep_one(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur before are cut out; ``n_chars`` follows the text."""
    cut = substring_dedup.cut_repeats(docs)
    changed = F.col("n_removed_words") > 0
    return cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and whether they decode to the text."""
    return bpe.codes(docs, queries.vocabulary_path(), ["ids", "n_tokens", "round_trip"], ["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("substring_dedup", cut_passages),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

#: No SQL for a trained classifier or token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each stored under the shared folder."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
