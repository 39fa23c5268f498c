"""One query per operator over the whole test tables, and SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from readloom.llm import sql_twins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op1_substring_dedup")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import substring_dedup

    return substring_dedup.cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import bpe

    docs = table(spark, sf_dir, "documents")
    return bpe.codes(docs, vocabulary_path(), ["n_tokens", "ids_sha256", "decoded_sha256"], ["doc_id"])


@register("op3_decontamination")
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import decontaminate

    return decontaminate.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_licenses", sql_twins.op4())
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import licenses

    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


@register("op5_simhash")
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import toxicity

    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op7_shards", sql_twins.OP7)
def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import sharding

    return sharding.assign_shards(table(spark, sf_dir, "documents"))


@register("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import token_counts

    return token_counts.judged(table(spark, sf_dir, "documents"), vocabulary_path())


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


@register("op9_url_rules", sql_twins.OP9)
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import url_filter

    values = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS rules(host, path, verdict)")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


@register("op10_quality", sql_twins.OP10)
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import quality

    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register("op11_turns")
def op11_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import turns

    conversations = table(spark, sf_dir, "conversations")
    return turns.audit_table(turns.damaged(conversations), conversations.select("conv_id").distinct())


@register("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import whitening

    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op13_mix", sql_twins.OP13)
def op13_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from readloom.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "blocks")
