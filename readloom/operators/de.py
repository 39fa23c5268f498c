"""Differential expression: hand-over inputs, readiness, result summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.ranking import first_rows
from readloom.operators import counts as C
from readloom.operators import joins as J
from readloom.operators import project as P


def condition_column(metadata: DataFrame) -> str:
    return "condition" if "condition" in metadata.columns else "group"


def de_metadata(sheet: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Id, condition, replicate and the optional columns the sheet has."""
    names = [c for c in K.DE_METADATA_COLUMNS + K.DE_OPTIONAL_COLUMNS if c in sheet.columns]
    out = sheet.select(*names)
    return out.where(~F.col("sample_id").isin(list(excluded))) if excluded else out


def is_control(condition: Column, words: Sequence[str] = tuple(K.CONTROL_WORDS)) -> Column:
    """Name equal to a control word once ``-`` and blanks are ``_``, or starting with one."""
    folded = F.lower(condition)
    out = F.translate(folded, "- ", "__").isin(list(words))
    for word in words:
        out = out | folded.startswith(word)
    return out


def ordered_conditions(metadata: DataFrame, order: str, condition: str = "condition") -> DataFrame:
    """``(condition, first_seen)``: distinct names with their first position."""
    return metadata.groupBy(F.col(condition).alias("condition")).agg(
        F.min(order).alias("first_seen"))


def pick_control(conditions: DataFrame) -> DataFrame:
    """One row: the first control-like condition, else the first condition."""
    rank = F.struct((~is_control(F.col("condition"))).alias("other"), F.col("first_seen"),
                    F.col("condition").alias("name"))
    return conditions.agg(F.min_by("condition", rank).alias("control"))


def pairwise_comparisons(conditions: DataFrame) -> DataFrame:
    """``(treatment, control, first_seen)``: every other condition against the control."""
    control = pick_control(conditions).scalar()
    return conditions.withColumn("control", control).where("condition <> control").select(
        F.col("condition").alias("treatment"), "control", "first_seen")


def pair_name(treatment: Column, control: Column) -> Column:
    return F.concat(treatment, F.lit("_vs_"), control)


def significant(results: DataFrame, max_padj: float = 0.05, min_lfc: float = 0.0) -> DataFrame:
    """Rows below the padj cut and beyond the fold-change cut, with a direction."""
    lfc, padj = F.col("log2FoldChange"), F.col("padj")
    kept = results.where(
        padj.isNotNull() & lfc.isNotNull() & (padj < max_padj) & (F.abs(lfc) > min_lfc))
    return kept.withColumn("direction", F.when(lfc > 0, "up").when(lfc < 0, "down"))


def significant_counts(
    results: DataFrame, max_padj: float = 0.05, min_lfc: float = 0.0
) -> DataFrame:
    """Per pair: significant, up, down. Pairs without a significant gene stay, with 0."""
    lfc, padj = F.col("log2FoldChange"), F.col("padj")
    hit = F.coalesce((padj < max_padj) & (F.abs(lfc) > min_lfc), F.lit(False))
    return results.groupBy("pair").agg(
        F.count_if(hit).alias("sig_total"),
        F.count_if(hit & (lfc > 0)).alias("sig_up"),
        F.count_if(hit & (lfc < 0)).alias("sig_down"),
    )


def three_digits(value: Column) -> Column:
    """Three significant digits, as a double."""
    return F.format_string("%.2e", value).cast("double")


def top_genes(
    results: DataFrame, n: int = 10, max_padj: float = 0.05, min_lfc: float = 0.0,
    rounded: bool = True,
) -> DataFrame:
    """Top ``n`` genes of each pair and direction by fold change; ties by gene."""
    sig = significant(results, max_padj, min_lfc).where("direction is not null")
    name = F.coalesce("symbol", "gene") if "symbol" in results.columns else F.col("gene")
    top = first_rows(sig, ["pair", "direction"], [F.desc(F.abs("log2FoldChange")), "gene"], n)
    lfc, padj = F.col("log2FoldChange"), F.col("padj")
    return top.select(
        "pair", "direction", "rank", name.alias("gene"),
        (F.round(lfc, 3) if rounded else lfc).alias("log2FC"),
        (three_digits(padj) if rounded else padj).alias("padj"))


def top_terms(terms: DataFrame, n: int = 5) -> DataFrame:
    """Terms with the lowest adjusted p per pair and direction; ties by id."""
    top = first_rows(terms, ["pair", "direction"], [F.asc_nulls_last("`p.adjust`"), "ID"], n)
    return top.select(
        "pair", "direction", "rank",
        F.coalesce("Description", "ID", F.lit("")).alias("term"),
        three_digits(F.col("`p.adjust`")).alias("padj"),
        F.coalesce("Count", F.lit(0)).cast("int").alias("count"))


def result_warnings(counts: DataFrame) -> DataFrame:
    """``none`` without a significant gene, ``few`` below ten."""
    n = F.col("sig_total")
    return counts.withColumn("warning", F.when(n == 0, "none").when(n < 10, "few"))


def missing_pairs(configured: DataFrame, results: DataFrame) -> DataFrame:
    return configured.select("pair").join(results.select("pair").distinct(), "pair", "left_anti")


def result_status(configured: DataFrame, results: DataFrame) -> DataFrame:
    """One row: pairs found and missing, and ``success``, ``partial`` or ``error``.

    Any missing pair makes it ``partial``; without configured pairs it is ``error``.
    """
    found = configured.select("pair").distinct().join(
        results.select("pair").distinct().withColumn("found", F.lit(1)), "pair", "left")
    return found.agg(
        F.count("found").alias("n_found"), F.count_if(F.col("found").isNull()).alias("n_missing")
    ).withColumn("status", F.when(F.col("n_missing") > 0, "partial")
                 .when(F.col("n_found") > 0, "success").otherwise("error"))


def config_conditions(pairs: DataFrame) -> DataFrame:
    """Distinct names used in ``pairs(treatment, control)``."""
    return pairs.select(F.explode(F.array("treatment", "control")).alias("name")).distinct()


def check_conditions(pairs: DataFrame, metadata: DataFrame) -> DataFrame:
    """``(name, suggestion)`` for names in pairs that the metadata does not have."""
    known = metadata.select(F.col(condition_column(metadata)).alias("name")).distinct()
    wrong = config_conditions(pairs).join(known, "name", "left_anti")
    return J.match_names(wrong, known).select("name", F.col("match").alias("suggestion"))


def apply_corrections(pairs: DataFrame, corrections: DataFrame) -> DataFrame:
    """Pairs with wrong names replaced; ``corrections(name, suggestion)``.

    Both sides of a pair are corrected in one join on the name.
    """
    fixes = corrections.where("suggestion is not null").select("name", "suggestion")
    left = fixes.select(F.col("name").alias("treatment"), F.col("suggestion").alias("_t"))
    right = fixes.select(F.col("name").alias("control"), F.col("suggestion").alias("_c"))
    fixed = pairs.join(left, "treatment", "left").join(right, "control", "left")
    return fixed.select(
        F.coalesce("_t", "treatment").alias("treatment"),
        F.coalesce("_c", "control").alias("control"),
        (F.col("_t").isNotNull() | F.col("_c").isNotNull()).alias("changed"))


def group_sizes(metadata: DataFrame) -> DataFrame:
    return metadata.groupBy(F.col(condition_column(metadata)).alias("condition")).agg(
        F.count("*").alias("n"))


def readiness_findings(
    counts: DataFrame, metadata: DataFrame, pairs: DataFrame, zero_pct: float = 30
) -> DataFrame:
    """``(check, subject, level)`` rows of everything that stands in the way.

    A group of one is a warning and an error.
    """
    ids = J.differences(metadata, counts).select(
        F.concat(F.lit("only_in_"), "side").alias("check"), F.col("sample_id").alias("subject"), "level")
    names = check_conditions(pairs, metadata).select(
        F.lit("condition").alias("check"), F.col("name").alias("subject"), F.lit("error").alias("level"))
    sizes = group_sizes(metadata).where("n < 3").select(
        F.lit("group_size").alias("check"), F.col("condition").alias("subject"),
        F.explode(F.when(F.col("n") < 2, F.array(F.lit("warning"), F.lit("error")))
                  .otherwise(F.array(F.lit("warning")))).alias("level"))
    zeros = C.zero_genes(counts, zero_pct).where("warn").select(
        F.lit("zero_genes").alias("check"),
        F.concat(F.col("zero_pct").cast("string"), F.lit("%")).alias("subject"),
        F.lit("warning").alias("level"))
    return ids.unionByName(names).unionByName(sizes).unionByName(zeros)


def readiness(found: DataFrame) -> DataFrame:
    """One row: ``error``, ``warning`` or ``ok`` with the counts behind it."""
    return found.agg(
        F.count_if(F.col("level") == "error").alias("n_errors"),
        F.count_if(F.col("level") == "warning").alias("n_warnings"),
    ).withColumn("status", F.when(F.col("n_errors") > 0, "error")
                 .when(F.col("n_warnings") > 0, "warning").otherwise("ok"))


def handover_gate(
    statuses: DataFrame, listing: DataFrame,
    counts_path: str = "project_summary/counts/counts_matrix_clean.csv",
) -> DataFrame:
    """One row: whether the counts file exists, and the QC totals to decide on."""
    exists = listing.agg(F.coalesce(F.bool_or(F.col("path").endswith(counts_path)), F.lit(False))).scalar()
    return P.status_summary(statuses).withColumn("counts_exist", exists).withColumn(
        "ready", F.col("counts_exist") & (F.col("failed") == 0))
