"""Sample-level judgement from trimming, alignment and assignment metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.stats import share
from readloom.operators import rules as R


def assignment_metrics(assignment: DataFrame, basis: str = "four") -> DataFrame:
    """One row per sample from long ``(sample_id, category, reads)``.

    ``basis`` is the denominator of the rate: the ``four`` named categories, or
    ``all`` categories present.
    """
    cat, reads = F.col("category"), F.col("reads")

    def of(name: str) -> Column:
        return F.coalesce(F.sum(F.when(cat == name, reads)), F.lit(0)).cast("bigint")

    if basis == "four":
        whole = F.sum(F.when(cat.isin(K.FOUR_CATEGORIES), reads))
    elif basis == "all":
        whole = F.sum(reads)
    else:
        raise ValueError(f"basis must be 'four' or 'all', not {basis!r}")
    return assignment.groupBy("sample_id").agg(
        of(K.ASSIGNED).alias("assigned_reads"),
        of(K.MULTI_MAPPING).alias("unassigned_multimapping"),
        of(K.NO_FEATURES).alias("unassigned_nofeatures"),
        of(K.AMBIGUITY).alias("unassigned_ambiguity"),
        share(of(K.ASSIGNED), whole).alias("assignment_rate"),
    )


def assignment_rate(assignment: DataFrame, basis: str = "four") -> DataFrame:
    return assignment_metrics(assignment, basis).select("sample_id", "assignment_rate")


def sample_status(metrics: DataFrame, rules: Sequence[R.Rule] = tuple(R.SAMPLE_RULES)) -> DataFrame:
    return R.verdict(metrics, rules)


def sample_issues(metrics: DataFrame, rules: Sequence[R.Rule] = tuple(R.SAMPLE_RULES)) -> DataFrame:
    """``(sample_id, severity, category, message)``; severity is critical or warning."""
    return R.findings(metrics, rules).select(
        "sample_id",
        F.when(F.col("severity") >= R.FAIL, "critical").otherwise("warning").alias("severity"),
        F.col("source").alias("category"),
        "message",
    )


def issue_array(rules: Sequence[R.Rule] = tuple(R.SAMPLE_RULES)) -> Column:
    """Issues of one row as an array, at most one per rule."""
    cells = []
    for rule in rules:
        level = R.rule_severity(rule)
        cells.append(F.when(level > R.PASS, F.struct(
            F.when(level >= R.FAIL, "critical").otherwise("warning").alias("severity"),
            F.lit(rule.category).alias("category"),
            rule.message(R._value(rule)).alias("message"))))
    return F.array_compact(F.array(*cells))


def _texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def recommendations(status: Column, messages: Column) -> Column:
    """Fixed advice per status; WARN and FAIL also list the issue messages."""
    lists = K.SAMPLE_RECOMMENDATIONS
    return (
        F.when(status == "PASS", _texts(lists["PASS"]))
        .when(status == "WARN", F.concat(_texts(lists["WARN"]), messages))
        .otherwise(F.concat(_texts(lists["FAIL"]), messages))
    )


def next_steps(status: Column) -> Column:
    out = _texts(K.NEXT_STEPS_OTHER)
    for name, steps in K.NEXT_STEPS.items():
        out = F.when(status == name, _texts(steps)).otherwise(out)
    return out


def qc_record(
    align: DataFrame, assign: DataFrame, rules: Sequence[R.Rule] = tuple(R.SAMPLE_RULES),
    run_type: str = "rna-seq",
) -> DataFrame:
    """Nested QC document per sample from joined metrics, missing metrics as 0."""

    def n(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    def d(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0)).cast("double").alias(name)

    judged = R.verdict(align.join(assign, "sample_id", "full_outer"), rules, "overall_status")
    issues = issue_array(rules)
    return judged.select(
        "sample_id",
        F.lit(run_type).alias("pipeline_type"),
        F.lit("1.0").alias("qc_version"),
        "overall_status",
        F.struct(n("total_reads"), n("read_length")).alias("sequencing"),
        F.struct(
            n("total_mapped_reads"), d("total_mapped_pct"), n("uniquely_mapped_reads"),
            d("uniquely_mapped_pct"), n("multi_mapped_reads"), d("multi_mapped_pct"),
            n("unmapped_too_short"), d("unmapped_too_short_pct"), d("mismatch_rate"),
        ).alias("alignment"),
        F.struct(
            n("assigned_reads"), d("assignment_rate"), n("unassigned_multimapping"),
            n("unassigned_nofeatures"), n("unassigned_ambiguity"),
        ).alias("quantification"),
        issues.alias("issues"),
        recommendations(
            F.col("overall_status"), F.transform(issues, lambda i: i["message"])
        ).alias("recommendations"),
    )


def tool_verdict(metrics: DataFrame, rules: Sequence[R.Rule] = tuple(R.TOOL_RULES)) -> DataFrame:
    """Verdict over trimming, alignment and assignment; absent metrics are not judged."""
    levels = [R.rule_severity(r) for r in rules]
    fails = sum((F.when(x == R.FAIL, 1).otherwise(0) for x in levels), F.lit(0))
    warns = sum((F.when(x == R.WARN, 1).otherwise(0) for x in levels), F.lit(0))
    return R.verdict(metrics, rules).withColumn("n_issues", fails).withColumn("n_warnings", warns)


def verdict_counts(judged: DataFrame) -> DataFrame:
    """Totals and pass rate (one decimal) in one row."""
    is_status = {s: F.count_if(F.col("status") == s) for s in ("PASS", "WARN", "FAIL")}
    return judged.agg(
        F.count("*").alias("total_samples"),
        is_status["PASS"].alias("passed"),
        is_status["WARN"].alias("warned"),
        is_status["FAIL"].alias("failed"),
        F.round(share(is_status["PASS"], F.count("*")), 1).alias("pass_rate"),
    )


def verdict_listing(judged: DataFrame) -> DataFrame:
    """Samples in report order: FAIL, WARN, others, each by sample."""
    first = F.when(F.col("status") == "FAIL", 0).when(F.col("status") == "WARN", 1).otherwise(2)
    return judged.withColumn("section", first).orderBy("section", "sample_id")


def mapping_badge(pct: Column) -> Column:
    return F.when(pct > 85, "Excellent").when(pct > 70, "Good").otherwise("Check")


def band(pct: Column, good_above: float) -> Column:
    """``good`` above the bound, else ``warning``: 95 for trimming, 70 for assignment."""
    return F.when(pct > good_above, "good").otherwise("warning")


def trim_rates(trim: DataFrame) -> DataFrame:
    """Adds pass rate and too-short share in percent."""
    return trim.withColumn(
        "pass_rate", F.try_divide(F.lit(100.0) * F.col("passed"), F.col("total_pairs"))
    ).withColumn(
        "too_short_pct", F.try_divide(F.lit(100.0) * F.col("too_short"), F.col("total_pairs"))
    )
