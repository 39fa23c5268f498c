"""Declarative threshold rules: metrics in, findings and verdicts out.

A rule compares one metric with a warning and a failing bound. Rules are
parameters of a query, so they compile into one expression per rule: judging a
table is a projection, with no join and no shuffle.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, WARN, FAIL, ERROR = 0, 1, 2, 3
STATUS = ["PASS", "WARN", "FAIL", "ERROR"]

FINDING_SCHEMA = (
    "source string, severity int, code string, message string, value double, threshold double"
)

_OPS = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


@dataclass(frozen=True)
class Rule:
    """``value op bound`` raises the severity; a missing bound never fires."""

    metric: str
    op: str
    warn: float | None
    fail: float | None
    category: str
    template: str = ""
    missing: str = "zero"

    def message(self, value: Column) -> Column:
        return F.format_string(self.template or f"{self.metric}: %.1f", value)


def status_name(severity: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATUS]), severity + 1)


def _value(rule: Rule) -> Column:
    value = F.col(rule.metric).cast("double")
    return F.coalesce(value, F.lit(0.0)) if rule.missing == "zero" else value


def rule_severity(rule: Rule) -> Column:
    """Severity of one rule on a row that has the metric as a column."""
    value, out = _value(rule), F.lit(PASS)
    test = _OPS[rule.op]
    if rule.warn is not None:
        out = F.when(test(value, F.lit(float(rule.warn))), WARN).otherwise(out)
    if rule.fail is not None:
        out = F.when(test(value, F.lit(float(rule.fail))), FAIL).otherwise(out)
    return out


def severity(rules: Sequence[Rule]) -> Column:
    """Highest severity over all rules; the order of rules does not matter."""
    each = [rule_severity(r) for r in rules]
    return each[0] if len(each) == 1 else F.greatest(*each)


def verdict(metrics: DataFrame, rules: Sequence[Rule], out: str = "status") -> DataFrame:
    """``metrics`` with a status column."""
    return metrics.withColumn(out, status_name(severity(rules)))


def findings(
    metrics: DataFrame, rules: Sequence[Rule], ids: Sequence[str] = ("sample_id",)
) -> DataFrame:
    """One row per rule that fires, in the common findings schema."""
    cells = []
    for rule in rules:
        level, value = rule_severity(rule), _value(rule)
        bound = F.when(level == FAIL, F.lit(rule.fail).cast("double")).otherwise(
            F.lit(rule.warn).cast("double")
        )
        cells.append(
            F.when(
                level > PASS,
                F.struct(
                    F.lit(rule.category).alias("source"),
                    level.alias("severity"),
                    F.lit(rule.metric).alias("code"),
                    rule.message(value).alias("message"),
                    value.alias("value"),
                    bound.alias("threshold"),
                ),
            )
        )
    fired = F.explode(F.array_compact(F.array(*cells))).alias("f")
    return metrics.select(*ids, fired).select(*ids, "f.*")


def pivot_metrics(
    metrics_long: DataFrame, names: Sequence[str], ids: Sequence[str] = ("sample_id",)
) -> DataFrame:
    """Long ``(ids, metric, value)`` to one row per id with the named metrics."""
    named = metrics_long.where(F.col("metric").isin(list(names)))
    return named.groupBy(*ids).agg(
        *[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in names]
    )


def apply_rules(
    metrics_long: DataFrame, rules: Sequence[Rule], ids: Sequence[str] = ("sample_id",)
) -> DataFrame:
    """Findings from a long metrics table."""
    names = list(dict.fromkeys(r.metric for r in rules))
    return findings(pivot_metrics(metrics_long, names, ids), rules, ids)


def status_from_findings(
    found: DataFrame, samples: DataFrame, id_col: str = "sample_id", present: str | None = None
) -> DataFrame:
    """Status per sample: the worst finding, PASS without one.

    ``present`` names a boolean column of ``samples``; where it is false there
    was nothing to judge and the status is ERROR.
    """
    worst = found.groupBy(id_col).agg(
        F.max("severity").alias("severity"),
        F.count_if(F.col("severity") >= FAIL).alias("n_issues"),
        F.count_if(F.col("severity") == WARN).alias("n_warnings"),
    )
    out = samples.join(worst, id_col, "left")
    level = F.coalesce(F.col("severity"), F.lit(PASS))
    if present:
        level = F.when(F.col(present), level).otherwise(ERROR)
    return (
        out.withColumn("status", status_name(level))
        .withColumn("n_issues", F.coalesce("n_issues", F.lit(0)))
        .withColumn("n_warnings", F.coalesce("n_warnings", F.lit(0)))
        .drop("severity")
    )


# Threshold profiles.
SAMPLE_RULES = [
    Rule("uniquely_mapped_pct", "<", 70, 50, "alignment", "Low uniquely mapped rate: %.1f%%"),
    Rule("assignment_rate", "<", 50, 30, "quantification", "Low assignment rate: %.1f%%"),
]
CONFIG_RULES = [
    Rule("uniquely_mapped_pct", "<", 70, None, "alignment", "Low uniquely mapped rate: %.1f%%"),
    Rule("assignment_rate", "<", 60, None, "quantification", "Low assignment rate: %.1f%%"),
    Rule("mismatch_rate", ">", 2.0, None, "alignment", "High mismatch rate: %.2f%%", "skip"),
]
TOOL_RULES = [
    Rule("too_short_pct", ">=", 2, 5, "trimming", "Reads too short: %.1f%%", "skip"),
    Rule("uniquely_mapped_pct", "<", 75, 70, "alignment", "Uniquely mapped: %.2f%%", "skip"),
    Rule("unmapped_short_pct", ">", 13, 17, "alignment", "Unmapped (too short): %.2f%%", "skip"),
    Rule("mismatch_rate", ">", 1.5, 2, "alignment", "Mismatch rate: %.2f%%", "skip"),
    Rule("assignment_rate", "<", 50, 30, "quantification", "Assigned: %.1f%%", "skip"),
]
CHIP_RULES = [
    Rule("frip", "<", None, 0.01, "enrichment", "Very low FRiP score: %.4f"),
    Rule("peak_count", "<", 1000, None, "peaks", "Low peak count: %.0f"),
    Rule("nsc", "<", 1.05, None, "enrichment", "Low NSC (poor enrichment): %.3f"),
]
ATAC_RULES = [
    Rule("tss_enrichment", "<", 5, None, "enrichment", "Low TSS enrichment: %.2f"),
    Rule("mitochondrial_pct", ">", None, 30, "contamination",
         "High mitochondrial contamination: %.1f"),
]
WGS_RULES = [
    Rule("mean_coverage", "<", None, 30, "coverage", "Low mean coverage: %.1f"),
    Rule("pct_20x", "<", 90, None, "coverage", "Low coverage uniformity: %.1f"),
    Rule("ti_tv_ratio", "<", 1.8, None, "variants", "Unusual Ti/Tv ratio: %.2f"),
    Rule("ti_tv_ratio", ">", 2.2, None, "variants", "Unusual Ti/Tv ratio: %.2f"),
]
PROFILES = {
    "sample": SAMPLE_RULES,
    "config": CONFIG_RULES,
    "tools": TOOL_RULES,
    "chip-seq": CHIP_RULES,
    "atac-seq": ATAC_RULES,
    "wgs": WGS_RULES,
}


def with_bounds(rules: Sequence[Rule], **bounds: tuple[float | None, float | None]) -> list[Rule]:
    """A profile with other ``(warn, fail)`` bounds for some metrics."""
    return [
        replace(r, warn=bounds[r.metric][0], fail=bounds[r.metric][1]) if r.metric in bounds else r
        for r in rules
    ]
