"""Checks on FastQC reports. Input: long report rows, one line per row.

``rows(sample_id, module, status, row_no, cells array<string>)`` comes from
``sources.fastqc``; each check reads a typed view of it, so the same checks run
on profiles computed from reads. All findings share one schema.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.stats import share
from readloom.operators.rules import FAIL, WARN, status_from_findings

IDS = ("sample_id",)


def _found(
    df: DataFrame, when: Column | None, source: str, severity: Column | int, code: Column | str,
    message: Column, value: Column, threshold: Column | float,
) -> DataFrame:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    df = df if when is None else df.where(when)
    return df.select(
        "sample_id",
        F.lit(source).alias("source"),
        lit(severity).cast("int").alias("severity"),
        lit(code).alias("code"),
        message.alias("message"),
        value.cast("double").alias("value"),
        lit(threshold).cast("double").alias("threshold"),
    )


def _cell(i: int) -> Column:
    return F.try_element_at("cells", F.lit(i + 1))


# --- typed views over report rows -------------------------------------------------


def basic_stats(rows: DataFrame) -> DataFrame:
    """``(sample_id, total_sequences, gc)``; a repeated measure keeps its last row."""
    named = rows.where((F.col("module") == "Basic Statistics") & (F.size("cells") >= 2))
    measure, value = _cell(0), _cell(1)

    def last(name: str) -> Column:
        return F.max_by(F.when(measure == name, value), F.when(measure == name, F.col("row_no")))

    return named.groupBy("sample_id").agg(
        F.replace(last("Total Sequences"), F.lit(","), F.lit("")).try_cast("bigint")
        .alias("total_sequences"),
        last("%GC").try_cast("bigint").alias("gc"),
    )


def position_quality(rows: DataFrame) -> DataFrame:
    named = rows.where((F.col("module") == "Per base sequence quality") & (F.size("cells") >= 7))
    return named.select(
        "sample_id", "row_no", _cell(0).alias("position"),
        *[_cell(i).try_cast("double").alias(n) for i, n in enumerate(
            ["mean", "median", "lower_quartile", "upper_quartile", "p10", "p90"], start=1)],
    )


def read_quality(rows: DataFrame) -> DataFrame:
    named = rows.where((F.col("module") == "Per sequence quality scores") & (F.size("cells") >= 2))
    return named.select(
        "sample_id",
        _cell(0).try_cast("double").alias("quality"),
        _cell(1).try_cast("double").alias("reads"),
    )


def n_content(rows: DataFrame) -> DataFrame:
    named = rows.where((F.col("module") == "Per base N content") & (F.size("cells") >= 2))
    return named.select(
        "sample_id", _cell(0).alias("position"), _cell(1).try_cast("double").alias("n_pct")
    )


def adapter_rows(rows: DataFrame) -> DataFrame:
    """Largest adapter column per position; blank cells are skipped."""
    named = rows.where((F.col("module") == "Adapter Content") & (F.size("cells") >= 2))
    numbers = F.transform(F.slice("cells", 2, F.size("cells") - 1), lambda c: c.try_cast("double"))
    return named.select(
        "sample_id", _cell(0).alias("position"), F.array_max(numbers).alias("adapter_pct")
    )


def module_status(rows: DataFrame) -> DataFrame:
    return rows.select("sample_id", "module", "status").distinct()


# --- checks ------------------------------------------------------------------------


def check_basic_stats(
    stats: DataFrame, min_total: int = 1_000_000, min_gc: int = 30, max_gc: int = 70
) -> DataFrame:
    """Too few sequences, or GC outside the range. Missing measures raise nothing."""
    total, gc = F.col("total_sequences"), F.col("gc")

    def cell(code: str, message: Column, value: Column, threshold: Column) -> Column:
        return F.struct(
            F.lit("basic").alias("source"), F.lit(FAIL).alias("severity"), F.lit(code).alias("code"),
            message.alias("message"), value.cast("double").alias("value"),
            threshold.cast("double").alias("threshold"))

    low = F.when(total < min_total, cell(
        "total_sequences",
        F.concat(F.lit("Total Sequences too low: "), F.format_number(total, 0),
                 F.lit(f" (minimum: {min_total:,})")),
        total, F.lit(min_total)))
    outside = F.when((gc < min_gc) | (gc > max_gc), cell(
        "gc",
        F.concat(F.lit("GC content out of range: "), gc.cast("string"),
                 F.lit(f"% (expected: {min_gc}-{max_gc}%)")),
        gc, F.when(gc < min_gc, min_gc).otherwise(max_gc)))
    # one pass over the statistics for both tests
    return stats.select(
        "sample_id", F.explode(F.array_compact(F.array(low, outside))).alias("f")
    ).select("sample_id", "f.*")


def grade_positions(positions: DataFrame, min_median: float = 28) -> DataFrame:
    """Adds ``grade`` (2 critical, 1 warning, 0 ok) and its label; branch order matters."""
    median, lower = F.col("median"), F.col("lower_quartile")
    return positions.withColumn(
        "grade",
        F.when(median < 20, 2).when(median < min_median, 1).when(lower < 10, 2).otherwise(0),
    ).withColumn(
        "label",
        F.when(median < 20, F.format_string("%s (Q%.1f)", F.col("position").cast("string"), median))
        .when((F.col("grade") == 2),
              F.format_string("%s (LQ%.1f)", F.col("position").cast("string"), lower)),
    )


def check_base_quality(positions: DataFrame, min_median: float = 28, shown: int | None = None) -> DataFrame:
    """Critical positions win over warnings; the message names them all, or the first ``shown``.

    One pass: a sample has one row per position, however many reads it has.
    """
    worst_first = W.partitionBy("sample_id").orderBy(F.desc("grade"), "row_no")
    ranked = grade_positions(positions, min_median).withColumn(
        "rank", F.row_number().over(worst_first))
    named = F.col("grade") == 2
    if shown is not None:
        named = named & (F.col("rank") <= shown)
    judged = ranked.groupBy("sample_id").agg(
        F.count_if(F.col("grade") == 2).alias("n_critical"),
        F.count_if(F.col("grade") == 1).alias("n_warning"),
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.when(named, F.struct("rank", "label")))),
            lambda x: x["label"]), ", ").alias("labels"),
    ).where("n_critical + n_warning > 0")
    critical = F.col("n_critical") > 0
    return _found(
        judged, None, "base_quality", F.when(critical, FAIL).otherwise(WARN), "base_quality",
        F.when(critical, F.concat(F.lit("Critical: Low quality at positions: "), "labels"))
        .otherwise(F.concat(F.lit(f"Warning: Quality below Q{min_median:g} at "),
                            F.col("n_warning").cast("string"), F.lit(" positions"))),
        F.when(critical, F.col("n_critical")).otherwise(F.col("n_warning")),
        F.when(critical, 20.0).otherwise(float(min_median)),
    )


def q30_share(quality: DataFrame, floor: float = 30) -> DataFrame:
    return quality.groupBy("sample_id").agg(
        share(F.sum(F.when(F.col("quality") >= floor, F.col("reads")).otherwise(0)),
              F.sum("reads")).alias("q30_pct"))


def check_read_quality(quality: DataFrame, min_q30_pct: float = 75) -> DataFrame:
    pct = F.col("q30_pct")
    return _found(
        q30_share(quality), pct < min_q30_pct, "read_quality", WARN, "q30_pct",
        F.concat(F.format_string("Low Q30+ reads: %.1f%%", pct),
                 F.lit(f" (expected: >{min_q30_pct}%)")),
        pct, min_q30_pct,
    )


def check_n_content(rows: DataFrame, warn: float = 5.0, critical: float = 10.0) -> DataFrame:
    worst = rows.groupBy("sample_id").agg(F.max("n_pct").alias("n_pct"))
    pct = F.col("n_pct")
    return _found(
        worst, pct > warn, "n_content", F.when(pct > critical, FAIL).otherwise(WARN), "n_content",
        F.when(pct > critical,
               F.concat(F.format_string("Critical: High N content: %.1f%%", pct),
                        F.lit(f" (max allowed: {critical}%)")))
        .otherwise(F.concat(F.format_string("Warning: N content: %.1f%%", pct),
                            F.lit(f" (recommended: <{warn}%)"))),
        pct, F.when(pct > critical, critical).otherwise(warn),
    )


def check_adapter(
    rows: DataFrame, trimmed: bool, max_trimmed: float = 1.0, warn_raw: float = 10.0
) -> DataFrame:
    """Adapter left after trimming is critical.

    Before trimming, content above ``warn_raw`` is a warning.
    """
    worst = rows.groupBy("sample_id").agg(F.max("adapter_pct").alias("adapter_pct"))
    pct = F.col("adapter_pct")
    if trimmed:
        return _found(
            worst, pct > max_trimmed, "adapter", FAIL, "adapter_content",
            F.concat(F.format_string("Adapter content after trimming: %.2f%%", pct),
                     F.lit(f" (should be <{max_trimmed}%)")),
            pct, max_trimmed,
        )
    return _found(
        worst, pct > warn_raw, "adapter", WARN, "adapter_content",
        F.concat(F.format_string("Adapter content: %.2f%%", pct),
                 F.lit(" - Trimming recommended")),
        pct, warn_raw,
    )


def check_modules(
    modules: DataFrame, trimmed: bool = False,
    tolerated: Sequence[str] = tuple(K.TOLERATED_MODULES),
    ignored: Sequence[str] = tuple(K.IGNORED_MODULES),
) -> DataFrame:
    """A failed module is a warning unless its failure is expected."""
    excused = [m for m in [*tolerated, *ignored] if not (trimmed and m == K.TRIM_SENSITIVE_MODULE)]
    module = F.col("module")
    after_trim = (module == K.TRIM_SENSITIVE_MODULE) & module.isin(list(tolerated))
    return _found(
        modules, (F.col("status") == "fail") & ~module.isin(excused), "modules", WARN, module,
        F.concat(F.lit("Module FAIL: "), module,
                 F.when(after_trim, " (should pass after trimming)").otherwise("")),
        F.lit(None), F.lit(None),
    )


# Bounds set in the run configuration, next to the code defaults above.
CONFIG_BOUNDS = {"min_total": 5_000_000, "min_gc": 35, "max_gc": 65}


def report_findings(rows: DataFrame, trimmed: bool = False, **bounds) -> DataFrame:
    """All checks of one report set in one table.

    Every check reads ``rows``: pass a stored table (``session.written``) when
    they are parsed from files.
    """
    basic = {k: v for k, v in bounds.items() if k in ("min_total", "min_gc", "max_gc")}
    parts = [
        check_basic_stats(basic_stats(rows), **basic),
        check_base_quality(position_quality(rows), bounds.get("min_median", 28)),
        check_n_content(n_content(rows), bounds.get("max_n", 5.0), bounds.get("critical_n", 10.0)),
        check_modules(module_status(rows), trimmed),
        check_read_quality(read_quality(rows), bounds.get("min_q30_pct", 75)),
    ]
    parts.append(check_adapter(adapter_rows(rows), trimmed, bounds.get("max_adapter", 1.0), bounds.get("warn_adapter", 10.0)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def report_status(rows: DataFrame, samples: DataFrame, trimmed: bool = False, **bounds) -> DataFrame:
    """Status, counts and recommendation per expected sample; no report is ERROR."""
    seen = rows.select("sample_id").distinct().withColumn("has_report", F.lit(True))
    listed = samples.select("sample_id").join(seen, "sample_id", "left").withColumn(
        "has_report", F.coalesce("has_report", F.lit(False)))
    judged = status_from_findings(
        report_findings(rows, trimmed, **bounds), listed, present="has_report")
    return judged.drop("has_report").withColumn("recommendation", recommendation(F.col("status")))


def recommendation(status: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, text in K.REPORT_RECOMMENDATION.items():
        out = F.when(status == name, text).otherwise(out)
    return out


def status_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("status").agg(F.count("*").alias("n"))


def report_order(judged: DataFrame) -> DataFrame:
    """FAIL, WARN, PASS, ERROR, each by sample."""
    section = F.array_position(F.array(*[F.lit(s) for s in ["FAIL", "WARN", "PASS", "ERROR"]]),
                               F.col("status"))
    return judged.withColumn("section", section.cast("int")).orderBy("section", "sample_id")


def multiqc_check_verdict(
    checks: DataFrame, file_col: str = "sample_id",
    expected: Sequence[str] = tuple(K.EXPECTED_FAIL_CHECKS),
) -> DataFrame:
    """Per file: pass unless a check outside ``expected`` is neither pass, warn nor blank.

    ``checks(file, check, status)`` is long; ``multiqc_checks`` makes it from a
    wide table.
    """
    is_expected = F.col("check").isin(list(expected))
    fine = F.coalesce(F.col("status"), F.lit("")).isin("pass", "warn", "")
    failed = F.when(is_expected & (F.col("status") == "fail"), F.col("check"))
    return checks.groupBy(file_col).agg(
        F.bool_and(is_expected | fine).alias("overall_pass"),
        # bounded: only names of the expected list enter the set
        F.array_join(F.array_sort(F.collect_set(failed)), ",").alias("expected_fails"),
    )


def multiqc_checks(
    wide: DataFrame, file_col: str = "Sample", skip: Sequence[str] = tuple(K.NOT_A_CHECK)
) -> DataFrame:
    """Unpivot the check columns of a MultiQC FastQC table."""
    names = [c for c in wide.columns if c not in skip]
    cols = [F.col(f"`{c}`").cast("string").alias(c) for c in names]
    return (
        wide.select(F.col(f"`{file_col}`").alias("sample_id"), *cols)
        .unpivot("sample_id", names, "check", "status")
    )
