"""The named questions over a project: who failed, how do groups compare.

Inputs are the long tables of ``project``: ``statuses(sample_id, status)``,
``metrics`` (one row per sample), ``axes(axis, value, sample_id)`` and
``groups(condition, sample_id)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.functions.stats import missing_as
from readloom.operators import project as P

_MEANS = ("mean_uniquely_mapped", "mean_assignment_rate")


def status(statuses: DataFrame, project_id: str) -> DataFrame:
    return P.status_summary(statuses).select(
        F.lit(project_id).alias("project_id"), "total_samples", "passed", "failed",
        F.concat(F.col("pass_rate").cast("string"), F.lit("%")).alias("pass_rate"),
    )


def failed(statuses: DataFrame) -> DataFrame:
    return statuses.where(F.col("status") != "PASS").select("sample_id")


def conditions(groups: DataFrame) -> DataFrame:
    return groups.select("condition").distinct()


def condition(groups: DataFrame, name: str) -> DataFrame:
    return groups.where(F.col("condition") == name).select("sample_id")


def _comparison(has_metrics: Column, missing: str, digits: int) -> list[Column]:
    unique = missing_as(F.col("uniquely_mapped_pct"), missing)
    assign = missing_as(F.col("assignment_rate"), missing)
    return [
        F.count("*").alias("n_samples"),
        F.round(F.avg(unique), digits).alias(_MEANS[0]),
        F.round(F.avg(assign), digits).alias(_MEANS[1]),
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count_if(has_metrics & F.coalesce(F.col("status") != "PASS", F.lit(True))).alias("failed"),
    ]


def compare(groups: DataFrame, metrics: DataFrame, digits: int = 2) -> DataFrame:
    """Per condition: samples, means, passed, failed.

    Samples without metrics count as samples but enter no mean.
    """
    joined = groups.join(metrics.withColumn("_seen", F.lit(True)), "sample_id", "left")
    return joined.groupBy("condition").agg(
        *_comparison(F.col("_seen").isNotNull(), "skip", digits))


def issues(qc: DataFrame) -> DataFrame:
    return P.project_issues(qc)


def stats(qc: DataFrame) -> DataFrame:
    return P.aggregate_stats(qc)


def axes_counts(axes: DataFrame) -> DataFrame:
    """Samples per value of every axis."""
    return axes.groupBy("axis", "value").agg(F.countDistinct("sample_id").alias("n_samples"))


def filter_samples(
    axes: DataFrame, filters: Mapping[str, str], statuses: DataFrame | None = None
) -> DataFrame:
    """Samples that match every ``axis = value``.

    Axis names match exactly, values without case; where several spellings
    match, the smallest one counts. An axis or value nobody has gives no rows.
    """
    if not filters:
        if statuses is None:
            raise ValueError("without filters the sample list is needed")
        return statuses.select("sample_id")
    axis, value = F.col("axis"), F.col("value")
    tests = [(axis == name) & (F.lower(value) == text.lower()) for name, text in filters.items()]
    # the chosen spelling of every filter, one row
    chosen = axes.agg(F.array(*[F.min(F.when(t, value)) for t in tests]).alias("c")).scalar()
    spelled = axes.withColumn("_chosen", chosen)
    hits = [test & (value == F.col("_chosen")[i]) for i, test in enumerate(tests)]
    matched = (
        spelled.where(reduce(or_, hits))
        .groupBy("sample_id").agg(*[F.bool_or(hit).alias(f"_hit_{i}") for i, hit in enumerate(hits)])
        .where(reduce(and_, [F.col(f"_hit_{i}") for i in range(len(hits))]))
        .select("sample_id")
    )
    if statuses is not None:
        matched = matched.join(statuses.select("sample_id"), "sample_id", "left_semi")
    return matched


def compare_axis(
    axes: DataFrame,
    metrics: DataFrame,
    axis: str,
    filters: Mapping[str, str] | None = None,
    statuses: DataFrame | None = None,
    digits: int = 2,
) -> DataFrame:
    """Per value of one axis: ``n_samples`` counts all filtered samples, means
    only those with metrics; values nobody has metrics for are dropped."""
    return compare_axes(axes.where(F.col("axis") == axis), metrics, axes, filters, statuses, digits).drop("axis")


def compare_axes(
    axes: DataFrame,
    metrics: DataFrame,
    filter_axes: DataFrame | None = None,
    filters: Mapping[str, str] | None = None,
    statuses: DataFrame | None = None,
    digits: int = 2,
) -> DataFrame:
    """``compare_axis`` for every axis present, in one aggregation."""
    members = axes
    if filters:
        keep = filter_samples(filter_axes if filter_axes is not None else axes, filters, statuses)
        members = members.join(keep, "sample_id", "left_semi")
    joined = members.join(metrics.withColumn("_seen", F.lit(True)), "sample_id", "left")
    out = joined.groupBy("axis", "value").agg(
        *_comparison(F.col("_seen").isNotNull(), "skip", digits),
        F.count("_seen").alias("_with_metrics"),
    )
    return out.where("_with_metrics > 0").drop("_with_metrics")


def axis_members(axes: DataFrame, axis: str) -> DataFrame:
    """``(value, sample_id)`` of one axis: the sample lists of a comparison."""
    return axes.where(F.col("axis") == axis).select("value", "sample_id")


def compare_columns(
    wide: DataFrame, axes: Sequence[str], digits: int = 2
) -> DataFrame:
    """All axes at once from wide metadata joined with metrics (GROUPING SETS).

    Null and blank values of an axis are not groups.
    """
    levels = {a: i for i, a in enumerate(axes)}
    sets = [[F.col(a)] for a in axes]
    grouped = wide.groupingSets(sets, *[F.col(a) for a in axes]).agg(
        F.grouping_id(*axes).alias("_gid"), *_comparison(F.lit(True), "skip", digits)
    )
    width = len(axes)
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for a, i in levels.items():
        # all bits set but the one of the grouped column
        mask = (2**width - 1) ^ (1 << (width - 1 - i))
        name = F.when(F.col("_gid") == mask, a).otherwise(name)
        value = F.when(F.col("_gid") == mask, F.col(a).cast("string")).otherwise(value)
    return (
        grouped.withColumn("axis", name).withColumn("value", value)
        .where("value is not null and trim(value) <> ''")
        .select("axis", "value", "n_samples", *_MEANS, "passed", "failed")
    )


def sample(
    sample_id: str, metrics: DataFrame, metadata_long: DataFrame, issue_rows: DataFrame
) -> DataFrame:
    """Everything known about one sample, as ``(section, name, value)`` rows.

    The filter runs before anything is combined, so it reaches each scan.
    """
    from readloom.operators.sample_qc import next_steps

    one = F.col("sample_id") == sample_id
    m = metrics.where(one)
    numbers = m.select(
        "sample_id",
        *[F.col(c).cast("string").alias(c) for c in m.columns if c != "sample_id"],
    )
    metric_rows = numbers.unpivot(
        "sample_id", [c for c in numbers.columns if c != "sample_id"], "name", "value"
    ).select(F.lit("metric").alias("section"), "name", "value")
    steps = m.select(F.posexplode(next_steps(F.col("status"))).alias("i", "value")).select(
        F.lit("next_step").alias("section"), F.col("i").cast("string").alias("name"), "value")
    meta = metadata_long.where(one).select(
        F.lit("metadata").alias("section"), F.col("axis").alias("name"), "value")
    found = issue_rows.where(one).select(
        F.lit("issue").alias("section"), F.col("severity").alias("name"),
        F.col("message").alias("value"))
    return metric_rows.unionByName(steps).unionByName(meta).unionByName(found)


def sheet_groups(sheet: DataFrame) -> DataFrame:
    """Counts per condition and per tissue of a sheet; blank tissues are left out."""
    parts = sheet.select("sample_id", F.explode(F.array(
        F.struct(F.lit("condition").alias("axis"),
                 F.coalesce("condition", F.lit("unknown")).alias("value")),
        F.struct(F.lit("tissue").alias("axis"), F.col("tissue").alias("value")),
    )).alias("g"))
    return (
        parts.select("sample_id", "g.*")
        .where("value is not null and (axis <> 'tissue' or value <> '')")
        .groupBy("axis", "value").agg(F.count("*").alias("n_samples"))
    )
