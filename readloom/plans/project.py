"""Queries on project roll-ups and the named questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import artifacts as A
from readloom.operators import project as P
from readloom.operators import queries as Q
from readloom.operators import sample_qc as S
from readloom.plans import views as V
from readloom.plans.catalog import register
from readloom.session import written

STATUS_SUMMARY = """SELECT count(*) total_samples, count(*) FILTER (status = 'PASS') passed,
    count(*) - count(*) FILTER (status = 'PASS') failed,
    round(CAST(100 * count(*) FILTER (status = 'PASS') AS DOUBLE) / count(*), 2) pass_rate FROM judged"""
STATS = """SELECT {by} round(avg(uniquely_mapped_pct), 2) mean_uniquely_mapped_pct, round(avg(assignment_rate), 2) mean_assignment_rate,
    round(min(uniquely_mapped_pct), 2) min_uniquely_mapped_pct, round(max(uniquely_mapped_pct), 2) max_uniquely_mapped_pct,
    round(min(assignment_rate), 2) min_assignment_rate, round(max(assignment_rate), 2) max_assignment_rate FROM {src}"""
# every sample of the sheet, with the metrics of those that have at least one event
PARTIAL = """partial_metrics AS (SELECT m.* FROM judged m WHERE EXISTS (
    SELECT 1 FROM events WHERE CAST(user_id AS VARCHAR) = m.sample_id AND event_type = 'purchase' AND value > 80))"""


def partial_metrics(spark, sf):
    seen = V.table(spark, sf, "events").where("event_type = 'purchase' and value > 80").select(
        F.col("user_id").cast("string").alias("sample_id"))
    return V.judged(spark, sf).join(seen, "sample_id", "left_semi")


def groups(spark, sf):
    return P.condition_groups(V.sheet(spark, sf))


@register("status_summary", "judged", STATUS_SUMMARY)
def _(spark, sf):
    return P.status_summary(V.judged(spark, sf))


@register("sample_statuses", "judged", "SELECT sample_id, status FROM judged")
def _(spark, sf):
    return P.sample_metrics(V.judged(spark, sf)).select("sample_id", "status")


@register("condition_groups", "sheet", "SELECT condition, sample_id FROM sheet")
def _(spark, sf):
    return groups(spark, sf)


@register("sample_axes", "axes", "SELECT axis, value, sample_id FROM axes")
def _(spark, sf):
    return V.sheet_axes(spark, sf)


@register("sample_metrics", "judged", """SELECT CAST(user_id AS VARCHAR) sample_id, coalesce(uniquely_mapped_pct, 0) uniquely_mapped_pct,
    coalesce(assignment_rate, 0) assignment_rate, coalesce(total_reads, 0) total_reads, coalesce(status, 'UNKNOWN') status
    FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN judged ON CAST(user_id AS VARCHAR) = sample_id""")
def _(spark, sf):
    ids = V.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("sample_id")).distinct()
    return P.sample_metrics(ids.join(V.judged(spark, sf), "sample_id", "left"))


@register("aggregate_stats_missing_zero", "judged", STATS.format(by="", src="""(
    SELECT coalesce(uniquely_mapped_pct, 0) uniquely_mapped_pct, coalesce(assignment_rate, 0) assignment_rate
    FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN judged ON CAST(user_id AS VARCHAR) = sample_id)"""))
def _(spark, sf):
    ids = V.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("sample_id")).distinct()
    return P.aggregate_stats(ids.join(V.judged(spark, sf), "sample_id", "left"))


@register("aggregate_stats_by_project", "judged sheet", STATS.format(
    by="project_id,", src="judged JOIN sheet USING (sample_id) GROUP BY 1"))
def _(spark, sf):
    rows = V.judged(spark, sf).join(V.sheet(spark, sf).select("sample_id", "project_id"), "sample_id")
    return P.aggregate_stats(rows, by=["project_id"])


@register("project_issues", "judged issues",
          "SELECT sample_id, severity, message FROM issues JOIN judged USING (sample_id) WHERE status = 'FAIL'")
def _(spark, sf):
    return P.project_issues(V.judged_with_issues(spark, sf))


@register("align_overview", "metrics", """SELECT count(*) n_samples, round(avg(uniquely_mapped_pct), 2) avg_uniquely_mapped_pct,
    count(*) FILTER (uniquely_mapped_pct < 33) n_low_mapping FROM metrics""")
def _(spark, sf):
    return P.align_overview(V.metrics(spark, sf), 33)


@register("low_mapping_samples", "metrics",
          "SELECT sample_id, uniquely_mapped_pct FROM metrics WHERE uniquely_mapped_pct < 33")
def _(spark, sf):
    return P.low_mapping_samples(V.metrics(spark, sf), 33).select("sample_id", "uniquely_mapped_pct")


@register("biological_samples", "sheet", """
    SELECT count(DISTINCT regexp_replace(name, '[_-][12]$', '')) FILTER (name NOT LIKE '%.bam%'
             AND regexp_replace(name, '[_-][12]$', '') <> '') n_samples
    FROM (SELECT replace(s_name, 'Supplier#', 'S') || CASE WHEN s_suppkey % 3 = 0 THEN '_1' WHEN s_suppkey % 3 = 1 THEN '.bam' ELSE '-2' END AS name FROM supplier
          UNION ALL SELECT replace(s_name, 'Supplier#', 'S') || '_2' FROM supplier)""")
def _(spark, sf):
    k, stem = F.col("s_suppkey"), F.replace("s_name", F.lit("Supplier#"), F.lit("S"))
    end = F.when(k % 3 == 0, "_1").when(k % 3 == 1, ".bam").otherwise("-2")
    names = V.table(spark, sf, "supplier").select(
        F.explode(F.array(F.concat(stem, end), F.concat(stem, F.lit("_2")))).alias("sample"))
    return P.biological_samples(names)


@register("qc_overview", "judged module_status", """
    WITH v AS (SELECT * FROM judged), f AS (SELECT sample_id, bool_and(status <> 'fail') ok FROM module_status GROUP BY 1)
    SELECT (SELECT count(*) FROM v) qc_total, (SELECT count(*) FROM v WHERE status = 'PASS') qc_passed,
           (SELECT count(*) FROM v WHERE status = 'WARN') qc_warned, (SELECT count(*) FROM v WHERE status = 'FAIL') qc_failed,
           (SELECT round(CAST(100 * count(*) FILTER (status = 'PASS') AS DOUBLE) / count(*), 1) FROM v) qc_pass_rate,
           (SELECT count(*) FROM f) files_evaluated, (SELECT count(*) FROM f WHERE ok) files_pass,
           (SELECT count(*) FROM f WHERE NOT ok) files_fail, (SELECT count(*) FROM v) n_samples,
           (SELECT round(avg(uniquely_mapped_pct), 2) FROM v) avg_uniquely_mapped_pct,
           (SELECT count(*) FROM v WHERE uniquely_mapped_pct < 33) n_low_mapping""")
def _(spark, sf):
    from readloom.operators.fastqc_checks import multiqc_check_verdict

    files = multiqc_check_verdict(
        V.module_status(spark, sf).withColumnRenamed("module", "check"), expected=[])
    judged = written(V.judged(spark, sf), "judged")
    return P.qc_overview(judged, files, judged, 33)


@register("batch_summary", "judged sheet run_events", """
    SELECT project_id, CASE WHEN errors > 0 THEN 'failed' ELSE 'success' END status,
           CASE WHEN errors > 0 THEN 'error' ELSE '' END failed_step, duration_sec, qc_pass,
           printf('%.1f%%', pct) mapping_pct, '' error
    FROM (SELECT 'PRJ_' || (CAST(run AS BIGINT) % 4) project_id, count(*) FILTER (rule = 'error' AND k > 98) errors,
                 CAST(sum(k) AS BIGINT) duration_sec FROM run_events GROUP BY 1)
    JOIN (SELECT project_id, bool_and(status <> 'FAIL') qc_pass, avg(uniquely_mapped_pct) pct
          FROM judged JOIN sheet USING (sample_id) GROUP BY 1) USING (project_id)""")
def _(spark, sf):
    errors = F.count_if((F.col("rule") == "error") & (F.col("k") > 98)) > 0
    runs = V.events(spark, sf).groupBy(
        F.concat(F.lit("PRJ_"), (F.col("run").cast("bigint") % 4).cast("string")).alias("project_id")
    ).agg(
        F.when(errors, "failed").otherwise("success").alias("status"),
        F.when(errors, "error").alias("failed_step"), F.sum("k").alias("duration_sec"),
        F.lit(None).cast("string").alias("error"))
    judged = V.judged(spark, sf).join(V.sheet(spark, sf).select("sample_id", "project_id"), "sample_id")
    judged = written(judged, "judged")
    return P.batch_summary(runs, judged, judged)


@register("project_rows", "judged axes issues", f"""
    SELECT 'demo' project_id, 'project' AS section, 'pipeline_type' AS name, NULL sample_id, 'rna-seq' AS value
    UNION ALL SELECT 'demo', 'qc_summary', unnest(['total_samples', 'passed', 'failed', 'pass_rate']), NULL,
      unnest([CAST(total_samples AS VARCHAR), CAST(passed AS VARCHAR), CAST(failed AS VARCHAR), CAST(pass_rate AS VARCHAR)]) FROM ({STATUS_SUMMARY})
    UNION ALL SELECT 'demo', 'sample_statuses', 'status', sample_id, status FROM judged
    UNION ALL SELECT 'demo', 'sample_axes', axis, sample_id, value FROM axes
    UNION ALL SELECT 'demo', 'issues', severity, sample_id, message FROM issues JOIN judged USING (sample_id) WHERE status = 'FAIL'""")
def _(spark, sf):
    # all sections read the judged samples, so they are computed once
    judged = written(V.judged_with_issues(spark, sf), "judged")
    rows = P.project_rows("demo", judged, V.sheet_axes(spark, sf))
    # numbers inside the other sections are checked by their own queries
    return rows.where(~F.col("section").isin("aggregate_stats", "sample_metrics"))


# --- named questions ----------------------------------------------------------------


@register("project_status", "judged", f"""SELECT 'demo' project_id, total_samples, passed, failed,
    CAST(pass_rate AS VARCHAR) || '%' pass_rate FROM ({STATUS_SUMMARY})""")
def _(spark, sf):
    return Q.status(V.judged(spark, sf), "demo")


@register("failed_samples", "judged", "SELECT sample_id FROM judged WHERE status <> 'PASS'")
def _(spark, sf):
    return Q.failed(V.judged(spark, sf))


@register("condition_names", "sheet", "SELECT DISTINCT condition FROM sheet")
def _(spark, sf):
    return Q.conditions(groups(spark, sf))


@register("samples_of_condition", "sheet", "SELECT sample_id FROM sheet WHERE condition = 'ASIA'")
def _(spark, sf):
    return Q.condition(groups(spark, sf), "ASIA")


COMPARE = """count(*) n_samples, round(avg(uniquely_mapped_pct), 2) mean_uniquely_mapped,
    round(avg(assignment_rate), 2) mean_assignment_rate, count(*) FILTER (status = 'PASS') passed,
    count(*) FILTER (m.sample_id IS NOT NULL AND status <> 'PASS') failed"""


@register("compare_conditions", "sheet judged",
          f"SELECT condition, {COMPARE} FROM sheet s LEFT JOIN judged m ON s.sample_id = m.sample_id GROUP BY 1")
def _(spark, sf):
    return Q.compare(groups(spark, sf), V.judged(spark, sf))


@register("issue_list", "judged issues",
          "SELECT sample_id, severity, message FROM issues JOIN judged USING (sample_id) WHERE status = 'FAIL'")
def _(spark, sf):
    return Q.issues(V.judged_with_issues(spark, sf))


@register("project_stats", "judged", STATS.format(by="", src="judged"))
def _(spark, sf):
    return Q.stats(V.judged(spark, sf))


@register("axes_counts", "axes", "SELECT axis, value, count(*) n_samples FROM axes GROUP BY 1, 2")
def _(spark, sf):
    return Q.axes_counts(V.sheet_axes(spark, sf))


FILTERED = """SELECT sample_id FROM axes WHERE axis = 'condition' AND lower(value) = 'asia'
    INTERSECT SELECT sample_id FROM axes WHERE axis = 'sex' AND lower(value) = 'male'"""


@register("filter_samples", "axes judged",
          f"SELECT sample_id FROM judged WHERE sample_id IN ({FILTERED})")
def _(spark, sf):
    return Q.filter_samples(
        V.sheet_axes(spark, sf), {"condition": "asia", "sex": "MALE"}, V.judged(spark, sf))


@register("compare_axis", "axes judged", f"""WITH {PARTIAL}
    SELECT value, {COMPARE} FROM axes a LEFT JOIN partial_metrics m ON a.sample_id = m.sample_id
    WHERE axis = 'library_type' AND a.sample_id IN (SELECT sample_id FROM axes WHERE axis = 'sex' AND value = 'Male')
    GROUP BY 1 HAVING count(m.sample_id) > 0""")
def _(spark, sf):
    return Q.compare_axis(V.sheet_axes(spark, sf), partial_metrics(spark, sf), "library_type", {"sex": "male"})


@register("compare_all_axes", "axes judged", f"""WITH {PARTIAL}
    SELECT axis, value, {COMPARE} FROM axes a LEFT JOIN partial_metrics m ON a.sample_id = m.sample_id
    GROUP BY 1, 2 HAVING count(m.sample_id) > 0""")
def _(spark, sf):
    return Q.compare_axes(V.sheet_axes(spark, sf), partial_metrics(spark, sf))


@register("compare_columns", "sheet judged", f"""
    SELECT 'condition' axis, condition AS value, {COMPARE} FROM sheet JOIN judged m USING (sample_id) GROUP BY 2
    UNION ALL SELECT 'sex', sex, {COMPARE} FROM sheet JOIN judged m USING (sample_id) GROUP BY 2
    UNION ALL SELECT 'batch', batch, {COMPARE} FROM sheet JOIN judged m USING (sample_id) WHERE batch IS NOT NULL GROUP BY 2""")
def _(spark, sf):
    wide = V.sheet(spark, sf).join(V.judged(spark, sf), "sample_id")
    return Q.compare_columns(wide, ["condition", "sex", "batch"])


@register("sample_details", "judged sheet issues", """
    SELECT 'metric' AS section, 'status' AS name, status AS value FROM judged WHERE sample_id = '7'
    UNION ALL SELECT 'metric', 'total_reads', CAST(total_reads AS VARCHAR) FROM judged WHERE sample_id = '7'
    UNION ALL SELECT 'metadata', 'condition', condition FROM sheet WHERE sample_id = '7'
    UNION ALL SELECT 'metadata', 'tissue', tissue FROM sheet WHERE sample_id = '7'
    UNION ALL SELECT 'issue', severity, message FROM issues WHERE sample_id = '7'
    UNION ALL SELECT 'next_step', CAST(generate_subscripts(s, 1) - 1 AS VARCHAR), unnest(s) FROM (
      SELECT CASE status WHEN 'PASS' THEN ['differential_expression', 'pathway_analysis', 'gene_set_enrichment']
        WHEN 'WARN' THEN ['review_qc_report', 'conditional_differential_expression']
        ELSE ['exclude_from_analysis', 'consider_resequencing'] END s FROM judged WHERE sample_id = '7')""")
def _(spark, sf):
    meta = P.metadata_to_long(V.sheet(spark, sf), columns=["condition", "tissue"])
    return Q.sample(
        "7", V.judged(spark, sf).select("sample_id", "status", "total_reads"), meta,
        S.sample_issues(V.metrics(spark, sf), V.table_rules()))


@register("sheet_groups", "sheet", """SELECT 'condition' axis, condition AS value, count(*) n_samples FROM sheet GROUP BY 2
    UNION ALL SELECT 'tissue', tissue, count(*) FROM sheet GROUP BY 2""")
def _(spark, sf):
    return Q.sheet_groups(V.sheet(spark, sf))


@register("merge_metadata", "sheet", """
    SELECT sample_id, axis, coalesce_value AS value FROM (
      SELECT sample_id, axis, arg_min(v, source) FILTER (true) coalesce_value FROM (
        SELECT sample_id, 'condition' axis, 1 source, condition v FROM sheet
        UNION ALL SELECT sample_id, 'genome_build', 1, genome_build FROM sheet
        UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'condition', 2, min(o_orderstatus) FROM orders GROUP BY 1
        UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'genome_build', 2, 'old' FROM orders GROUP BY 1
        UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'priority', 2, min(o_orderpriority) FROM orders GROUP BY 1) GROUP BY 1, 2)""")
def _(spark, sf):
    old = V.table(spark, sf, "orders").groupBy(F.col("o_custkey").cast("string").alias("sample_id")).agg(
        F.min("o_orderstatus").alias("condition"), F.lit("old").alias("genome_build"),
        F.min("o_orderpriority").alias("priority"))
    return P.merge_metadata(
        P.metadata_to_long(V.sheet(spark, sf), columns=["condition", "genome_build"]),
        P.metadata_to_long(old))


@register("handover_gate", "judged artifacts", f"""SELECT *, counts_exist AND failed = 0 ready FROM (
    SELECT *, (SELECT bool_or(path LIKE '%/7') FROM artifacts) counts_exist FROM ({STATUS_SUMMARY}))""")
def _(spark, sf):
    from readloom.operators.de import handover_gate

    return handover_gate(V.judged(spark, sf), V.artifacts(spark, sf), "/7")


@register("storage_forecast", "", """
    SELECT source project_id, count(*) n_files, count(DISTINCT lang) n_samples, CAST(sum(n_chars) AS DOUBLE) / 1073741824 input_gib,
           CAST(sum(n_chars) AS DOUBLE) / 1073741824 * 5 output_gib, ceil(CAST(count(DISTINCT lang) AS DOUBLE) / 2) * CAST(0.5 AS DOUBLE) hours_min,
           ceil(CAST(count(DISTINCT lang) AS DOUBLE) / 2) * CAST(1.0 AS DOUBLE) hours_max, least(CAST(5 AS BIGINT), 2 * count(DISTINCT lang)) cores
    FROM documents GROUP BY 1""")
def _(spark, sf):
    listing = V.table(spark, sf, "documents").select(
        F.col("source").alias("project_id"), F.col("lang").alias("sample_id"), F.col("n_chars").alias("size"))
    return A.storage_forecast(listing, 5, 5).withColumn(
        "hours_min", F.col("hours_min").cast("double")).withColumn("hours_max", F.col("hours_max").cast("double"))
