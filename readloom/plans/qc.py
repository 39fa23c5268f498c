"""Queries on verdicts and report checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import fastqc_checks as E
from readloom.operators import reads as RD
from readloom.operators import rules as R
from readloom.operators import sample_qc as Q
from readloom.plans import views as V
from readloom.plans.catalog import register


@register("assignment_rate_four", "assignment_long", """
    SELECT sample_id, CAST(coalesce(sum(reads) FILTER (category = 'Assigned'), 0) AS BIGINT) assigned_reads,
           CAST(coalesce(sum(reads) FILTER (category = 'Unassigned_MultiMapping'), 0) AS BIGINT) unassigned_multimapping,
           CAST(coalesce(sum(reads) FILTER (category = 'Unassigned_NoFeatures'), 0) AS BIGINT) unassigned_nofeatures,
           CAST(coalesce(sum(reads) FILTER (category = 'Unassigned_Ambiguity'), 0) AS BIGINT) unassigned_ambiguity,
           CAST(100 * sum(reads) FILTER (category = 'Assigned') AS DOUBLE) / CAST(sum(reads) AS DOUBLE) assignment_rate
    FROM assignment_long GROUP BY 1""")
def _(spark, sf):
    return Q.assignment_metrics(V.assignment_long(spark, sf), "four")


@register("assignment_rate_all", "assignment_long", """
    SELECT sample_id, CAST(100 * sum(reads) FILTER (category = 'Assigned') AS DOUBLE) / CAST(sum(reads) AS DOUBLE)
           assignment_rate FROM assignment_long GROUP BY 1""")
def _(spark, sf):
    return Q.assignment_rate(V.assignment_long(spark, sf), "all")


@register("sample_qc_status", "judged",
          "SELECT sample_id, uniquely_mapped_pct, assignment_rate, status FROM judged")
def _(spark, sf):
    return V.judged(spark, sf).select("sample_id", "uniquely_mapped_pct", "assignment_rate", "status")


@register("sample_issues", "issues", "SELECT * FROM issues")
def _(spark, sf):
    return Q.sample_issues(V.metrics(spark, sf), V.table_rules())


@register("sample_recommendations", "judged issues", """
    SELECT sample_id, status, CASE status WHEN 'PASS' THEN 1 WHEN 'WARN' THEN 2 ELSE 3 END
             + CASE WHEN status = 'PASS' THEN 0 ELSE coalesce(n, 0) END n_lines,
           CASE status WHEN 'PASS' THEN 'differential_expression,pathway_analysis,gene_set_enrichment'
                WHEN 'WARN' THEN 'review_qc_report,conditional_differential_expression'
                ELSE 'exclude_from_analysis,consider_resequencing' END next_steps
    FROM judged LEFT JOIN (SELECT sample_id, CAST(count(*) AS INT) n FROM issues GROUP BY 1) USING (sample_id)""")
def _(spark, sf):
    rows = V.judged_with_issues(spark, sf)
    messages = F.transform("issues", lambda i: i["message"])
    return rows.select(
        "sample_id", "status", F.size(Q.recommendations(F.col("status"), messages)).alias("n_lines"),
        F.array_join(Q.next_steps(F.col("status")), ",").alias("next_steps"))


@register("rule_findings_long", "metrics", """
    SELECT sample_id, 'alignment' source, CASE WHEN mismatch_rate > 5.2 THEN 2 ELSE 1 END severity,
           'mismatch_rate' code, mismatch_rate AS value,
           CASE WHEN mismatch_rate > 5.2 THEN CAST(5.2 AS DOUBLE) ELSE CAST(5.0 AS DOUBLE) END threshold
    FROM metrics WHERE mismatch_rate > 5.0
    UNION ALL
    SELECT sample_id, 'trimming', CASE WHEN too_short_pct >= 5 THEN 2 ELSE 1 END, 'too_short_pct', too_short_pct,
           CASE WHEN too_short_pct >= 5 THEN 5.0 ELSE 4.0 END FROM metrics WHERE too_short_pct >= 4""")
def _(spark, sf):
    rules = R.with_bounds(
        [r for r in R.TOOL_RULES if r.metric in ("mismatch_rate", "too_short_pct")],
        mismatch_rate=(5.0, 5.2), too_short_pct=(4, 5))
    names = ["mismatch_rate", "too_short_pct"]
    long = V.metrics(spark, sf).unpivot("sample_id", names, "metric", "value")
    return R.apply_rules(long, rules).drop("message")


_TOOLS = """
    SELECT *, CASE WHEN n_issues > 0 THEN 'FAIL' WHEN n_warnings > 0 THEN 'WARN' ELSE 'PASS' END status FROM (
      SELECT sample_id,
        CAST(too_short_pct >= 5.5 AS INT) + CAST(uniquely_mapped_pct < 31.5 AS INT) + CAST(unmapped_short_pct > 25 AS INT)
          + CAST(mismatch_rate > 5.3 AS INT) + CAST(assignment_rate < 47 AS INT) n_issues,
        CAST(too_short_pct >= 4.5 AND too_short_pct < 5.5 AS INT) + CAST(uniquely_mapped_pct < 32.5 AND uniquely_mapped_pct >= 31.5 AS INT)
          + CAST(unmapped_short_pct > 24 AND unmapped_short_pct <= 25 AS INT)
          + CAST(mismatch_rate > 5.1 AND mismatch_rate <= 5.3 AS INT)
          + CAST(assignment_rate < 48 AND assignment_rate >= 47 AS INT) n_warnings
      FROM metrics)"""


def tool_verdicts(spark, sf):
    rules = R.with_bounds(
        R.TOOL_RULES, too_short_pct=(4.5, 5.5), uniquely_mapped_pct=(32.5, 31.5),
        unmapped_short_pct=(24, 25), mismatch_rate=(5.1, 5.3), assignment_rate=(48, 47))
    return Q.tool_verdict(V.metrics(spark, sf), rules).select(
        "sample_id", "n_issues", "n_warnings", "status")


@register("tool_verdict", "metrics", _TOOLS)
def _(spark, sf):
    return tool_verdicts(spark, sf)


@register("tool_verdict_counts", "metrics", f"""
    SELECT count(*) total_samples, count(*) FILTER (status = 'PASS') passed, count(*) FILTER (status = 'WARN') warned,
           count(*) FILTER (status = 'FAIL') failed,
           round(CAST(100 * count(*) FILTER (status = 'PASS') AS DOUBLE) / count(*), 1) pass_rate FROM ({_TOOLS})""")
def _(spark, sf):
    return Q.verdict_counts(tool_verdicts(spark, sf))


@register("tool_verdict_listing", "metrics", f"""
    SELECT sample_id, status, CASE status WHEN 'FAIL' THEN 0 WHEN 'WARN' THEN 1 ELSE 2 END AS section
    FROM ({_TOOLS}) ORDER BY section, sample_id""")
def _(spark, sf):
    return Q.verdict_listing(tool_verdicts(spark, sf)).select("sample_id", "status", "section")


@register("quality_bands", "metrics", """
    SELECT sample_id, CASE WHEN uniquely_mapped_pct > 85 THEN 'Excellent' WHEN uniquely_mapped_pct > 70 THEN 'Good'
           ELSE 'Check' END mapping, CASE WHEN 100 - too_short_pct > 95 THEN 'good' ELSE 'warning' END trimming,
           CASE WHEN assignment_rate > 50 THEN 'good' ELSE 'warning' END assignment FROM metrics""")
def _(spark, sf):
    return V.metrics(spark, sf).select(
        "sample_id", Q.mapping_badge(F.col("uniquely_mapped_pct")).alias("mapping"),
        Q.band(F.lit(100) - F.col("too_short_pct"), 95).alias("trimming"),
        Q.band(F.col("assignment_rate"), 50).alias("assignment"))


@register("config_profile_status", "metrics", """
    SELECT sample_id, CASE WHEN uniquely_mapped_pct < 70 OR assignment_rate < 60 OR mismatch_rate > 2
           THEN 'WARN' ELSE 'PASS' END status FROM metrics""")
def _(spark, sf):
    return R.verdict(V.metrics(spark, sf), R.CONFIG_RULES).select("sample_id", "status")


@register("assay_profile_status", "metrics", """
    SELECT sample_id,
           CASE WHEN mean_coverage < 30 THEN 'FAIL' WHEN pct_20x < 90 OR ti_tv_ratio < 1.8 OR ti_tv_ratio > 2.2 THEN 'WARN'
                ELSE 'PASS' END wgs,
           CASE WHEN mitochondrial_pct > 30 THEN 'FAIL' WHEN tss_enrichment < 5 THEN 'WARN' ELSE 'PASS' END atac,
           CASE WHEN frip < 0.01 THEN 'FAIL' WHEN peak_count < 1000 OR nsc < 1.05 THEN 'WARN' ELSE 'PASS' END chip
    FROM (SELECT sample_id, uniquely_mapped_pct - 2 mean_coverage, assignment_rate + 42 pct_20x, mismatch_rate - 3 ti_tv_ratio,
                 mismatch_rate tss_enrichment, unmapped_short_pct + 10 mitochondrial_pct,
                 too_short_pct / 400 frip, total_reads / 15 peak_count, mismatch_rate / 4.8 nsc FROM metrics)""")
def _(spark, sf):
    m = V.metrics(spark, sf).select(
        "sample_id", (F.col("uniquely_mapped_pct") - 2).alias("mean_coverage"),
        (F.col("assignment_rate") + 42).alias("pct_20x"), (F.col("mismatch_rate") - 3).alias("ti_tv_ratio"),
        F.col("mismatch_rate").alias("tss_enrichment"),
        (F.col("unmapped_short_pct") + 10).alias("mitochondrial_pct"),
        (F.col("too_short_pct") / 400).alias("frip"), (F.col("total_reads") / 15).alias("peak_count"),
        (F.col("mismatch_rate") / 4.8).alias("nsc"))
    return m.select(
        "sample_id",
        R.status_name(R.severity(R.WGS_RULES)).alias("wgs"),
        R.status_name(R.severity(R.ATAC_RULES)).alias("atac"),
        R.status_name(R.severity(R.CHIP_RULES)).alias("chip"))


# --- report checks on profiles computed from reads ----------------------------------

BASIC = """SELECT sample_id, count(*) total_sequences,
    CAST(floor(CAST(sum(length(seq) - length(translate(seq, 'GC', ''))) * 100 AS DOUBLE)
         / CAST(sum(length(seq) - length(translate(seq, 'ACGT', ''))) AS DOUBLE)) AS BIGINT) gc
    FROM reads GROUP BY 1"""
_POSITIONS = """
    SELECT sample_id, pos, CAST(sum(quality * n) AS DOUBLE) / CAST(sum(n) AS DOUBLE) mean,
           CAST(100 * sum(n_base) AS DOUBLE) / CAST(sum(n) AS DOUBLE) n_pct FROM base_histogram GROUP BY 1, 2"""
_QUANTILES = """
    SELECT sample_id, pos, quantile_cont(quality, 0.5) median, quantile_cont(quality, 0.25) lower_quartile,
           quantile_cont(quality, 0.75) upper_quartile, quantile_cont(quality, 0.1) p10, quantile_cont(quality, 0.9) p90
    FROM (SELECT sample_id, pos, CAST(ascii(substr(qual, CAST(pos AS INT), 1)) - 33 AS DOUBLE) quality
          FROM (SELECT sample_id, qual, unnest(generate_series(1, length(qual))) pos FROM reads)) GROUP BY 1, 2"""


def positions(spark, sf):
    profile = RD.position_profile(RD.base_histogram(V.reads(spark, sf)))
    return profile.withColumn("row_no", F.col("pos")).withColumn("position", F.col("pos").cast("string"))


@register("check_basic_stats", "reads", f"""
    SELECT sample_id, 'basic' source, 2 severity, 'total_sequences' code, CAST(total_sequences AS DOUBLE) AS value,
           CAST(200 AS DOUBLE) threshold FROM ({BASIC}) WHERE total_sequences < 200
    UNION ALL SELECT sample_id, 'basic', 2, 'gc', gc, CASE WHEN gc < 49 THEN 49 ELSE 50 END
    FROM ({BASIC}) WHERE gc < 49 OR gc > 50""")
def _(spark, sf):
    return E.check_basic_stats(RD.basic_statistics(V.reads(spark, sf)), 200, 49, 50).drop("message")


@register("check_base_quality", "reads base_histogram", f"""
    WITH q AS (SELECT *, CASE WHEN median < 20 THEN 2 WHEN median < 26 THEN 1 WHEN lower_quartile < 10 THEN 2 ELSE 0 END grade
               FROM ({_QUANTILES}))
    SELECT sample_id, 'base_quality' source, CASE WHEN max(grade) = 2 THEN 2 ELSE 1 END severity, 'base_quality' code,
           CASE WHEN max(grade) = 2 THEN 'Critical: Low quality at positions: ' || (
               SELECT string_agg(l, ', ' ORDER BY pos) FROM (
                 SELECT pos, CASE WHEN median < 20 THEN printf('%d (Q%.1f)', CAST(pos AS BIGINT), round(median, 1))
                             ELSE printf('%d (LQ%.1f)', CAST(pos AS BIGINT), round(lower_quartile, 1)) END l
                 FROM q i WHERE i.sample_id = q.sample_id AND grade = 2))
             ELSE 'Warning: Quality below Q26 at ' || count(*) FILTER (grade = 1) || ' positions' END message,
           CAST(CASE WHEN max(grade) = 2 THEN count(*) FILTER (grade = 2) ELSE count(*) FILTER (grade = 1) END AS DOUBLE) AS value,
           CAST(CASE WHEN max(grade) = 2 THEN 20 ELSE 26 END AS DOUBLE) threshold
    FROM q GROUP BY sample_id HAVING max(grade) > 0""")
def _(spark, sf):
    return E.check_base_quality(positions(spark, sf), 26)


_READ_QUALITY = """
    SELECT sample_id, CAST(floor(CAST(total AS DOUBLE) / len) AS INT) quality, count(*) reads FROM (
      SELECT sample_id, list_sum(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33)) total, length(qual) len
      FROM reads WHERE length(qual) > 0) GROUP BY 1, 2"""


@register("check_read_quality", "reads", f"""
    SELECT sample_id, 'read_quality' source, 1 severity, 'q30_pct' code, q30_pct AS value, CAST(75 AS DOUBLE) threshold FROM (
      SELECT sample_id, CAST(100 * coalesce(sum(reads) FILTER (quality >= 30), 0) AS DOUBLE) / CAST(sum(reads) AS DOUBLE) q30_pct
      FROM ({_READ_QUALITY}) GROUP BY 1) WHERE q30_pct < 75""")
def _(spark, sf):
    return E.check_read_quality(RD.read_quality_histogram(V.reads(spark, sf))).drop("message")


@register("check_n_content", "base_histogram", f"""
    SELECT sample_id, 'n_content' source, CASE WHEN n > 60 THEN 2 ELSE 1 END severity, 'n_content' code, n AS value,
           CAST(CASE WHEN n > 60 THEN 60 ELSE 40 END AS DOUBLE) threshold
    FROM (SELECT sample_id, max(n_pct) n FROM ({_POSITIONS}) GROUP BY 1) WHERE n > 40""")
def _(spark, sf):
    return E.check_n_content(
        RD.n_profile(RD.base_histogram(V.reads(spark, sf))), 40.0, 60.0).drop("message")


_ADAPTER = """
    SELECT sample_id, p.pos, max(pct) adapter_pct FROM (
      SELECT sample_id, adapter, pos, CAST(100 * sum(CASE WHEN pos > 0 THEN n ELSE 0 END) OVER (
               PARTITION BY sample_id, adapter ORDER BY pos) AS DOUBLE)
             / CAST(sum(n) OVER (PARTITION BY sample_id, adapter) AS DOUBLE) pct
      FROM (SELECT sample_id, adapter, instr(seq, motif) pos, count(*) n
            FROM reads, (VALUES ('a', 'ACGT'), ('b', 'GTCA')) m(adapter, motif) GROUP BY ALL)) s
      JOIN (SELECT DISTINCT sample_id sid, instr(seq, motif) pos FROM reads, (VALUES ('ACGT'), ('GTCA')) m(motif)) p
        ON s.sample_id = p.sid AND s.pos <= p.pos
    WHERE p.pos > 0 GROUP BY 1, 2"""
MOTIFS = ["ACGT", "GTCA"]


@register("adapter_content", "reads", _ADAPTER)
def _(spark, sf):
    return RD.adapter_content(V.reads(spark, sf), MOTIFS)


@register("check_adapter", "reads", f"""
    SELECT sample_id, 'adapter' source, 2 severity, 'adapter_content' code,
           printf('Adapter content after trimming: %.2f%% (should be <30%%)', max(adapter_pct)) message, max(adapter_pct) AS value, CAST(30 AS DOUBLE) threshold
    FROM ({_ADAPTER}) GROUP BY 1 HAVING max(adapter_pct) > 30""")
def _(spark, sf):
    return E.check_adapter(RD.adapter_content(V.reads(spark, sf), MOTIFS), True, 30)


@register("check_adapter_untrimmed", "reads", f"""
    SELECT sample_id, 'adapter' source, 1 severity, 'adapter_content' code,
           printf('Adapter content: %.2f%% - Trimming recommended', max(adapter_pct)) message, max(adapter_pct) AS value, CAST(10 AS DOUBLE) threshold
    FROM ({_ADAPTER}) GROUP BY 1 HAVING max(adapter_pct) > 10""")
def _(spark, sf):
    return E.check_adapter(RD.adapter_content(V.reads(spark, sf), MOTIFS), False)


@register("check_modules", "module_status", """
    SELECT sample_id, 'modules' source, 1 severity, "module" code, 'Module FAIL: ' || "module" message
    FROM module_status WHERE status = 'fail'""")
def _(spark, sf):
    return E.check_modules(V.module_status(spark, sf)).select(
        "sample_id", "source", "severity", "code", "message")


def _report_status(spark, sf):
    found = E.check_modules(V.module_status(spark, sf)).unionByName(
        E.check_basic_stats(RD.basic_statistics(
            V.reads(spark, sf).withColumn("sample_id", _lang_source())), 30, 45, 55))
    listed = V.table(spark, sf, "documents").select(
        F.concat("lang", F.lit("_"), "source").alias("sample_id")).distinct()
    seen = V.module_status(spark, sf).select("sample_id").distinct().withColumn("seen", F.lit(True))
    listed = listed.join(seen, "sample_id", "left").withColumn("seen", F.coalesce("seen", F.lit(False)))
    return R.status_from_findings(found, listed, present="seen").drop("seen")


def _lang_source():
    return F.concat(F.substring_index("file", "_", -1), F.lit("_"), F.substring_index("file", "_", 1))


_REPORT_STATUS = """
    SELECT s.sample_id, coalesce(n_issues, 0) n_issues, coalesce(n_warnings, 0) n_warnings,
           CASE WHEN m.sample_id IS NULL THEN 'ERROR' WHEN n_issues > 0 THEN 'FAIL' WHEN n_warnings > 0 THEN 'WARN'
                ELSE 'PASS' END status
    FROM (SELECT DISTINCT lang || '_' || source sample_id FROM documents) s
    LEFT JOIN (SELECT DISTINCT sample_id FROM module_status) m ON s.sample_id = m.sample_id
    LEFT JOIN (SELECT sample_id, count(*) FILTER (severity = 2) n_issues, count(*) FILTER (severity = 1) n_warnings FROM (
        SELECT sample_id, 1 severity FROM module_status WHERE status = 'fail'
        UNION ALL SELECT sample_id, 2 FROM b WHERE total_sequences < 30
        UNION ALL SELECT sample_id, 2 FROM b WHERE gc < 45 OR gc > 55) GROUP BY 1) f ON s.sample_id = f.sample_id"""
_B = f"WITH b AS ({BASIC.replace('SELECT sample_id', 'SELECT split_part(file, chr(95), 2) || chr(95) || split_part(file, chr(95), 1) sample_id')})"


@register("report_status", "module_status reads", _B + _REPORT_STATUS)
def _(spark, sf):
    return _report_status(spark, sf)


@register("report_status_counts", "module_status reads",
          f"{_B} SELECT status, count(*) n FROM ({_REPORT_STATUS}) GROUP BY 1")
def _(spark, sf):
    return E.status_counts(_report_status(spark, sf))


@register("report_order", "module_status reads", f"""{_B}
    SELECT sample_id, status, CAST(CASE status WHEN 'FAIL' THEN 1 WHEN 'WARN' THEN 2 WHEN 'PASS' THEN 3 ELSE 4 END AS INT) AS section
    FROM ({_REPORT_STATUS}) ORDER BY section, sample_id""")
def _(spark, sf):
    return E.report_order(_report_status(spark, sf)).select("sample_id", "status", "section")


@register("multiqc_check_verdict", "module_status", """
    SELECT sample_id, bool_and(expected OR status IN ('pass', 'warn', '')) overall_pass,
           coalesce(string_agg(DISTINCT CASE WHEN expected AND status = 'fail' THEN source END, ',' ORDER BY
             CASE WHEN expected AND status = 'fail' THEN source END), '') expected_fails
    FROM (SELECT lang sample_id, source, source IN ('src0', 'src1', 'src2', 'src3') expected,
            CASE WHEN toxic = 1 THEN 'fail' WHEN quality = 1 THEN 'pass' ELSE 'warn' END status
          FROM labels JOIN documents USING (doc_id)) GROUP BY 1""")
def _(spark, sf):
    rows = V.module_status(spark, sf).select(
        F.substring_index("sample_id", "_", 1).alias("sample_id"),
        F.substring_index("sample_id", "_", -1).alias("check"), "status")
    return E.multiqc_check_verdict(rows, expected=["src0", "src1", "src2", "src3"])
