"""Queries on the parsers: the tables are written as log and report text, then parsed."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import fastqc_checks as E
from readloom.operators import project as P
from readloom.operators import sample_qc as Q
from readloom.operators.wide import matrix_arrays, place_names, sample_places
from readloom.plans import views as V
from readloom.plans.catalog import register
from readloom.session import scratch_path, written
from readloom.sinks import writers as K
from readloom.sources import fastqc, logs, matrix
from readloom.sources.documents import ISSUES, manifest_metadata_long
from readloom.sources.text import lines_of


def _text(*parts):
    return F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts])


def _reports(spark, sf):
    """A FastQC report text per sample."""
    m = V.metrics(spark, sf)
    number = {c: F.col(c).cast("string") for c in m.columns}
    return m.select("sample_id", F.concat_ws(
        "\n",
        F.lit("##FastQC\t0.12.1"), F.lit("outside\tline"),
        F.lit(">>Basic Statistics\tpass"), F.lit("#Measure\tValue"),
        _text("Total Sequences\t", F.format_number("total_reads", 0)),
        _text("%GC\t", F.floor("uniquely_mapped_pct").cast("string")), F.lit(""),
        F.lit(">>END_MODULE"), F.lit("between\tmodules"),
        _text(">>Per base N content\t", F.when(F.col("too_short_pct") > 4, "fail").otherwise("pass")),
        _text("  1\t", number["too_short_pct"], "\t "), _text("2-9\t", number["mismatch_rate"]),
        F.lit(">>END_MODULE"),
        F.lit(">>Sequence Duplication Levels\tfail"), F.lit(">>END_MODULE"),
        F.lit(">>No Status"), F.lit(">>END_MODULE"),
        F.lit(">>Adapter Content\twarn"), _text("1\t", number["mismatch_rate"], "\t\t0.5"),
        _text("2\t0.1\t", number["too_short_pct"], "\tx"),
        F.lit(">>END_MODULE"), F.lit("")).alias("text"))


@register("fastqc_report_rows", "metrics", """
    SELECT sample_id, 'Basic Statistics' AS "module", 'pass' status, 'Total Sequences|' || format('{:,}', total_reads) cells FROM metrics
    UNION ALL SELECT sample_id, 'Basic Statistics', 'pass', '%GC|' || CAST(floor(uniquely_mapped_pct) AS BIGINT) FROM metrics
    UNION ALL SELECT sample_id, 'Per base N content', CASE WHEN too_short_pct > 4 THEN 'fail' ELSE 'pass' END, unnest(['1', '2-9']) FROM metrics
    UNION ALL SELECT sample_id, 'Sequence Duplication Levels', 'fail', '' FROM metrics
    UNION ALL SELECT sample_id, 'No Status', 'unknown', '' FROM metrics
    UNION ALL SELECT sample_id, 'Adapter Content', 'warn', unnest(['1', '2']) FROM metrics""")
def _(spark, sf):
    rows = fastqc.parse_fastqc(_reports(spark, sf))
    # engines print doubles differently, so measured modules show their label only
    label = F.when(F.col("module") == "Basic Statistics", F.array_join("cells", "|")).otherwise(
        F.coalesce(F.get("cells", F.lit(0)), F.lit("")))
    return rows.select("sample_id", "module", "status", label.alias("cells"))


@register("fastqc_report_status", "metrics", """
    SELECT sample_id, i n_issues, w n_warnings, CASE WHEN i > 0 THEN 'FAIL' WHEN w > 0 THEN 'WARN' ELSE 'PASS' END status FROM (
      SELECT sample_id, CAST(total_reads < 15000 AS BIGINT) + CAST(floor(uniquely_mapped_pct) < 32 AS BIGINT)
          + CAST(greatest(too_short_pct, mismatch_rate) > CAST(5.1 AS DOUBLE) AS BIGINT)
          + CAST(greatest(mismatch_rate, too_short_pct, 0.5) > 5 AS BIGINT) i,
        CAST(too_short_pct > 4 AS BIGINT) + CAST(greatest(too_short_pct, mismatch_rate) > 5 AND greatest(too_short_pct, mismatch_rate) <= CAST(5.1 AS DOUBLE) AS BIGINT) w
      FROM metrics)""")
def _(spark, sf):
    # every check reads the rows, so they are parsed once
    rows = written(fastqc.parse_fastqc(_reports(spark, sf)), "report-rows")
    out = E.report_status(rows, V.metrics(spark, sf), trimmed=True, min_total=15000, min_gc=32,
                          max_gc=70, max_n=5.0, critical_n=5.1, max_adapter=5)
    return out.drop("recommendation")


def _trim_lines(spark, sf):
    texts = V.metrics(spark, sf).select("sample_id", F.concat_ws(
        "\n", F.lit("This is a trimming log"),
        _text("Total read pairs processed:            ", F.format_number("total_reads", 0)),
        _text("Pairs that were too short:  ", F.format_number(F.floor(F.col("total_reads") / 50), 0), " (2.0%)"),
        F.lit("Pairs that were too short: none"),
        _text("Pairs written (passing filters): 1"),
        _text("Pairs written (passing filters): ", F.format_number(F.floor(F.col("total_reads") * 49 / 50), 0)),
        _text("Total basepairs processed: ", F.format_number(F.col("total_reads") * 202, 0), " bp")).alias("text"))
    return lines_of(texts, "sample_id")


@register("trim_log_metrics", "metrics", """SELECT sample_id, total_reads total_pairs, total_reads // 50 too_short, total_reads * 49 // 50 passed,
    total_reads * 202 total_bp, 100 * CAST(total_reads * 49 // 50 AS DOUBLE) / total_reads pass_rate,
    100 * CAST(total_reads // 50 AS DOUBLE) / total_reads too_short_pct FROM metrics""")
def _(spark, sf):
    return Q.trim_rates(logs.parse_trim_lines(_trim_lines(spark, sf)))


def _align_lines(spark, sf):
    r = F.col("total_reads")
    texts = V.metrics(spark, sf).select("sample_id", F.concat_ws(
        "\n", F.lit("                                 UNIQUE READS:"),
        _text("                          Number of input reads |\t", r.cast("string")),
        _text("                      Average input read length |\t202"),
        _text("                   Uniquely mapped reads number |\t", F.floor(r / 2).cast("string")),
        _text("                        Uniquely mapped reads % |\t", F.format_string("%d.25%%", (r % 100))),
        _text("                      Mismatch rate per base, % |\t0.31%"),
        _text("        Number of reads mapped to multiple loci |\t", F.floor(r / 10).cast("string")),
        _text("             % of reads mapped to multiple loci |\t3.50%"),
        _text("   Number of reads unmapped: too short |\t", F.floor(r / 7).cast("string")),
        _text("                 % of reads unmapped: too short |\t5.13%"),
        F.lit("two | bars | here")).alias("text"))
    return lines_of(texts, "sample_id")


@register("align_log_metrics", "metrics", """SELECT sample_id, total_reads, total_reads // 2 uniquely_mapped_reads, CAST(total_reads % 100 AS DOUBLE) + 0.25 uniquely_mapped_pct,
    total_reads // 10 multi_mapped_reads, CAST(3.5 AS DOUBLE) multi_mapped_pct, total_reads // 7 unmapped_too_short, CAST(5.13 AS DOUBLE) unmapped_too_short_pct,
    CAST(202 AS BIGINT) read_length, CAST(0.31 AS DOUBLE) mismatch_rate, total_reads // 2 + total_reads // 10 total_mapped_reads,
    CAST(total_reads // 2 + total_reads // 10 AS DOUBLE) / total_reads * 100 total_mapped_pct FROM metrics""")
def _(spark, sf):
    return logs.parse_align_lines(_align_lines(spark, sf))


@register("align_log_report", "metrics", """SELECT sample_id, total_reads input_reads, total_reads // 2 unique_mapped, CAST(total_reads % 100 AS DOUBLE) + 0.25 unique_mapped_pct,
    total_reads // 10 multi_mapped, CAST(3.5 AS DOUBLE) multi_mapped_pct, total_reads // 7 unmapped_short, CAST(5.13 AS DOUBLE) unmapped_short_pct FROM metrics""")
def _(spark, sf):
    return logs.parse_align_lines(_align_lines(spark, sf), "report")


@register("align_log_monitor", "metrics", """SELECT sample_id, (total_reads % 100) || '.25%' uniquely_mapped_pct, '3.50%' multi_mapped_pct,
    '5.13%' unmapped_too_short_pct, CAST(total_reads AS VARCHAR) total_reads FROM metrics""")
def _(spark, sf):
    return logs.parse_align_lines(_align_lines(spark, sf), "monitor")


@register("qc_record", "metrics", """SELECT sample_id, CASE WHEN total_reads % 100 + 0.25 < 50 THEN 'FAIL' WHEN total_reads % 100 + 0.25 < 70 OR assignment_rate < 50 THEN 'WARN' ELSE 'PASS' END overall_status,
    total_reads, assignment_rate, CAST(total_reads % 100 + 0.25 < 70 AS INT) + CAST(assignment_rate < 50 AS INT) n_issues FROM metrics""")
def _(spark, sf):
    align = logs.parse_align_lines(_align_lines(spark, sf))
    assign = V.metrics(spark, sf).select("sample_id", "assignment_rate", *[
        F.lit(0).cast("bigint").alias(c) for c in (
            "assigned_reads", "unassigned_multimapping", "unassigned_nofeatures", "unassigned_ambiguity")])
    docs = Q.qc_record(align, assign)
    return docs.select(
        "sample_id", "overall_status", "sequencing.total_reads", "quantification.assignment_rate",
        F.size("issues").alias("n_issues"))


# Matrices with a column for each supplier: their cells are arrays, as a plan with so many columns would not end.


def _supplier_places(spark, sf):
    return written(sample_places(V.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("sample_id"))), "supplier-places")


def _bam(sample):
    return _text("out/aligned/", sample, "/Aligned.sortedByCoord.out.bam")


@register("assignment_matrix_to_long", "assignment_long", "SELECT sample_id, category, reads FROM assignment_long")
def _(spark, sf):
    places = _supplier_places(spark, sf)
    wide = matrix_arrays(V.assignment_long(spark, sf).withColumnRenamed("category", "Status"), places, "Status", "reads", fill=None)
    return matrix.long_assignment(wide, place_names(places, _bam(F.col("sample_id"))))


@register("count_matrix_to_long", "counts_long", """SELECT sample_id, count(*) n_genes, CAST(sum(count) AS BIGINT) total,
    count(*) FILTER (count > 0) detected FROM (
      SELECT s.sample_id, coalesce(count, 0) count FROM (SELECT DISTINCT sample_id FROM counts_long) s
      CROSS JOIN (SELECT DISTINCT gene_id FROM counts_long) g LEFT JOIN counts_long c ON c.sample_id = s.sample_id AND c.gene_id = g.gene_id) GROUP BY 1""")
def _(spark, sf):
    places = _supplier_places(spark, sf)
    raw = matrix_arrays(V.counts_long(spark, sf).withColumnRenamed("gene_id", "Geneid"), places, "Geneid", "count").select(
        "Geneid", *[F.lit("x").alias(c) for c in matrix.GENE_COLUMNS[1:]], "cells")
    return matrix.long_counts(raw, names=place_names(places, _bam(F.col("sample_id")))).groupBy("sample_id").agg(
        F.count("*").alias("n_genes"), F.sum("count").alias("total"),
        F.count_if(F.col("count") > 0).alias("detected"))


MATRIX = """matrix AS (SELECT g.gene_id, s.sample_id, coalesce(c.count, 0) count, CAST(g.gene_id AS BIGINT) no
      FROM (SELECT DISTINCT sample_id FROM counts_long) s CROSS JOIN (SELECT DISTINCT gene_id FROM counts_long) g
      LEFT JOIN counts_long c ON c.sample_id = s.sample_id AND c.gene_id = g.gene_id)"""


@register("clean_matrix_round_trip", "counts_long", f"""WITH {MATRIX} SELECT gene_id, sample_id, count,
    dense_rank() OVER (ORDER BY no DESC) row FROM matrix""")
def _(spark, sf):
    # rows in an order that is not that of the ids, kept by one file
    target = scratch_path(spark, "matrix")
    counts = V.counts_long(spark, sf).withColumn("no", -F.col("gene_id").cast("bigint"))
    K.write_clean_matrix(counts, None, target, files=1, order="no", compression="gzip")
    return matrix.read_clean_counts(spark, target, numbered=True)


@register("clean_matrix_files", "counts_long", f"""WITH {MATRIX} SELECT sample_id, count(*) n_genes, CAST(sum(count) AS BIGINT) total,
    count(*) FILTER (count = 0) zeros FROM matrix GROUP BY 1""")
def _(spark, sf):
    target = scratch_path(spark, "matrix-files")
    K.write_clean_matrix(V.counts_long(spark, sf), V.counts_long(spark, sf), target, files=7, compression="gzip")
    return matrix.read_clean_counts(spark, target).groupBy("sample_id").agg(
        F.count("*").alias("n_genes"), F.sum("count").alias("total"), F.count_if(F.col("count") == 0).alias("zeros"))


@register("manifest_json_round_trip", "sheet judged", """
    SELECT sample_id, axis, value FROM (SELECT sample_id, unnest(['condition', 'genome_build']) axis, unnest([condition, genome_build]) AS value FROM sheet)
    WHERE value <> '' AND sample_id IN (SELECT sample_id FROM judged)""")
def _(spark, sf):
    from readloom.operators.sheets import manifest_metadata
    from readloom.sources.documents import MANIFEST_SCHEMA

    meta = manifest_metadata(V.sheet(spark, sf), ["condition", "genome_build"])
    docs = V.judged_with_issues(spark, sf).join(meta, "sample_id").select(F.to_json(F.struct(
        "sample_id", "sample_metadata",
        F.struct(F.col("status").alias("overall_status"), F.col("issues").cast(ISSUES).alias("issues"))
        .alias("qc_metrics"))).alias("doc"))
    schema = MANIFEST_SCHEMA.rsplit(",", 1)[0]
    return manifest_metadata_long(docs.select(F.from_json("doc", schema).alias("d")).select("d.*"))


@register("metadata_axes_from_wide", "axes", "SELECT axis, value, sample_id FROM axes WHERE axis IN ('condition', 'sex')")
def _(spark, sf):
    return P.sample_axes(P.metadata_to_long(V.sheet(spark, sf).select(
        "sample_id", "condition", "sex", "notes", "replicate")))
