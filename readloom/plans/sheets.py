"""Queries on sheets, manifests, validation and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.functions import text as T
from readloom.operators import joins as J
from readloom.operators import project as P
from readloom.operators import sheets as S
from readloom.operators import validation as X
from readloom.plans import views as V
from readloom.plans.catalog import register
from readloom.sources.sheets import last_rows, select_project


@register("sheet_project_filter", "sheet",
          "SELECT sample_id, fastq_1 fastq_r1, fastq_2 fastq_r2 FROM sheet WHERE project_id = 'PRJ_2'")
def _(spark, sf):
    from readloom.sources.sheets import resolve_aliases

    return resolve_aliases(select_project(V.sheet(spark, sf), "PRJ_2")).select(
        "sample_id", "fastq_r1", "fastq_r2")


@register("sheet_last_row_wins", "artifacts", """
    SELECT run sample_id, trim(arg_max(artifact, path)) artifact, arg_max(path, path) AS path FROM artifacts GROUP BY 1""")
def _(spark, sf):
    rows = V.artifacts(spark, sf).select(
        F.col("path").alias("_pos"), F.concat(F.lit(" "), "run").alias("sample_id"), "artifact", "path")
    return last_rows(rows, "_pos")


@register("assign_condition", "sheet", """
    SELECT sample_id, CASE WHEN lower(sample_name) LIKE '%hpc%' AND lower(sample_name) LIKE '%w' THEN 'both'
      WHEN lower(sample_name) LIKE '%pfc%' THEN 'cortex' WHEN lower(sample_name) LIKE '%hpc%' THEN 'hippo' ELSE 'unknown' END condition
    FROM (SELECT sample_id, sample_name FROM sheet)""".replace("lower(sample_name) LIKE '%hpc%' AND lower(sample_name) LIKE '%w'", "lower(sample_name) LIKE '%m\\_w%' ESCAPE '\\'"))
def _(spark, sf):
    patterns = {"hippo": ["Hpc"], "cortex": ["PFC", "ctx"], "both": ["M_w"]}
    return V.sheet(spark, sf).select(
        "sample_id", S.assign_condition(F.col("sample_name"), patterns).alias("condition"))


@register("infer_condition", "sheet", """
    SELECT sample_id, CASE WHEN sample_name LIKE '%\\_W' ESCAPE '\\' THEN 'wildtype' WHEN sample_name LIKE '%\\_H' ESCAPE '\\' THEN 'heterozygous'
           ELSE 'unknown' END condition FROM sheet""")
def _(spark, sf):
    return V.sheet(spark, sf).select(
        "sample_id", S.infer_condition(F.col("sample_name")).alias("condition"))


@register("number_replicates", "artifacts",
          "SELECT artifact condition, path sample_id, row_number() OVER (PARTITION BY artifact ORDER BY path) replicate FROM artifacts")
def _(spark, sf):
    rows = V.artifacts(spark, sf).select(F.col("artifact").alias("condition"), F.col("path").alias("sample_id"))
    return S.number_replicates(rows)


@register("missing_mates", "sheet", "SELECT sample_id FROM sheet WHERE fastq_2 IS NULL")
def _(spark, sf):
    return S.missing_mates(V.sheet(spark, sf).select(
        "sample_id", F.col("fastq_1").alias("r1"), F.col("fastq_2").alias("r2")))


@register("condition_counts", "sheet", """SELECT CASE WHEN sample_name LIKE '%W' THEN 'wildtype' ELSE 'heterozygous' END condition,
    count(*) n_samples FROM sheet WHERE sample_name NOT LIKE '%Q' GROUP BY 1""")
def _(spark, sf):
    rows = V.sheet(spark, sf).select("sample_id", S.infer_condition(F.col("sample_name")).alias("condition"))
    return S.condition_counts(rows)


@register("unassigned_samples", "sheet", "SELECT sample_id FROM sheet WHERE sample_name LIKE '%Q'")
def _(spark, sf):
    rows = V.sheet(spark, sf).select("sample_id", S.infer_condition(F.col("sample_name")).alias("condition"))
    return S.unassigned(rows)


@register("manifest_metadata", "sheet", """
    SELECT sample_id, 'condition=' || condition || CASE WHEN genome_build <> '' THEN ',genome_build=' || genome_build ELSE '' END ||
      CASE WHEN library_type <> '' THEN ',library_type=' || library_type ELSE '' END ||
      CASE WHEN n_nation <> 0 THEN ',batch=' || n_nation ELSE '' END ||
      CASE WHEN notes <> '' THEN ',notes=' || notes ELSE '' END meta
    FROM (SELECT sheet.*, s_nationkey n_nation FROM sheet JOIN supplier ON CAST(s_suppkey AS VARCHAR) = sample_id)""")
def _(spark, sf):
    batch = V.table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("sample_id"), F.col("s_nationkey").alias("batch"))
    rows = V.sheet(spark, sf).drop("batch").join(batch, "sample_id")
    fields = ["condition", "genome_build", "library_type", "batch", "notes"]
    kept = S.manifest_metadata(rows, fields)
    pairs = F.transform(F.map_entries("sample_metadata"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return kept.select("sample_id", F.array_join(pairs, ",").alias("meta"))


@register("backfill_metadata", "sheet", """
    SELECT c.sample_id, s.sample_id IS NOT NULL updated, CASE WHEN s.sample_id IS NULL THEN 'old' ELSE s.condition END condition,
           CASE WHEN s.sample_id IS NOT NULL THEN s.batch END batch
    FROM (SELECT CAST(c_custkey AS VARCHAR) sample_id FROM customer) c LEFT JOIN sheet s USING (sample_id)""")
def _(spark, sf):
    manifests = V.runs(spark, sf).select(
        F.col("run").alias("sample_id"),
        F.create_map(F.lit("condition"), F.lit("old")).alias("sample_metadata"))
    sheet = V.sheet(spark, sf).withColumn("batch", F.col("batch").cast("double"))
    done = S.backfill_metadata(manifests, S.sheet_metadata(sheet))
    return done.select(
        "sample_id", "updated", F.col("sample_metadata")["condition"].alias("condition"),
        F.col("sample_metadata")["batch"].alias("batch"))


@register("manifests_not_in_sheet", "sheet runs",
          "SELECT run sample_id FROM runs WHERE run NOT IN (SELECT sample_id FROM sheet)")
def _(spark, sf):
    return S.not_in_sheet(V.runs(spark, sf).withColumnRenamed("run", "sample_id"), V.sheet(spark, sf))


@register("sheet_to_snakemake", "sheet", """SELECT sample_id, condition, replicate, fastq_1 fastq_r1,
    coalesce(fastq_2, '') fastq_r2, notes FROM sheet WHERE library_type = 'RNA-seq'""")
def _(spark, sf):
    return S.to_workflow_sheet(V.sheet(spark, sf), "snakemake", "rna-SEQ")


@register("sheet_to_nextflow", "sheet", """SELECT sample_id sample, fastq_1, coalesce(fastq_2, '') fastq_2, replicate
    FROM sheet WHERE library_type = 'ATAC-seq'""")
def _(spark, sf):
    return S.to_workflow_sheet(V.sheet(spark, sf), "nextflow")


@register("sheet_to_wdl", "sheet", """SELECT sample_id, '{"sample_id":"' || sample_id || '","fastq_1":"' || fastq_1 || '","read_type":"' || read_type || '"' ||
    CASE WHEN coalesce(fastq_2, '') <> '' THEN ',"fastq_2":"' || fastq_2 || '"' ELSE '' END ||
    CASE WHEN genome_build <> '' THEN ',"reference_genome":"' || genome_build || '"' ELSE '' END || '}' sample
    FROM sheet WHERE library_type = 'WGS'""")
def _(spark, sf):
    return S.to_workflow_sheet(V.sheet(spark, sf), "wdl")


@register("library_targets", "sheet", """SELECT DISTINCT library_type, CASE library_type WHEN 'RNA-seq' THEN 'snakemake'
    WHEN 'WGS' THEN 'wdl' WHEN 'ATAC-seq' THEN 'nextflow' END target FROM sheet WHERE project_id = 'PRJ_1'""")
def _(spark, sf):
    return S.library_targets(V.sheet(spark, sf), "PRJ_1")


@register("parse_ids", "sheet", """SELECT sample_id, CASE WHEN regexp_matches(sample_name, '(?i)_HPC_') THEN 'HPC'
    WHEN regexp_matches(sample_name, '(?i)_PFC_') THEN 'PFC' ELSE 'Unknown' END tissue, sex,
    CASE right(sample_name, 1) WHEN 'W' THEN 'wildtype' WHEN 'H' THEN 'heterozygous' ELSE 'Unknown' END genotype FROM sheet""")
def _(spark, sf):
    return V.sheet(spark, sf).select(
        "sample_id", S.parse_ids(F.col("sample_name")).alias("p")).select("sample_id", "p.*")


@register("id_conflicts", "sheet", """SELECT sample_name sample_id, CASE WHEN sex = 'Male' THEN 'Male' ELSE 'Female' END in_id,
    CASE WHEN CAST(batch AS INT) = 1 THEN 'Male' ELSE 'Female' END in_sheet FROM sheet
    WHERE sex <> CASE WHEN CAST(batch AS INT) = 1 THEN 'Male' ELSE 'Female' END""")
def _(spark, sf):
    rows = V.sheet(spark, sf).select(
        F.col("sample_name").alias("sample_id"),
        F.when(F.col("batch") == "1", "Male").otherwise("Female").alias("sex"))
    return S.id_conflicts(rows)


@register("valid_identifiers", "", r"""SELECT doc_id, regexp_full_match(name, '[a-zA-Z0-9_-]+') AND length(name) <= 100 valid
    FROM (SELECT doc_id, text AS name FROM documents) UNION ALL
    SELECT -1 - s_suppkey, true FROM supplier WHERE s_name <> '' UNION ALL SELECT -100000 - c_custkey, false FROM customer WHERE c_name LIKE '%#%'""")
def _(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", F.col("text").alias("name"))
    good = V.table(spark, sf, "supplier").select(
        (-1 - F.col("s_suppkey")).alias("doc_id"), F.replace("s_name", F.lit("#"), F.lit("-")).alias("name"))
    bad = V.table(spark, sf, "customer").select((-100000 - F.col("c_custkey")).alias("doc_id"), F.col("c_name").alias("name"))
    names = docs.unionByName(good).unionByName(bad)
    return names.select("doc_id", T.valid_identifier(F.col("name")).alias("valid"))


# --- validation ---------------------------------------------------------------------


@register("validate_empty_values", "sheet", """SELECT 'project_id' AS "column", 0 n_null, 0 n_blank UNION ALL SELECT 'sample_id', 0, 0
    UNION ALL SELECT 'fastq_1', 0, 0 UNION ALL
    SELECT 'fastq_2', count(*) FILTER (fastq_2 IS NULL), count(*) FILTER (trim(fastq_2) = '') FROM sheet""")
def _(spark, sf):
    return X.empty_values(V.sheet(spark, sf))


@register("validate_duplicate_rows", "artifacts", """SELECT run sample_id, path FROM artifacts
    WHERE run IN (SELECT run FROM artifacts GROUP BY 1 HAVING count(*) > 1)""")
def _(spark, sf):
    return X.duplicate_rows(V.artifacts(spark, sf).select(F.col("run").alias("sample_id"), "path"))


@register("validate_duplicate_summary", "artifacts", """SELECT count(*) n_ids, CAST(sum(n) AS BIGINT) n_rows
    FROM (SELECT run, count(*) n FROM artifacts GROUP BY 1 HAVING count(*) > 1)""")
def _(spark, sf):
    return X.duplicate_summary(V.artifacts(spark, sf).select(F.col("run").alias("sample_id")))


@register("validate_numeric", "sheet", """SELECT 'replicate' AS "column", sample_id, replicate AS value FROM sheet
    WHERE TRY_CAST(replicate AS DOUBLE) IS NULL UNION ALL
    SELECT 'batch', sample_id, batch FROM sheet WHERE TRY_CAST(batch AS DOUBLE) IS NULL""")
def _(spark, sf):
    return X.non_numeric(V.sheet(spark, sf))


@register("validate_numeric_first_ids", "sheet", """SELECT * FROM (
    SELECT "column", sample_id, CAST(row_number() OVER (PARTITION BY "column" ORDER BY sample_id) AS INT) rank FROM (
      SELECT 'replicate' AS "column", sample_id FROM sheet WHERE TRY_CAST(replicate AS DOUBLE) IS NULL UNION ALL
      SELECT 'batch', sample_id FROM sheet WHERE TRY_CAST(batch AS DOUBLE) IS NULL)) WHERE rank <= 5""")
def _(spark, sf):
    return X.first_ids(X.non_numeric(V.sheet(spark, sf))).select("column", "sample_id", "rank")


@register("validate_allowed_values", "sheet", """SELECT 'read_type' AS "column", read_type AS value, count(*) n_rows FROM sheet
    WHERE read_type NOT IN ('single-end', 'paired-end', '') GROUP BY 2 UNION ALL
    SELECT 'library_type', library_type, count(*) FROM sheet
    WHERE library_type NOT IN ('RNA-seq', 'ChIP-seq', 'WGS', 'WES', 'ATAC-seq', '') GROUP BY 2""")
def _(spark, sf):
    return X.bad_values(V.sheet(spark, sf))


@register("validate_missing_files", "expected_artifacts artifacts", """
    SELECT run sample_id, 'R1' mate, '/a/' || run || '/' || artifact AS path FROM expected_artifacts e
    WHERE NOT EXISTS (SELECT 1 FROM artifacts a WHERE a.run = e.run AND a.artifact = e.artifact)""")
def _(spark, sf):
    path = F.concat(F.lit("/a/"), "run", F.lit("/"), "artifact")
    sheet = V.expected_artifacts(spark, sf).select(
        F.col("run").alias("sample_id"), path.alias("fastq_1"), F.lit(None).cast("string").alias("fastq_2"))
    return X.missing_files(sheet, V.artifacts(spark, sf).select(path.alias("path")))


@register("sheet_summary", "sheet", """SELECT count(*) total_samples, count(DISTINCT project_id) projects,
    count(DISTINCT condition) conditions FROM sheet""")
def _(spark, sf):
    return X.sheet_summary(V.sheet(spark, sf))


@register("sheet_value_counts", "sheet", """SELECT 'project_id' AS "column", project_id AS value, count(*) n FROM sheet GROUP BY 2
    UNION ALL SELECT 'condition', condition, count(*) FROM sheet GROUP BY 2""")
def _(spark, sf):
    return X.value_counts(V.sheet(spark, sf))


@register("project_filter_note", "sheet", """SELECT 'PRJ_3' project_id, count(*) FILTER (project_id = 'PRJ_3') n, count(*) total,
    'warning' AS level FROM sheet""")
def _(spark, sf):
    return X.project_filter_note(V.sheet(spark, sf), "PRJ_3")


@register("validation_findings", "sheet", """SELECT 'error' AS level, 'null' code, count(*) n FROM sheet WHERE false HAVING false
    UNION ALL SELECT 'error', 'null', 1 WHERE EXISTS (SELECT 1 FROM sheet WHERE fastq_2 IS NULL)
    UNION ALL SELECT 'error', 'blank', 1 WHERE EXISTS (SELECT 1 FROM sheet WHERE trim(fastq_2) = '')
    UNION ALL SELECT 'warning', 'unknown_column', 1
    UNION ALL SELECT 'warning', 'non_numeric', count(*) FROM (SELECT replicate v FROM sheet UNION ALL SELECT batch FROM sheet) WHERE TRY_CAST(v AS DOUBLE) IS NULL
    UNION ALL SELECT 'warning', 'bad_value', count(DISTINCT v) FROM (SELECT read_type v FROM sheet WHERE read_type = 'mate-pair' UNION ALL
      SELECT library_type FROM sheet WHERE library_type = 'Hi-C')""")
def _(spark, sf):
    return X.validate(V.sheet(spark, sf)).groupBy("level", "code").agg(F.count("*").alias("n"))


# --- joins --------------------------------------------------------------------------


@register("join_metrics", "sheet judged",
          "SELECT sample_id, condition, status, total_reads FROM sheet LEFT JOIN judged USING (sample_id)")
def _(spark, sf):
    return J.with_metrics(V.sheet(spark, sf).select("sample_id", "condition"), V.judged(spark, sf)).select(
        "sample_id", "condition", "status", "total_reads")


@register("sample_differences", "counts_long runs", """
    SELECT run sample_id, 'error' AS level, 'metadata' side FROM runs WHERE run NOT IN (SELECT sample_id FROM counts_long) UNION ALL
    SELECT DISTINCT gene_id, 'warning', 'counts' FROM counts_long WHERE gene_id NOT IN (SELECT run FROM runs)
      AND gene_id NOT IN (SELECT sample_id FROM counts_long) UNION ALL
    SELECT DISTINCT sample_id, 'warning', 'counts' FROM counts_long WHERE sample_id NOT IN (SELECT run FROM runs)""".replace(
    "SELECT run sample_id, 'error' AS level, 'metadata' side FROM runs WHERE run NOT IN (SELECT sample_id FROM counts_long) UNION ALL\n",
    "SELECT run sample_id, 'error' AS level, 'metadata' side FROM runs WHERE run NOT IN (SELECT sample_id FROM counts_long)\n      AND run NOT IN (SELECT gene_id FROM counts_long) UNION ALL\n"))
def _(spark, sf):
    counts = V.counts_long(spark, sf)
    ids = counts.select("sample_id").unionByName(counts.select(F.col("gene_id").alias("sample_id")))
    return J.differences(V.runs(spark, sf).withColumnRenamed("run", "sample_id"), ids)


@register("exclude_samples", "counts_long judged",
          "SELECT gene_id, sample_id, count FROM counts_long WHERE sample_id NOT IN (SELECT sample_id FROM judged WHERE status = 'FAIL')")
def _(spark, sf):
    return J.exclude(V.counts_long(spark, sf), V.judged(spark, sf).where("status = 'FAIL'"))


@register("intersect_filters", "axes", """SELECT sample_id FROM axes WHERE axis = 'sex' AND value = 'Male' INTERSECT
    SELECT sample_id FROM axes WHERE axis = 'batch' AND value = '1' INTERSECT
    SELECT sample_id FROM axes WHERE axis = 'condition' AND value <> 'ASIA'""")
def _(spark, sf):
    axes = V.sheet_axes(spark, sf)
    return J.intersect_all([
        axes.where("axis = 'sex' and value = 'Male'"), axes.where("axis = 'batch' and value = '1'"),
        axes.where("axis = 'condition' and value <> 'ASIA'")])


@register("match_names", "", """
    WITH known AS (SELECT DISTINCT 'D' || s_suppkey k FROM supplier),
    names AS (SELECT DISTINCT c_custkey || CASE WHEN c_custkey % 2 = 0 THEN 'd' ELSE 'D' END n FROM customer UNION
              SELECT 'd' || c_custkey FROM customer UNION SELECT 'D' || c_custkey FROM customer UNION SELECT c_mktsegment FROM customer)
    SELECT n AS name, CASE WHEN ok THEN 'D' || d END AS match, CASE WHEN ok THEN CASE WHEN n = 'D' || d THEN 0
             WHEN lower(n) = 'd' || d THEN 1 ELSE 2 END END way
    FROM (SELECT n, regexp_replace(n, '[^0-9]', '', 'g') d, regexp_replace(n, '[^0-9]', '', 'g') <> ''
            AND 'D' || regexp_replace(n, '[^0-9]', '', 'g') IN (SELECT k FROM known) ok FROM names)""")
def _(spark, sf):
    k = F.col("c_custkey").cast("string")
    names = V.table(spark, sf, "customer").select(F.explode(F.array(
        F.concat(k, F.when(F.col("c_custkey") % 2 == 0, "d").otherwise("D")),
        F.concat(F.lit("d"), k), F.concat(F.lit("D"), k), F.col("c_mktsegment"))).alias("name"))
    known = V.table(spark, sf, "supplier").select(
        F.concat(F.lit("D"), F.col("s_suppkey").cast("string")).alias("name"))
    return J.match_names(names, known)


@register("match_variants", "", """
    SELECT project_id, CASE WHEN k % 2 = 0 THEN project_id ELSE replace(project_id, '-', '_') END found
    FROM (SELECT c_custkey k, CASE WHEN c_custkey % 2 = 0 THEN 'p_' ELSE 'p-' END || c_custkey project_id FROM customer
          WHERE c_custkey IN (SELECT s_suppkey FROM supplier))""")
def _(spark, sf):
    k = F.col("c_custkey")
    ids = V.table(spark, sf, "customer").select(
        F.concat(F.when(k % 2 == 0, "p_").otherwise("p-"), k.cast("string")).alias("project_id"))
    listing = V.table(spark, sf, "supplier").select(
        F.concat(F.lit("p_"), F.col("s_suppkey").cast("string")).alias("name"))
    return J.match_variants(ids, listing)


@register("manifest_records", "judged sheet expected_artifacts artifacts", """
    SELECT s.sample_id, CASE WHEN n IS NULL THEN 'incomplete' ELSE 'completed' END status, coalesce(n, 0) n_outputs,
           coalesce(m.status, 'UNKNOWN') overall_status, s.condition FROM sheet s
    LEFT JOIN judged m USING (sample_id)
    LEFT JOIN (SELECT run sample_id, CAST(count(DISTINCT artifact) AS INT) n FROM artifacts GROUP BY 1) a USING (sample_id)""")
def _(spark, sf):
    files = V.artifacts(spark, sf).groupBy(F.col("run").alias("sample_id"), "artifact").agg(
        F.max("path").alias("path"), F.max("path").alias("absolute_path"), F.max("size").alias("size_bytes"),
        F.max("mtime").cast("string").alias("modified"), F.lit("N/A").alias("md5"), F.lit("").alias("description"))
    sheet = V.sheet(spark, sf)
    align = V.metrics(spark, sf).select(
        "sample_id", "total_reads", "uniquely_mapped_pct", "mismatch_rate",
        *[F.lit(None).cast("bigint").alias(c) for c in (
            "read_length", "total_mapped_reads", "uniquely_mapped_reads", "multi_mapped_reads", "unmapped_too_short")],
        *[F.lit(None).cast("double").alias(c) for c in (
            "total_mapped_pct", "multi_mapped_pct", "unmapped_too_short_pct")])
    assign = V.metrics(spark, sf).select("sample_id", "assignment_rate", *[
        F.lit(0).cast("bigint").alias(c) for c in (
            "assigned_reads", "unassigned_multimapping", "unassigned_nofeatures", "unassigned_ambiguity")])
    from readloom.operators.sample_qc import qc_record

    meta = S.manifest_metadata(sheet).join(sheet.select("sample_id", "project_id"), "sample_id")
    docs = S.manifest_records(files, qc_record(align, assign, V.table_rules()).drop("pipeline_type"), meta)
    return docs.select(
        "sample_id", "status", F.coalesce(F.size("final_outputs"), F.lit(0)).alias("n_outputs"),
        F.col("qc_metrics.overall_status").alias("overall_status"),
        F.col("sample_metadata")["condition"].alias("condition"))
