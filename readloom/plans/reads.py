"""Queries on reads, files and checksums."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.functions import text as T
from readloom.operators import artifacts as A
from readloom.operators import fastqc_checks as E
from readloom.operators import reads as R
from readloom.session import scratch_path
from readloom.sinks import writers as K
from readloom.sinks.block_gzip import write_block_gzip
from readloom.sources.fastq import read_fastq
from readloom.sources.files import update_manifest
from readloom.functions.ranking import first_rows, number_rows
from readloom.plans import views as V
from readloom.plans.catalog import register
from readloom.plans.qc import BASIC, _ADAPTER, _POSITIONS, _QUANTILES, _READ_QUALITY, MOTIFS


@register("validate_reads", "reads", """SELECT file, error, count(*) n_reads, min(read_no) first_read, arg_min(header, read_no) first_header FROM (
    SELECT file, read_no, header, CASE WHEN NOT starts_with(header, '@') THEN 'header' WHEN NOT starts_with(plus, '+') THEN 'plus'
      WHEN length(seq) <> length(broken_qual) THEN 'length' END error FROM reads) WHERE error IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    return R.validate_reads(V.reads(spark, sf).withColumn("qual", F.col("broken_qual")))


@register("repair_wrapped_reads", "reads", """SELECT file, read_no, header, seq, plus, qual FROM reads""")
def _(spark, sf):
    half = F.greatest(F.floor(F.length("seq") / 2), F.lit(1)).cast("int")
    numbered = number_rows(V.reads(spark, sf), ["file"], ["read_no"], "n")
    parts = F.array("header", F.substr("seq", F.lit(1), half), F.substr("seq", half + 1), F.col("plus"),
                    F.substr("qual", F.lit(1), half), F.substr("qual", half + 1))
    lines = numbered.select("file", "read_no", F.col("n"), F.posexplode(parts).alias("i", "line"))
    fixed = R.repair_wrapped_lines(lines.select(
        "file", ((F.col("n") - 1) * 6 + F.col("i")).alias("line_no"), "line"))
    # back to the numbers of the table: they are part of the header
    doc = F.regexp_extract("header", "read:(\\d+):(\\d+)", 1).cast("bigint")
    pos = F.regexp_extract("header", "read:(\\d+):(\\d+)", 2).cast("bigint")
    return fixed.withColumn("read_no", doc * 1_000_000 + pos)


@register("find_reads", "reads", """SELECT id, file, min(read_no) read_no, arg_min(header, read_no) header,
    arg_min(length(seq), read_no) seq_length, arg_min(length(broken_qual), read_no) qual_length,
    arg_min(length(seq), read_no) <> arg_min(length(broken_qual), read_no) mismatch
    FROM reads, (VALUES ('ead:7'), (':14:0'), ('nothing')) i(id) WHERE contains(header, id) GROUP BY 1, 2""")
def _(spark, sf):
    rows = V.reads(spark, sf).withColumn("qual", F.col("broken_qual"))
    found = R.find_reads(rows, ["ead:7", ":14:0", "nothing"])
    return found.withColumn("seq_length", F.col("seq_length").cast("bigint")).withColumn(
        "qual_length", F.col("qual_length").cast("bigint"))


@register("subset_reads", "reads", """SELECT sample_id, header, n - 1 AS read_no FROM (
    SELECT sample_id, header, row_number() OVER (PARTITION BY sample_id ORDER BY read_no) n FROM reads) WHERE n <= 100""")
def _(spark, sf):
    first = first_rows(V.reads(spark, sf).select("sample_id", "header", "read_no"), ["sample_id"], ["read_no"], 100, "n")
    rows = first.select("sample_id", "header", (F.col("n") - 1).cast("bigint").alias("read_no"))
    return R.subset_reads(rows, 100)


@register("base_histogram", "base_histogram", "SELECT sample_id, pos, quality, n, n_base FROM base_histogram")
def _(spark, sf):
    return R.base_histogram(V.reads(spark, sf))


QUANTILES = ["median", "lower_quartile", "upper_quartile", "p10", "p90"]


@register("position_profile", "reads base_histogram", f"""SELECT sample_id, pos, mean, n_pct,
    {", ".join(f"round({q}, 6) {q}" for q in QUANTILES)} FROM ({_QUANTILES}) q JOIN ({_POSITIONS}) p USING (sample_id, pos)""")
def _(spark, sf):
    # the engines interpolate in another order of operations
    profile = R.position_profile(R.base_histogram(V.reads(spark, sf)))
    return profile.withColumns({q: F.round(q, 6) for q in QUANTILES})


@register("read_quality_histogram", "reads", _READ_QUALITY)
def _(spark, sf):
    return R.read_quality_histogram(V.reads(spark, sf))


@register("basic_statistics", "reads", BASIC)
def _(spark, sf):
    return R.basic_statistics(V.reads(spark, sf))


@register("q30_share", "reads", f"""SELECT sample_id, CAST(100 * coalesce(sum(reads) FILTER (quality >= 20), 0) AS DOUBLE) / CAST(sum(reads) AS DOUBLE) q30_pct
    FROM ({_READ_QUALITY}) GROUP BY 1""")
def _(spark, sf):
    return E.q30_share(R.read_quality_histogram(V.reads(spark, sf)), 20)


@register("profile_report_rows", "reads base_histogram", f"""
    SELECT sample_id, "module", count(*) n FROM (
      SELECT sample_id, unnest(['Basic Statistics', 'Basic Statistics']) AS "module" FROM ({BASIC})
      UNION ALL SELECT sample_id, unnest(['Per base sequence quality', 'Per base N content']) FROM ({_POSITIONS})
      UNION ALL SELECT sample_id, 'Per sequence quality scores' FROM ({_READ_QUALITY})
      UNION ALL SELECT sample_id, 'Adapter Content' FROM ({_ADAPTER})) GROUP BY 1, 2""")
def _(spark, sf):
    return R.profile_rows(V.reads(spark, sf), MOTIFS).groupBy("sample_id", "module").agg(
        F.count("*").alias("n"))


def _pairs(spark, sf):
    r = V.reads(spark, sf)
    return r.select(
        "sample_id", "read_no", F.col("seq").alias("seq1"), F.col("qual").alias("qual1"),
        F.reverse("seq").alias("seq2"), F.reverse("qual").alias("qual2"))


# 3' quality cut: gains (20 - q) are summed from the end; beyond the last negative sum the rightmost position of the
# largest positive one is where the read ends. Then the adapter, whole or as a prefix at the end.
TRIMMED = """mates AS (SELECT sample_id, read_no, 1 mate, seq, qual FROM reads UNION ALL SELECT sample_id, read_no, 2, reverse(seq), reverse(qual) FROM reads),
    gains AS (SELECT read_no, mate, pos, sum(gain) OVER (PARTITION BY read_no, mate ORDER BY pos DESC) total FROM (
      SELECT read_no, mate, generate_subscripts(c, 1) pos, 53 - ascii(unnest(c)) gain FROM (SELECT read_no, mate, string_split(qual, '') c FROM mates))),
    stops AS (SELECT read_no, mate, max(pos) FILTER (total < 0) stop FROM gains GROUP BY ALL),
    cuts AS (SELECT read_no, mate, arg_max(pos, (total, pos)) cut FROM gains JOIN stops USING (read_no, mate)
      WHERE pos > coalesce(stop, 0) AND total > 0 GROUP BY ALL),
    short AS (SELECT m.*, substr(seq, 1, coalesce(cut - 1, length(seq))) s FROM mates m LEFT JOIN cuts USING (read_no, mate)),
    trimmed AS (SELECT sample_id, read_no, mate, length(seq) bp, CASE mate WHEN 1 THEN regexp_extract(s, '^(.*?)(TACGTA|TAC(?:G(?:T)?)?$|$)', 1)
      ELSE regexp_extract(s, '^(.*?)(GTCAGG|GTC(?:A(?:G)?)?$|$)', 1) END t, qual FROM short)"""


@register("trim_reads", "reads", f"""WITH {TRIMMED} SELECT a.sample_id, read_no, a.t seq1, substr(a.qual, 1, length(a.t)) qual1,
    b.t seq2, substr(b.qual, 1, length(b.t)) qual2, length(a.t) < 20 OR length(b.t) < 20 too_short
    FROM trimmed a JOIN trimmed b USING (read_no) WHERE a.mate = 1 AND b.mate = 2""")
def _(spark, sf):
    out = R.trim_pairs(_pairs(spark, sf), "TACGTA", "GTCAGG", 20, 20)
    return out.select("sample_id", "read_no", F.col("m1.seq").alias("seq1"), F.col("m1.qual").alias("qual1"),
                      F.col("m2.seq").alias("seq2"), F.col("m2.qual").alias("qual2"), "too_short")


@register("trim_counters", "reads", f"""WITH {TRIMMED} SELECT sample_id, count(*) total_pairs, count(*) FILTER (short) too_short,
    count(*) FILTER (NOT short) passed, CAST(sum(bp) AS BIGINT) total_bp FROM (
      SELECT sample_id, read_no, bool_or(length(t) < 20) short, sum(bp) bp FROM trimmed GROUP BY 1, 2) GROUP BY 1""")
def _(spark, sf):
    return R.trim_counters(R.trim_pairs(_pairs(spark, sf), "TACGTA", "GTCAGG", 20, 20))


# --- written and read back -----------------------------------------------------------


@register("write_and_read_fastq", "reads", "SELECT header, seq, plus, qual FROM reads")
def _(spark, sf):
    target = scratch_path(spark, "reads")
    K.write_fastq(V.reads(spark, sf), target, "none")
    return read_fastq(spark, target, split_bytes=1 << 16, endings=(".txt",)).select("header", "seq", "plus", "qual")


@register("write_and_read_block_gzip", "reads", "SELECT header, seq, plus, qual FROM reads")
def _(spark, sf):
    target = scratch_path(spark, "fastq-blocks")
    record = F.concat_ws("\n", "header", "seq", "plus", "qual")
    write_block_gzip(V.reads(spark, sf).select(record.alias("value")), target, ".fastq.gz")
    # members cross the ranges, records cross the members
    return read_fastq(spark, target, split_bytes=100_000).select("header", "seq", "plus", "qual")


@register("read_wrapped_fastq", "reads", "SELECT file, header, seq, plus, qual FROM reads")
def _(spark, sf):
    half = F.greatest(F.floor(F.length("seq") / 2), F.lit(1)).cast("int")
    record = F.concat_ws("\n", "header", F.substr("seq", F.lit(1), half), F.substr("seq", half + 1), "plus",
                         F.substr("qual", F.lit(1), half), F.substr("qual", half + 1))
    target = scratch_path(spark, "wrapped")
    V.reads(spark, sf).select("file", record.alias("value")).write.partitionBy("file").text(target)
    back = read_fastq(spark, target, 6, split_bytes=1 << 16, endings=(".txt",))
    return back.select(F.regexp_extract("file", "file=([^/]*)/", 1).alias("file"), "header", "seq", "plus", "qual")


@register("write_and_read_sheet", "sheet", "SELECT sample_id, condition, tissue, sex, fastq_1 FROM sheet")
def _(spark, sf):
    target = scratch_path(spark, "sheet")
    K.write_sheet(V.sheet(spark, sf).select("sample_id", "condition", "tissue", "sex", "fastq_1"), target)
    return spark.read.option("sep", "\t").option("header", "true").csv(target)


# --- files --------------------------------------------------------------------------


def _listing(spark, sf):
    s = V.sheet(spark, sf)
    size = F.col("sample_id").cast("bigint") * 1000 + 7
    return s.select("project_id", F.explode(F.array(
        F.struct(F.col("fastq_1").alias("path"), size.alias("size")),
        F.struct(F.col("fastq_2").alias("path"), (size * 2).alias("size")))).alias("f")).select(
        "project_id", "f.*").where("path is not null and trim(path) <> ''")


LISTING = """listing AS (SELECT project_id, fastq_1 AS path, CAST(sample_id AS BIGINT) * 1000 + 7 size FROM sheet
    UNION ALL SELECT project_id, fastq_2, (CAST(sample_id AS BIGINT) * 1000 + 7) * 2 FROM sheet WHERE trim(fastq_2) <> '')"""


@register("compression_mix", "sheet", f"""WITH {LISTING} SELECT project_id, n_gzip, n_plain, n_gzip > 0 AND n_plain > 0 mixed FROM (
    SELECT project_id, count(*) FILTER (path LIKE '%.gz') n_gzip, count(*) FILTER (path NOT LIKE '%.gz') n_plain FROM (
      SELECT project_id, CASE WHEN path LIKE '%\\_1.fq.gz' ESCAPE '\\' THEN replace(path, '.gz', '') ELSE path END AS path FROM listing) GROUP BY 1)""")
def _(spark, sf):
    plain = F.when(F.col("path").endswith("_1.fq.gz"), F.replace("path", F.lit(".gz"), F.lit(""))).otherwise(F.col("path"))
    return A.compression_mix(_listing(spark, sf).withColumn("path", plain))


@register("pair_files", "sheet", f"""WITH {LISTING} SELECT 'S' || lpad(sample_id, 9, '0') sample_id, fastq_1 r1,
    CASE WHEN trim(fastq_2) <> '' THEN fastq_2 END r2,
    CAST((CAST(sample_id AS BIGINT) * 1000 + 7) * CASE WHEN trim(fastq_2) <> '' THEN 3 ELSE 1 END AS DOUBLE) / 1073741824 size_gib,
    0 n_conflicts, true marked FROM sheet""")
def _(spark, sf):
    return A.pair_files(_listing(spark, sf).drop("project_id")).withColumn(
        "n_conflicts", F.col("n_conflicts").cast("int"))


@register("pair_file_conflicts", "artifacts", """SELECT CAST(run AS VARCHAR) sample_id, max(path) r1, count(*) - 1 n_conflicts FROM (
    SELECT run, path || '/' || run || '.fastq' AS path FROM artifacts) GROUP BY 1""")
def _(spark, sf):
    files = V.artifacts(spark, sf).select(
        F.concat("path", F.lit("/"), "run", F.lit(".fastq")).alias("path"), "size")
    return A.pair_files(files).select("sample_id", "r1", "n_conflicts")


@register("read_type", "sheet", "SELECT 'paired-end' read_type, count(*) n_samples FROM sheet")
def _(spark, sf):
    return A.read_type(A.pair_files(_listing(spark, sf).drop("project_id")))


@register("dataset_summary", "sheet", f"""WITH {LISTING} SELECT (SELECT count(*) FROM listing) n_files, 1::BIGINT n_folders,
    (SELECT count(*) FROM sheet) n_samples, 0::BIGINT n_conflicts, round(CAST((SELECT sum(size) FROM listing) AS DOUBLE) / 1073741824, 9) size_gib,
    'paired-end' read_type""")
def _(spark, sf):
    return A.dataset_summary(_listing(spark, sf).drop("project_id")).withColumn(
        "size_gib", F.round("size_gib", 9))


@register("second_mate_path", "sheet", """SELECT sample_id, replace(replace(fastq_1, '_1.fq', '_2.fq'), '_R1_001.', '_R2_001.') r2 FROM sheet""")
def _(spark, sf):
    return V.sheet(spark, sf).select("sample_id", T.second_mate_path(F.col("fastq_1")).alias("r2"))


@register("list_samples", "sheet", """SELECT DISTINCT 'S' || lpad(sample_id, 9, '0') sample_id FROM sheet WHERE fastq_1 LIKE '%\\_1.fq.gz' ESCAPE '\\'""")
def _(spark, sf):
    return A.sample_names(_listing(spark, sf), "_1.fq.gz")


@register("checksum_audit", "", """SELECT name, CASE WHEN NOT listed THEN 'EXTRA' WHEN k % 11 = 0 THEN 'SKIP' WHEN found IS NULL THEN 'MISSING'
      WHEN k % 5 = 0 THEN 'MISMATCH' ELSE 'OK' END status FROM (
    SELECT CAST(coalesce(d.doc_id, l.doc_id) AS VARCHAR) AS name, coalesce(d.doc_id, l.doc_id) k, l.doc_id IS NOT NULL listed, d.doc_id found
    FROM documents d FULL JOIN (SELECT doc_id FROM labels UNION SELECT -1 - item_id FROM benchmark) l ON d.doc_id = l.doc_id)""")
def _(spark, sf):
    docs = V.table(spark, sf, "documents")
    actual = docs.select(F.col("doc_id").cast("string").alias("name"), F.md5("text").alias("md5"))
    k = F.col("doc_id")
    ids = V.table(spark, sf, "labels").select("doc_id").unionByName(
        V.table(spark, sf, "benchmark").select((-1 - F.col("item_id")).alias("doc_id")))
    wanted = ids.join(docs.select("doc_id", "text"), "doc_id", "left")
    expected = wanted.select(
        k.cast("string").alias("name"),
        F.when(k % 11 == 0, "N/A").when(k % 5 == 0, "0" * 32).otherwise(
            F.coalesce(F.upper(F.md5("text")), F.lit("-"))).alias("md5"))
    return A.checksum_audit(actual, expected)


@register("document_checksums", "", "SELECT doc_id, md5(text) md5 FROM documents")
def _(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", F.md5("text").alias("md5"))


# One file per source, digested in a first run and found unchanged by a second.
@register("checksum_manifest", "", """SELECT source, md5(string_agg(text, chr(10) ORDER BY doc_id) || chr(10)) md5, 'new' first_run, 'unchanged' second_run
    FROM documents GROUP BY 1""")
def _(spark, sf):
    at = scratch_path(spark, "manifest")
    docs = V.table(spark, sf, "documents").repartition("source").sortWithinPartitions("source", "doc_id")
    docs.select("source", "text").write.partitionBy("source").text(f"{at}/files")
    first, second = (update_manifest(spark, f"{at}/files", f"{at}/manifest", "part-*") for _ in range(2))
    both = first.select("path", F.col("state").alias("first_run")).join(second.select("path", "md5", F.col("state").alias("second_run")), "path")
    return both.select(F.regexp_extract("path", "/source=([^/]*)/", 1).alias("source"), "md5", "first_run", "second_run")


# --- artifacts ----------------------------------------------------------------------


@register("artifact_audit", "expected_artifacts artifacts", """
    SELECT run, artifact, critical, CASE WHEN n IS NOT NULL THEN 'present' WHEN critical THEN 'critical_missing' ELSE 'optional_missing' END state,
           n n_files, size FROM expected_artifacts LEFT JOIN (SELECT run, artifact, count(*) n, max(size) size FROM artifacts GROUP BY 1, 2) USING (run, artifact)""")
def _(spark, sf):
    return A.artifact_audit(V.expected_artifacts(spark, sf), V.artifacts(spark, sf), ["run", "artifact"])


@register("audit_summary", "expected_artifacts artifacts", """
    SELECT *, (n_pass * 100) // n_total success_rate FROM (SELECT count(*) FILTER (n IS NOT NULL) n_pass, count(*) FILTER (n IS NULL AND critical) n_fail,
      count(*) FILTER (n IS NULL AND NOT critical) n_warn, count(*) n_total
    FROM expected_artifacts LEFT JOIN (SELECT run, artifact, count(*) n FROM artifacts GROUP BY 1, 2) USING (run, artifact))""")
def _(spark, sf):
    return A.audit_summary(A.artifact_audit(
        V.expected_artifacts(spark, sf), V.artifacts(spark, sf), ["run", "artifact"]))


@register("artifact_records", "artifacts", """SELECT run sample_id, 'urgent' artifact, path, size size_bytes, mtime AS modified, 'first' description
    FROM artifacts WHERE path LIKE '%7' UNION ALL SELECT run, 'late', path, size, mtime, 'second' FROM artifacts WHERE path LIKE '%19'""")
def _(spark, sf):
    expected = [("urgent", "7", "first"), ("late", "19", "second")]
    return A.artifact_records(V.artifacts(spark, sf).drop("artifact").withColumnRenamed("run", "sample_id"), expected)


@register("artifact_completion", "runs artifacts", """SELECT run sample_id, coalesce(n, 0) n_outputs, CASE WHEN n > 0 THEN 'completed' ELSE 'incomplete' END status
    FROM runs LEFT JOIN (SELECT run, count(*) n FROM artifacts GROUP BY 1) USING (run)""")
def _(spark, sf):
    return A.completion(V.runs(spark, sf).withColumnRenamed("run", "sample_id"),
                        V.artifacts(spark, sf).withColumnRenamed("run", "sample_id"))


@register("sizes_by_directory", "artifacts", """SELECT artifact AS directory, size, CASE WHEN size < 1024 THEN printf('%.1fB', CAST(size AS DOUBLE))
      WHEN size < 1048576 THEN printf('%.1fKB', size / 1024) WHEN size < 1073741824 THEN printf('%.1fMB', size / 1048576)
      ELSE printf('%.1fGB', size / 1073741824) END readable FROM (SELECT artifact, CAST(sum(size) AS BIGINT) size FROM artifacts GROUP BY 1)""")
def _(spark, sf):
    return A.sizes_by_directory(V.artifacts(spark, sf).withColumnRenamed("artifact", "directory"))


@register("path_validation", "expected_artifacts artifacts", """SELECT artifact AS name, run || artifact AS path,
    (run, artifact) IN (SELECT (run, artifact) FROM artifacts) AS "exists" FROM expected_artifacts""")
def _(spark, sf):
    key = F.concat("run", "artifact")
    named = V.expected_artifacts(spark, sf).select(F.col("artifact").alias("name"), key.alias("path"))
    return A.path_validation(named, V.artifacts(spark, sf).select(key.alias("path")))


@register("newest_artifact", "artifacts", """SELECT run, mtime, max(path) AS path FROM artifacts a
    WHERE mtime = (SELECT max(mtime) FROM artifacts b WHERE a.run = b.run) GROUP BY 1, 2""")
def _(spark, sf):
    return A.newest(V.artifacts(spark, sf))
