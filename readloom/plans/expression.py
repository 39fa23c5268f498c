"""Queries on count matrices, differential expression and genomic intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from readloom.operators import counts as C
from readloom.operators import de as D
from readloom.operators import intervals as I
from readloom.operators import sketches as K
from readloom.plans import views as V
from readloom.plans.catalog import register
from readloom.session import written




# the suppliers' nations: as many columns at every scale
NATIONS = [f"NATION_{n}" for n in range(25)]


@register("clean_matrix", "counts_long", "SELECT gene_id AS \"Geneid\", " + ", ".join(
    f"CAST(coalesce(sum(count) FILTER (n_name = '{n}'), 0) AS BIGINT) AS \"{n}\"" for n in NATIONS) + """
    FROM counts_long JOIN supplier ON CAST(s_suppkey AS VARCHAR) = sample_id JOIN nation ON s_nationkey = n_nationkey
    GROUP BY gene_id""")
def _(spark, sf):
    nation = V.table(spark, sf, "supplier").join(V.table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    counts = V.counts_long(spark, sf).join(
        nation.select(F.col("s_suppkey").cast("string").alias("sample_id"), "n_name"), "sample_id")
    return C.to_wide(counts.select("gene_id", F.col("n_name").alias("sample_id"), "count"), NATIONS)


@register("library_size", "counts_long",
          "SELECT sample_id, CAST(sum(count) AS BIGINT) total_counts FROM counts_long GROUP BY 1")
def _(spark, sf):
    return C.library_size(V.counts_long(spark, sf))


EXPRESSION = """SELECT sample_id, total_counts, genes_detected, CAST(100 * genes_detected AS DOUBLE) / n detection_rate,
    CAST(total_counts AS DOUBLE) / n avg_count FROM (
      SELECT sample_id, CAST(sum(count) AS BIGINT) total_counts, count(*) FILTER (count > 0) genes_detected,
             (SELECT count(DISTINCT gene_id) FROM counts_long) n FROM counts_long GROUP BY 1)"""


@register("sample_expression", "counts_long", EXPRESSION)
def _(spark, sf):
    return C.sample_expression(V.counts_long(spark, sf))


@register("expression_band", "counts_long", """SELECT sample_id, CASE WHEN n >= 560 THEN 'normal' WHEN n >= 450 THEN 'caution' ELSE 'problem' END band,
    CASE WHEN n >= 15000 THEN 'normal' WHEN n >= 12000 THEN 'caution' ELSE 'problem' END human
    FROM (SELECT sample_id, count(*) FILTER (count > 0) n FROM counts_long GROUP BY 1)""")
def _(spark, sf):
    rows = C.sample_expression(V.counts_long(spark, sf))
    n = F.col("genes_detected")
    return rows.select(
        "sample_id", C.expression_band(n, "demo", {"demo": (560, 450)}).alias("band"),
        C.expression_band(n, "human").alias("human"))


@register("matrix_totals", "counts_long", """SELECT count(DISTINCT gene_id) n_genes, count(DISTINCT sample_id) n_samples,
    CAST(sum(count) AS BIGINT) total_counts, CAST(count(*) FILTER (count > 0) AS DOUBLE) / count(DISTINCT sample_id) avg_genes_detected
    FROM counts_long""")
def _(spark, sf):
    return C.matrix_totals(V.counts_long(spark, sf))


@register("highly_expressed", "counts_long", """SELECT sample_id, gene_id, count, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY sample_id ORDER BY count DESC, gene_id) AS INT) rank
    FROM counts_long WHERE count > 40) WHERE rank <= 10""")
def _(spark, sf):
    return C.highly_expressed(V.counts_long(spark, sf), 40, 10).select("sample_id", "gene_id", "count", "rank")


VARIANCE = """SELECT gene_id, CASE WHEN n < 2 THEN 0 ELSE CAST(n * sq - s * s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(n AS DOUBLE)) END variance
    FROM (SELECT gene_id, CAST({n} AS HUGEINT) n, sum(count) s, sum(CAST(count AS HUGEINT) * count) sq FROM counts_long GROUP BY 1)"""


@register("top_variable_genes", "counts_long",
          VARIANCE.format(n="count(*)") + " ORDER BY variance DESC, gene_id LIMIT 20")
def _(spark, sf):
    return C.top_variable_genes(V.counts_long(spark, sf))


@register("top_variable_genes_full_matrix", "counts_long",
          VARIANCE.format(n="(SELECT count(DISTINCT sample_id) FROM counts_long)") + " ORDER BY variance DESC, gene_id LIMIT 20")
def _(spark, sf):
    counts = V.counts_long(spark, sf)
    n = V.table(spark, sf, "lineitem").agg(F.countDistinct("l_suppkey")).scalar()
    return C.top_variable_genes(counts, 20, n)


@register("top_variable_counts", "counts_long", f"""SELECT gene_id, variance, sample_id, count FROM counts_long
    JOIN ({VARIANCE.format(n="count(*)")} ORDER BY variance DESC, gene_id LIMIT 20) USING (gene_id)""")
def _(spark, sf):
    return C.top_variable_counts(V.counts_long(spark, sf))


@register("lookup_genes", "counts_long",
          "SELECT gene_id, sample_id, count FROM counts_long WHERE gene_id LIKE '%17%' OR gene_id LIKE '%99%'")
def _(spark, sf):
    return C.lookup_genes(V.counts_long(spark, sf), ["17", "99"])


@register("drop_samples", "counts_long",
          "SELECT gene_id, sample_id, count FROM counts_long WHERE sample_id NOT IN ('3', '8', 'nobody')")
def _(spark, sf):
    return C.drop_samples(V.counts_long(spark, sf), ["3", "8", "nobody"])


@register("excluded_not_found", "counts_long runs",
          "SELECT run sample_id FROM runs WHERE run NOT IN (SELECT sample_id FROM counts_long)")
def _(spark, sf):
    return C.excluded_not_found(V.counts_long(spark, sf), V.runs(spark, sf).withColumnRenamed("run", "sample_id"))


@register("zero_genes", "", """SELECT count(*) n_genes, count(*) FILTER (t = 0) n_zero_genes,
    round(CAST(100 * count(*) FILTER (t = 0) AS DOUBLE) / count(*), 1) zero_pct,
    round(CAST(100 * count(*) FILTER (t = 0) AS DOUBLE) / count(*), 1) > 30 warn
    FROM (SELECT l_partkey, sum(CASE WHEN l_discount > 0.065 AND l_tax > 0.055 AND l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) t FROM lineitem GROUP BY 1)""".replace(
              "0.065", "CAST(0.065 AS DOUBLE)").replace("0.055", "CAST(0.055 AS DOUBLE)"))
def _(spark, sf):
    kept = F.expr("l_discount > 0.065D and l_tax > 0.055D and l_returnflag = 'R'")
    counts = V.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("gene_id"), F.col("l_suppkey").alias("sample_id"),
        F.when(kept, F.col("l_quantity").cast("bigint")).otherwise(0).alias("count"))
    return C.zero_genes(counts)


@register("assignment_breakdown", "assignment_long", """SELECT sample_id, category, reads,
    CAST(100 * reads AS DOUBLE) / CAST(sum(reads) OVER (PARTITION BY sample_id) AS DOUBLE) pct FROM assignment_long""")
def _(spark, sf):
    return C.assignment_breakdown(V.assignment_long(spark, sf))


@register("matrix_shape", "counts_long",
          "SELECT count(DISTINCT gene_id) n_genes, count(DISTINCT sample_id) n_samples FROM counts_long")
def _(spark, sf):
    return C.matrix_shape(V.counts_long(spark, sf))


# --- differential expression --------------------------------------------------------


@register("de_metadata", "sheet", """SELECT sample_id, condition, replicate, tissue, sex FROM sheet
    WHERE sample_id NOT IN ('1', '5')""")
def _(spark, sf):
    return D.de_metadata(V.sheet(spark, sf), ["1", "5"])


CONDITIONS = """conditions AS (SELECT n condition, min(k) first_seen FROM (
    SELECT c_custkey k, CASE c_mktsegment WHEN 'MACHINERY' THEN 'Wild Type-2' WHEN 'BUILDING' THEN 'Mock' ELSE c_mktsegment END n FROM customer) GROUP BY 1),
    control AS (SELECT condition c FROM conditions ORDER BY NOT (lower(condition) LIKE 'mock%'), first_seen LIMIT 1)"""


def _conditions(spark, sf):
    name = F.when(F.col("c_mktsegment") == "MACHINERY", "Wild Type-2").when(
        F.col("c_mktsegment") == "BUILDING", "Mock").otherwise(F.col("c_mktsegment"))
    rows = V.table(spark, sf, "customer").select("c_custkey", name.alias("condition"))
    return D.ordered_conditions(rows, "c_custkey")


@register("pick_control", "", f"WITH {CONDITIONS} SELECT c control FROM control")
def _(spark, sf):
    return D.pick_control(_conditions(spark, sf))


@register("pairwise_comparisons", "", f"""WITH {CONDITIONS}
    SELECT condition treatment, c control, first_seen FROM conditions, control WHERE condition <> c""")
def _(spark, sf):
    return D.pairwise_comparisons(_conditions(spark, sf))


SIG = """padj IS NOT NULL AND "log2FoldChange" IS NOT NULL AND padj < CAST(0.05 AS DOUBLE) AND abs("log2FoldChange") > CAST(0.5 AS DOUBLE)"""


@register("significant_genes", "de_results",
          f"""SELECT pair, gene, round("log2FoldChange", 6) "log2FoldChange", padj, CASE WHEN "log2FoldChange" > 0 THEN 'up' ELSE 'down' END direction
              FROM de_results WHERE {SIG}""")
def _(spark, sf):
    # logarithms of the two engines may differ in the last bit
    return D.significant(V.de_results(spark, sf), 0.05, 0.5).drop("f", "o").withColumn(
        "log2FoldChange", F.round("log2FoldChange", 6))


@register("significant_counts", "de_results", f"""SELECT pair, count(*) FILTER ({SIG}) sig_total,
    count(*) FILTER ({SIG} AND "log2FoldChange" > 0) sig_up, count(*) FILTER ({SIG} AND "log2FoldChange" < 0) sig_down
    FROM de_results GROUP BY 1""")
def _(spark, sf):
    return D.significant_counts(V.de_results(spark, sf), 0.05, 0.5)


@register("top_genes", "de_results", f"""SELECT pair, direction, rank, gene, round(lfc, 3) AS "log2FC",
    CAST(printf('%.2e', padj) AS DOUBLE) padj FROM (
    SELECT pair, gene, "log2FoldChange" lfc, padj, CASE WHEN "log2FoldChange" > 0 THEN 'up' ELSE 'down' END direction,
      CAST(row_number() OVER (PARTITION BY pair, "log2FoldChange" > 0 ORDER BY abs("log2FoldChange") DESC, gene) AS INT) rank
    FROM de_results WHERE {SIG}) WHERE rank <= 10""")
def _(spark, sf):
    return D.top_genes(V.de_results(spark, sf), 10, 0.05, 0.5)


@register("top_terms", "de_results", """SELECT pair, direction, rank, term, padj, count FROM (
    SELECT pair, CASE WHEN f >= o THEN 'up' ELSE 'down' END direction, 'T' || gene term, CAST(printf('%.2e', padj) AS DOUBLE) padj, CAST(f AS INT) count,
      CAST(row_number() OVER (PARTITION BY pair, f >= o ORDER BY padj, 'T' || gene) AS INT) rank
    FROM de_results WHERE padj IS NOT NULL) WHERE rank <= 5""")
def _(spark, sf):
    terms = V.de_results(spark, sf).where("padj is not null").select(
        "pair", F.when(F.col("f") >= F.col("o"), "up").otherwise("down").alias("direction"),
        F.concat(F.lit("T"), "gene").alias("ID"), F.lit(None).cast("string").alias("Description"),
        F.col("padj").alias("p.adjust"), F.col("f").alias("Count"))
    return D.top_terms(terms)


@register("result_warnings", "de_results", f"""SELECT pair, sig_total, CASE WHEN sig_total = 0 THEN 'none' WHEN sig_total < 10 THEN 'few' END warning
    FROM (SELECT pair, count(*) FILTER (padj < CAST(0.05 AS DOUBLE) AND abs("log2FoldChange") > CAST(2.4 AS DOUBLE)) sig_total FROM de_results GROUP BY 1)""")
def _(spark, sf):
    return D.result_warnings(D.significant_counts(V.de_results(spark, sf), 0.05, 2.4)).select(
        "pair", "sig_total", "warning")


def _configured(spark, sf):
    return V.table(spark, sf, "nation").select(
        F.concat(F.lit("NAT"), F.col("n_nationkey")).alias("pair")).unionByName(
        V.table(spark, sf, "region").select(F.col("r_name").alias("pair")))


@register("missing_pairs", "de_results", """SELECT 'NAT' || n_nationkey pair FROM nation UNION ALL
    SELECT r_name FROM region WHERE r_name NOT IN (SELECT pair FROM de_results)""")
def _(spark, sf):
    return D.missing_pairs(_configured(spark, sf), V.de_results(spark, sf))


@register("result_status", "de_results", """SELECT (SELECT count(DISTINCT pair) FROM de_results) n_found,
    (SELECT count(*) FROM nation) n_missing, 'partial' status""")
def _(spark, sf):
    return D.result_status(_configured(spark, sf), V.de_results(spark, sf))


def _pairs(spark, sf):
    """Pairs of nations, some with a wrong case or swapped digits."""
    k = F.col("n_nationkey")
    name = F.when(k % 3 == 0, F.lower("n_name")).when(k % 3 == 1, F.concat(k.cast("string"), F.lit("NATION"))).otherwise(F.col("n_name"))
    return V.table(spark, sf, "nation").select(
        name.alias("treatment"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("control"))


def _known(spark, sf):
    return V.table(spark, sf, "nation").select(
        F.replace("n_name", F.lit("_"), F.lit("")).alias("condition")).unionByName(
        V.table(spark, sf, "nation").select(F.col("n_name").alias("condition")))


PAIRS = """pairs AS (SELECT n_nationkey k, n_name, CASE n_nationkey % 3 WHEN 0 THEN lower(n_name) WHEN 1 THEN n_nationkey || 'NATION' ELSE n_name END treatment,
    'R' || n_regionkey control FROM nation)"""
FIXES = """SELECT treatment AS name, CASE k % 3 WHEN 0 THEN n_name ELSE replace(n_name, '_', '') END suggestion FROM pairs WHERE k % 3 < 2
    UNION ALL SELECT DISTINCT control, CAST(NULL AS VARCHAR) FROM pairs"""


@register("check_conditions", "", f"WITH {PAIRS} {FIXES}")
def _(spark, sf):
    return D.check_conditions(_pairs(spark, sf), _known(spark, sf))


@register("apply_corrections", "", f"""WITH {PAIRS}
    SELECT coalesce(suggestion, treatment) treatment, control, suggestion IS NOT NULL changed
    FROM pairs LEFT JOIN ({FIXES}) ON treatment = name""")
def _(spark, sf):
    pairs = _pairs(spark, sf)
    return D.apply_corrections(pairs, D.check_conditions(pairs, _known(spark, sf)))


READINESS = f"""WITH {PAIRS}, found AS (
    SELECT 'only_in_metadata' AS "check", sample_id subject, 'error' AS level FROM sheet WHERE sample_id NOT IN (SELECT sample_id FROM counts_long)
    UNION ALL SELECT DISTINCT 'only_in_counts', sample_id, 'warning' FROM counts_long WHERE sample_id NOT IN (SELECT sample_id FROM sheet)
    UNION ALL SELECT DISTINCT 'condition', treatment, 'error' FROM pairs
    UNION ALL SELECT DISTINCT 'condition', control, 'error' FROM pairs
    UNION ALL SELECT 'group_size', tissue, 'warning' FROM sheet GROUP BY tissue HAVING count(*) < 3
    UNION ALL SELECT 'group_size', tissue, 'error' FROM sheet GROUP BY tissue HAVING count(*) < 2)"""


def _readiness(spark, sf):
    metadata = V.sheet(spark, sf).select("sample_id", F.col("tissue").alias("group"))
    pairs = _pairs(spark, sf).withColumn("treatment", F.concat(F.lit("?"), "treatment"))
    return D.readiness_findings(V.counts_long(spark, sf), metadata, pairs)


@register("readiness_findings", "sheet counts_long",
          READINESS.replace("treatment, 'error'", "'?' || treatment, 'error'") + ' SELECT * FROM found')
def _(spark, sf):
    return _readiness(spark, sf)


@register("readiness", "sheet counts_long", READINESS.replace("treatment, 'error'", "'?' || treatment, 'error'") + """
    SELECT count(*) FILTER (level = 'error') n_errors, count(*) FILTER (level = 'warning') n_warnings, 'error' status FROM found""")
def _(spark, sf):
    return D.readiness(_readiness(spark, sf))


# --- intervals ----------------------------------------------------------------------


ASSIGNED = """fragments AS (
    SELECT sample_id, fragment_id, CASE WHEN max(n_hits) > 1 THEN 'Unassigned_MultiMapping' WHEN count(gene_id) = 0 THEN 'Unassigned_NoFeatures'
           WHEN count(DISTINCT gene_id) > 1 THEN 'Unassigned_Ambiguity' ELSE 'Assigned' END category, min(gene_id) gene_id
    FROM hits {where} GROUP BY 1, 2)"""


def _assigned(spark, sf, strand=0):
    exons = V.exons(spark, sf)
    return I.assign_fragments(V.alignments(spark, sf), exons, I.layout(exons, floor=I.READ_BASES), strand)


@register("count_features", "hits", f"""WITH {ASSIGNED.format(where='')}
    SELECT gene_id, sample_id, count(*) count FROM fragments WHERE category = 'Assigned' GROUP BY 1, 2""")
def _(spark, sf):
    return I.count_features(_assigned(spark, sf), V.exons(spark, sf))


@register("count_features_summary", "hits", f"""WITH {ASSIGNED.format(where='')}
    SELECT sample_id, category, count(*) reads FROM fragments GROUP BY 1, 2""")
def _(spark, sf):
    return I.assignment_summary(_assigned(spark, sf))


STRANDED = """WITH s AS (SELECT * REPLACE (CASE WHEN strand {op} f_strand THEN gene_id END AS gene_id) FROM hits), {a}
    SELECT sample_id, category, gene_id, count(*) count FROM (SELECT * REPLACE (CASE WHEN category = 'Assigned' THEN gene_id END AS gene_id) FROM fragments) GROUP BY 1, 2, 3"""


@register("count_features_forward", "hits", STRANDED.format(op="=", a=ASSIGNED.format(where="").replace("FROM hits", "FROM s")))
def _(spark, sf):
    return I.count_with_summary(_assigned(spark, sf, 1), V.exons(spark, sf))


@register("count_features_reverse", "hits", STRANDED.format(op="<>", a=ASSIGNED.format(where="").replace("FROM hits", "FROM s")))
def _(spark, sf):
    return I.count_with_summary(_assigned(spark, sf, 2), V.exons(spark, sf))


STRAND = """fractions AS (SELECT sample_id, count(*) n_fragments, CAST(count(*) FILTER (a) AS DOUBLE) / count(*) forward,
      CAST(count(*) FILTER (NOT o) AS DOUBLE) / count(*) reverse, CAST(count(*) FILTER (o AND NOT a) AS DOUBLE) / count(*) undetermined
    FROM (SELECT sample_id, fragment_id, bool_and(strand = f_strand) a, bool_or(strand = f_strand) o FROM hits
          WHERE f_strand IS NOT NULL GROUP BY 1, 2) GROUP BY 1)"""


@register("strandedness", "hits", f"""WITH {STRAND} SELECT *, CASE WHEN undetermined > CAST(0.75 AS DOUBLE)
    OR (forward < CAST(0.6 AS DOUBLE) AND reverse < CAST(0.6 AS DOUBLE)) THEN 0 WHEN forward >= CAST(0.6 AS DOUBLE) THEN 1 ELSE 2 END strandedness FROM fractions""")
def _(spark, sf):
    exons = V.exons(spark, sf)
    rows = I.strand_fractions(V.alignments(spark, sf), exons, I.layout(exons, floor=I.READ_BASES))
    return rows.withColumn("strandedness", I.strandedness(
        F.col("undetermined"), F.col("forward"), F.col("reverse")))


REGIONS = """tags AS (SELECT sample_id, fragment_id, min(CASE region WHEN 'CDS_Exons' THEN 1 WHEN '5''UTR_Exons' THEN 2
      WHEN '3''UTR_Exons' THEN 3 WHEN 'Introns' THEN 4 ELSE 5 END) r FROM hits GROUP BY 1, 2)"""


@register("read_distribution", "hits", f"""WITH {REGIONS} SELECT *, CASE WHEN exon_pct >= 60 THEN 'mRNA-seq' WHEN exon_pct >= 30 THEN 'suspicious'
      ELSE 'likely_not_mRNA-seq' END verdict, intergenic_pct > 40 high_intergenic FROM (
    SELECT sample_id, count(*) total_tags, count(*) FILTER (r < 5) assigned_tags, count(*) FILTER (r < 4) exon_tags,
      round(CAST(100 * count(*) FILTER (r < 4) AS DOUBLE) / count(*), 1) exon_pct,
      round(CAST(100 * (count(*) - count(*) FILTER (r < 5)) AS DOUBLE) / count(*), 1) intergenic_pct FROM tags GROUP BY 1)""")
def _(spark, sf):
    return I.read_distribution(I.read_regions(V.alignments(spark, sf), V.exons(spark, sf)))


# One base a row: the class of every base that some region covers.
@register("region_bases", "exons", """SELECT chrom, region, count(*) bases FROM (
    SELECT chrom, base, arg_min(region, CASE region WHEN 'CDS_Exons' THEN 1 WHEN '5''UTR_Exons' THEN 2 WHEN '3''UTR_Exons' THEN 3 ELSE 4 END) region
    FROM (SELECT chrom, region, unnest(range("start", "end")) base FROM exons) GROUP BY 1, 2) GROUP BY 1, 2""")
def _(spark, sf):
    # small tiles, so that segments are cut and added up
    flat = I.flat_regions(V.exons(spark, sf), 1000)
    return flat.groupBy("chrom", "region").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


# Exons, and the whole span of each gene on its chromosome: features of very different length.
SPANS = """features AS (SELECT gene_id, chrom, "start", "end" FROM exons UNION ALL
    SELECT 'span of ' || gene_id, chrom, min("start"), max("end") FROM exons GROUP BY gene_id, chrom)"""


@register("count_gene_spans", "alignments exons", f"""WITH {SPANS} SELECT f.gene_id, count(*) pairs, count(DISTINCT a.fragment_id) fragments
    FROM alignments a JOIN features f ON a.chrom = f.chrom AND a."start" < f."end" AND f."start" < a."end" GROUP BY 1""")
def _(spark, sf):
    exons = V.exons(spark, sf).select("gene_id", "chrom", "start", "end")
    spans = exons.groupBy(F.concat(F.lit("span of "), "gene_id").alias("gene_id"), "chrom").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    features = written(exons.unionByName(spans), "gene-spans")
    return I.count_pairs(V.alignments(spark, sf), features)


@register("overlap_pairs", "alignments exons", """SELECT a.sample_id, e.gene_id, count(*) n FROM alignments a JOIN exons e
    ON a.chrom = e.chrom AND a."start" < e."end" AND e."start" < a."end" GROUP BY 1, 2""")
def _(spark, sf):
    exons = V.exons(spark, sf)
    pairs = I.overlap_join(V.alignments(spark, sf), exons, ["gene_id"], I.layout(exons, floor=I.READ_BASES), how="inner")
    return pairs.groupBy("sample_id", F.col("f_gene_id").alias("gene_id")).agg(F.count("*").alias("n"))


@register("transcripts_bed12", "", """
    SELECT transcript_id, '1' chrom, s AS "start", e AS "end", transcript_id AS name, 0 score, '+' strand, s thick_start, e thick_end, 0 rgb,
           CAST(n AS INT) block_count, sizes || ',' block_sizes, starts || ',' block_starts
    FROM (SELECT p_brand || '_' || p_type transcript_id, count(*) n, min(p_partkey * 10) s, max(p_partkey * 10 + p_size) e,
            string_agg(CAST(p_size AS VARCHAR), ',' ORDER BY p_partkey) sizes,
            string_agg(CAST(p_partkey * 10 - m AS VARCHAR), ',' ORDER BY p_partkey) starts
          FROM (SELECT *, min(p_partkey * 10) OVER (PARTITION BY p_brand, p_type) m FROM part) GROUP BY 1)""")
def _(spark, sf):
    rows = V.table(spark, sf, "part").select(
        F.col("p_partkey").alias("line_no"), F.lit("1").alias("chrom"), F.lit("exon").alias("feature"),
        (F.col("p_partkey") * 10).alias("start"), (F.col("p_partkey") * 10 + F.col("p_size")).alias("end"),
        F.lit("+").alias("strand"), F.concat("p_brand", F.lit("_"), "p_type").alias("transcript_id"),
        F.lit("").alias("gene_name"))
    return I.transcripts_bed12(rows, span="union")


# Distinct orders and parts per supplier and return flag, as sketches; then put together per flag and for all.
@register("distinct_sketches", "", """SELECT flag, orders, parts, true near_orders, true near_parts FROM (
    SELECT l_returnflag flag, count(DISTINCT l_orderkey) orders, count(DISTINCT l_partkey) parts FROM lineitem GROUP BY 1
    UNION ALL SELECT NULL, count(DISTINCT l_orderkey), count(DISTINCT l_partkey) FROM lineitem)""")
def _(spark, sf):
    rows = V.table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_suppkey", F.col("l_orderkey").alias("orders"), F.col("l_partkey").alias("parts"))
    names = ["orders", "parts"]
    stored = written(K.distinct_sketches(rows, ["flag", "l_suppkey"], names), "sketches")
    unions = K.merged(stored, ["flag"], names).unionByName(K.merged(stored, [], names).withColumn("flag", F.lit(None).cast("string")))
    exact = rows.groupBy("flag").agg(*[F.countDistinct(c).alias(c) for c in names]).unionByName(
        rows.agg(*[F.countDistinct(c).alias(c) for c in names]).withColumn("flag", F.lit(None).cast("string")))
    guess = K.estimates(unions, names).select(F.col("flag").alias("_flag"), *[F.col(c).alias(f"{c}_guess") for c in names])
    both = exact.join(guess, F.col("flag").eqNullSafe(F.col("_flag")))
    near = [(F.abs(F.col(f"{c}_guess") - F.col(c)) <= 0.02 * F.col(c)).alias(f"near_{c}") for c in names]
    return both.select("flag", *names, *near)
