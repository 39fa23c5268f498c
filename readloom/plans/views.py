"""Role views: the domain tables, played by the test tables.

Every view is a plain projection or aggregation of parquet tables; operators
take the result and never know which table it came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.sources.text import spread


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def counts_long(spark: SparkSession, sf: str) -> DataFrame:
    """``(gene_id, sample_id, count)``."""
    # grouped by the numbers, named afterwards
    cells = table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("count"))
    return cells.select(
        F.col("l_partkey").cast("string").alias("gene_id"),
        F.col("l_suppkey").cast("string").alias("sample_id"), "count")


def sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A sample sheet with the usual flaws: blanks, bad numbers, odd values."""
    k = F.col("s_suppkey")
    base = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    name = F.replace("s_name", F.lit("Supplier#"), F.lit("S"))
    stem = F.concat(F.lit("/data/"), name)
    return base.select(
        F.concat(F.lit("PRJ_"), (k % 4).cast("string")).alias("project_id"),
        k.cast("string").alias("sample_id"),
        F.concat(
            F.lit("Run_"), F.when(k % 3 == 0, "HPC").when(k % 3 == 1, "pfc").otherwise("XYZ"),
            F.lit("_"), k.cast("string"), F.when(k % 2 == 0, "M").otherwise("F"), F.lit("_"),
            F.when(k % 5 < 2, "W").when(k % 5 < 4, "H").otherwise("Q")).alias("sample_name"),
        F.col("r_name").alias("condition"),
        F.col("n_name").alias("tissue"),
        F.when(k % 2 == 0, "Male").otherwise("Female").alias("sex"),
        F.when(k % 11 == 0, "x").otherwise((k % 3 + 1).cast("string")).alias("replicate"),
        F.when(k % 19 != 0, (k % 2 + 1).cast("string")).alias("batch"),
        F.when(k % 13 == 0, "mate-pair").when(k % 13 == 1, "").otherwise("paired-end").alias("read_type"),
        F.when(k % 7 == 0, "WGS").when(k % 7 == 1, "ATAC-seq").when(k % 7 == 2, "Hi-C")
        .otherwise("RNA-seq").alias("library_type"),
        F.concat(stem, F.when(k % 3 == 0, "_R1_001.fastq.gz").otherwise("_1.fq.gz")).alias("fastq_1"),
        F.when(k % 9 == 0, F.lit(None)).when(k % 9 == 1, " ")
        .otherwise(F.concat(stem, F.when(k % 3 == 0, "_R2_001.fastq.gz").otherwise("_2.fq.gz")))
        .alias("fastq_2"),
        F.lit("human").alias("species"),
        F.when(k % 8 == 0, "").otherwise("GRCh38").alias("genome_build"),
        F.when(k % 6 == 0, "").otherwise("note").alias("notes"),
    )


def metrics(spark: SparkSession, sf: str) -> DataFrame:
    """``(sample_id, total_reads, uniquely_mapped_pct, ...)`` from shares of rows."""
    n = F.count("*")

    def pct(test) -> F.Column:
        return (F.lit(100) * F.count_if(test)).cast("double") / n

    rows = table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total_reads"),
        pct(F.col("l_returnflag") == "A").alias("uniquely_mapped_pct"),
        pct(F.col("l_linestatus") == "O").alias("assignment_rate"),
        (F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).cast("double") / n).alias("mismatch_rate"),
        pct(F.col("l_quantity") <= 2).alias("too_short_pct"),
        pct(F.col("l_tax") < 0.015).alias("unmapped_short_pct"),
    )
    return rows.select(F.col("l_suppkey").cast("string").alias("sample_id"), *rows.columns[1:])


def assignment_long(spark: SparkSession, sf: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    rows = table(spark, sf, "lineitem").groupBy(
        "l_suppkey",
        F.when((flag == "N") & (status == "F"), K.MULTI_MAPPING)
        .when((flag == "R") & (status == "F"), K.NO_FEATURES)
        .when((flag == "R") & (status == "O"), K.AMBIGUITY)
        .otherwise(K.ASSIGNED).alias("category"),
    ).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("reads"))
    return rows.select(F.col("l_suppkey").cast("string").alias("sample_id"), "category", "reads")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").cast("string").alias("run"),
        F.col("event_type").alias("rule"), "ts", "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``(file, rule, pos, line)``."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("file"), F.col("source").alias("rule"),
        F.posexplode(F.split("text", "\n")).alias("pos", "line"))


_TO_BASE = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTANGTACGTACGTAC")
_TO_QUAL = ("ACGTN", "8:>!E")  # chr(33 + ascii(base) % 42)


def reads(spark: SparkSession, sf: str) -> DataFrame:
    """One read per text line; some records are broken on purpose."""
    d = F.col("doc_id")
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    lines = spread(docs).select(
        "doc_id", "source", "lang", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    ).where("line <> ''")
    # ASCII first: engines differ in upper-casing other letters
    seq = F.translate(F.upper(F.regexp_replace("line", "[^A-Za-z]", "N")), *_TO_BASE)
    qual = F.translate(seq, *_TO_QUAL)
    return lines.select(
        "doc_id",
        F.col("source").alias("sample_id"),
        F.concat("source", F.lit("_"), "lang").alias("file"),
        (d * 1_000_000 + F.col("pos")).alias("read_no"),
        F.concat(F.when(d % 50 == 3, "#").otherwise("@"), F.lit("read:"), d.cast("string"),
                 F.lit(":"), F.col("pos").cast("string")).alias("header"),
        seq.alias("seq"),
        F.when(d % 40 == 5, "").otherwise("+").alias("plus"),
        qual.alias("qual"),
        F.when(d % 7 == 0, F.substr(qual, F.lit(2))).otherwise(qual).alias("broken_qual"),
    )


def alignments(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("l_partkey") * 10 + F.col("l_suppkey") % 10
    length = F.col("l_quantity").cast("bigint")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_linestatus")
    return spread(rows).select(
        F.col("l_suppkey").cast("string").alias("sample_id"),
        F.concat_ws("_", "l_orderkey", "l_linenumber", "l_partkey", length.cast("string")).alias("fragment_id"),
        F.col("l_linenumber").cast("string").alias("chrom"),
        start.alias("start"),
        (start + length).alias("end"),
        F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.when(F.col("l_orderkey") % 10 == 0, 2).otherwise(1).alias("n_hits"),
    )


def exons(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("p_partkey") * 10
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("gene_id"),
        (F.col("p_size") % 7 + 1).cast("string").alias("chrom"),
        start.alias("start"),
        (start + F.col("p_size")).alias("end"),
        F.when(F.col("p_partkey") % 3 == 0, "-").otherwise("+").alias("strand"),
        F.when(F.col("p_type") == "ECONOMY", "CDS_Exons").when(F.col("p_type") == "STANDARD", "5'UTR_Exons")
        .when(F.col("p_type") == "PROMO", "3'UTR_Exons").otherwise("Introns").alias("region"),
    )


def de_results(spark: SparkSession, sf: str) -> DataFrame:
    """``(pair, gene, f, o, log2FoldChange, padj)``."""
    places = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("pair"))
    )
    q = F.col("l_quantity").cast("bigint")
    sums = (
        table(spark, sf, "lineitem")
        # summed per supplier before the join, so it carries one row per pair of keys
        .groupBy("l_suppkey", F.col("l_partkey").alias("gene"))
        .agg(F.sum(F.when(F.col("l_linestatus") == "F", q).otherwise(0)).alias("f"),
             F.sum(F.when(F.col("l_linestatus") == "O", q).otherwise(0)).alias("o"))
        .join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("pair", "gene").agg(F.sum("f").alias("f"), F.sum("o").alias("o"))
    )
    both = (F.col("f") > 0) & (F.col("o") > 0)
    return sums.select(
        "pair", F.col("gene").cast("string").alias("gene"), "f", "o",
        F.when(both, F.ln(F.col("f") / F.col("o")) / F.ln(F.lit(2.0))).alias("log2FoldChange"),
        F.when(both, ((F.col("gene") * 31 + F.col("f") * 7 + F.col("o") * 3) % 1000) / 5000).alias("padj"),
    )


def artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """``(run, artifact, path, size, mtime)``."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("run"),
        F.col("o_orderpriority").alias("artifact"),
        F.concat(F.lit("/runs/"), "o_custkey", F.lit("/"), F.substring("o_orderpriority", 1, 1),
                 F.lit("/"), "o_orderkey").alias("path"),
        F.floor("o_totalprice").cast("bigint").alias("size"),
        F.col("o_orderdate").alias("mtime"),
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("run"))


def expected_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ARTIFACT_KINDS])
    return runs(spark, sf).select("run", F.explode(kinds).alias("artifact")).withColumn(
        "critical", F.substring("artifact", 1, 1).cast("int") <= 3)


ARTIFACT_KINDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def module_status(spark: SparkSession, sf: str) -> DataFrame:
    """``(sample_id, module, status)``: one file per language and source."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return table(spark, sf, "labels").join(docs, "doc_id").select(
        F.concat("lang", F.lit("_"), "source").alias("sample_id"),
        F.col("doc_id").cast("string").alias("module"),
        F.when(F.col("toxic") == 1, "fail").when(F.col("quality") == 1, "pass").otherwise("warn").alias("status"),
    )


def sheet_axes(spark: SparkSession, sf: str) -> DataFrame:
    """Axes of the sheet: ``(axis, value, sample_id)``."""
    from readloom.operators import project as P

    # notes and replicate are technical columns: the operator leaves them out
    names = ["condition", "tissue", "sex", "library_type", "genome_build", "batch", "notes", "replicate"]
    return P.sample_axes(P.metadata_to_long(sheet(spark, sf), columns=names))


# Bounds that make all three verdicts occur on these tables.
TABLE_BOUNDS = {"uniquely_mapped_pct": (35, 31.5), "assignment_rate": (50, 47)}


def table_rules():
    from readloom.operators import rules as R

    return R.with_bounds(R.SAMPLE_RULES, **TABLE_BOUNDS)


def judged(spark: SparkSession, sf: str) -> DataFrame:
    from readloom.operators import sample_qc as Q

    return Q.sample_status(metrics(spark, sf), table_rules())


def judged_with_issues(spark: SparkSession, sf: str) -> DataFrame:
    from readloom.operators import sample_qc as Q

    return judged(spark, sf).withColumn("issues", Q.issue_array(table_rules()))
