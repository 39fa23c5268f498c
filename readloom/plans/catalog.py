"""Registry of queries over the test tables, each with its SQL twin.

``register`` pairs a Spark query with the SQL that must give the same rows.
``sql`` builds that text from the role views it names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# The role views of ``views.py`` in SQL. A view may use those above it.
VIEWS = {
    "counts_long": """
        SELECT CAST(l_partkey AS VARCHAR) gene_id, CAST(l_suppkey AS VARCHAR) sample_id,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) count
        FROM lineitem GROUP BY ALL""",
    "sheet": """
        SELECT 'PRJ_' || (s_suppkey % 4) project_id, CAST(s_suppkey AS VARCHAR) sample_id,
               'Run_' || CASE s_suppkey % 3 WHEN 0 THEN 'HPC' WHEN 1 THEN 'pfc' ELSE 'XYZ' END
               || '_' || s_suppkey || CASE WHEN s_suppkey % 2 = 0 THEN 'M' ELSE 'F' END || '_'
               || CASE WHEN s_suppkey % 5 < 2 THEN 'W' WHEN s_suppkey % 5 < 4 THEN 'H' ELSE 'Q' END sample_name,
               r_name AS condition, n_name tissue,
               CASE WHEN s_suppkey % 2 = 0 THEN 'Male' ELSE 'Female' END sex,
               CASE WHEN s_suppkey % 11 = 0 THEN 'x' ELSE CAST(s_suppkey % 3 + 1 AS VARCHAR) END replicate,
               CASE WHEN s_suppkey % 19 <> 0 THEN CAST(s_suppkey % 2 + 1 AS VARCHAR) END batch,
               CASE s_suppkey % 13 WHEN 0 THEN 'mate-pair' WHEN 1 THEN '' ELSE 'paired-end' END read_type,
               CASE s_suppkey % 7 WHEN 0 THEN 'WGS' WHEN 1 THEN 'ATAC-seq' WHEN 2 THEN 'Hi-C'
                    ELSE 'RNA-seq' END library_type,
               '/data/' || replace(s_name, 'Supplier#', 'S') ||
                 CASE WHEN s_suppkey % 3 = 0 THEN '_R1_001.fastq.gz' ELSE '_1.fq.gz' END fastq_1,
               CASE WHEN s_suppkey % 9 = 0 THEN NULL WHEN s_suppkey % 9 = 1 THEN ' '
                    ELSE '/data/' || replace(s_name, 'Supplier#', 'S') ||
                      CASE WHEN s_suppkey % 3 = 0 THEN '_R2_001.fastq.gz' ELSE '_2.fq.gz' END END fastq_2,
               'human' species, CASE WHEN s_suppkey % 8 = 0 THEN '' ELSE 'GRCh38' END genome_build,
               CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE 'note' END notes
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "metrics": """
        SELECT CAST(l_suppkey AS VARCHAR) sample_id,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) total_reads,
               CAST(100 * count(*) FILTER (l_returnflag = 'A') AS DOUBLE) / count(*) uniquely_mapped_pct,
               CAST(100 * count(*) FILTER (l_linestatus = 'O') AS DOUBLE) / count(*) assignment_rate,
               CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / count(*) mismatch_rate,
               CAST(100 * count(*) FILTER (l_quantity <= 2) AS DOUBLE) / count(*) too_short_pct,
               CAST(100 * count(*) FILTER (l_tax < CAST(0.015 AS DOUBLE)) AS DOUBLE) / count(*) unmapped_short_pct
        FROM lineitem GROUP BY 1""",
    "assignment_long": """
        SELECT CAST(l_suppkey AS VARCHAR) sample_id,
               CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Unassigned_MultiMapping'
                    WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'Unassigned_NoFeatures'
                    WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'Unassigned_Ambiguity'
                    ELSE 'Assigned' END category,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) reads
        FROM lineitem GROUP BY 1, 2""",
    "run_events": """
        SELECT event_id, CAST(user_id AS VARCHAR) run, event_type AS rule, ts, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) k FROM events""",
    "log_lines": """
        SELECT CAST(doc_id AS VARCHAR) file, source AS rule,
               generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS line
        FROM (SELECT doc_id, source, string_split(text, chr(10)) parts FROM documents)""",
    "reads": """
        SELECT *, translate(seq, 'ACGTN', '8:>!E') qual,
               CASE WHEN doc_id % 7 = 0 THEN substr(translate(seq, 'ACGTN', '8:>!E'), 2)
                    ELSE translate(seq, 'ACGTN', '8:>!E') END broken_qual
        FROM (
          SELECT doc_id, source sample_id, source || '_' || lang file, doc_id * 1000000 + pos read_no,
                 CASE WHEN doc_id % 50 = 3 THEN '#' ELSE '@' END || 'read:' || doc_id || ':' || pos AS header,
                 translate(upper(regexp_replace(line, '[^A-Za-z]', 'N', 'g')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTANGTACGTACGTAC') seq,
                 CASE WHEN doc_id % 40 = 5 THEN '' ELSE '+' END plus
          FROM (SELECT doc_id, source, lang, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS line
                FROM (SELECT *, string_split(text, chr(10)) parts FROM documents))
          WHERE line <> '')""",
    "alignments": """
        SELECT CAST(l_suppkey AS VARCHAR) sample_id,
               l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || CAST(l_quantity AS BIGINT) fragment_id,
               CAST(l_linenumber AS VARCHAR) chrom, l_partkey * 10 + l_suppkey % 10 AS "start",
               l_partkey * 10 + l_suppkey % 10 + CAST(l_quantity AS BIGINT) AS "end",
               CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END strand,
               CASE WHEN l_orderkey % 10 = 0 THEN 2 ELSE 1 END n_hits FROM lineitem""",
    "exons": """
        SELECT p_brand gene_id, CAST(p_size % 7 + 1 AS VARCHAR) chrom, p_partkey * 10 AS "start",
               p_partkey * 10 + p_size AS "end", CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE '+' END strand,
               CASE p_type WHEN 'ECONOMY' THEN 'CDS_Exons' WHEN 'STANDARD' THEN '5''UTR_Exons'
                    WHEN 'PROMO' THEN '3''UTR_Exons' ELSE 'Introns' END region FROM part""",
    "de_results": """
        SELECT pair, CAST(gene AS VARCHAR) gene, f, o,
               CASE WHEN f > 0 AND o > 0 THEN ln(CAST(f AS DOUBLE) / o) / ln(CAST(2.0 AS DOUBLE)) END "log2FoldChange",
               CASE WHEN f > 0 AND o > 0 THEN CAST((gene * 31 + f * 7 + o * 3) % 1000 AS DOUBLE) / 5000 END padj
        FROM (SELECT r_name pair, l_partkey gene,
                CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) f,
                CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) o
              FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2)""",
    "artifacts": """
        SELECT CAST(o_custkey AS VARCHAR) run, o_orderpriority artifact,
               '/runs/' || o_custkey || '/' || substr(o_orderpriority, 1, 1) || '/' || o_orderkey AS path,
               CAST(floor(o_totalprice) AS BIGINT) size, o_orderdate mtime FROM orders""",
    "runs": "SELECT CAST(c_custkey AS VARCHAR) run FROM customer",
    "expected_artifacts": """
        SELECT run, artifact, CAST(substr(artifact, 1, 1) AS INT) <= 3 critical
        FROM runs, (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) a(artifact)""",
    "module_status": """
        SELECT lang || '_' || source sample_id, CAST(doc_id AS VARCHAR) AS "module",
               CASE WHEN toxic = 1 THEN 'fail' WHEN quality = 1 THEN 'pass' ELSE 'warn' END status
        FROM labels JOIN documents USING (doc_id)""",
    # metrics judged with the bounds that suit the test tables
    "judged": """
        SELECT *, CASE WHEN uniquely_mapped_pct < CAST(31.5 AS DOUBLE) OR assignment_rate < 47 THEN 'FAIL'
                       WHEN uniquely_mapped_pct < 35 OR assignment_rate < 50 THEN 'WARN'
                       ELSE 'PASS' END status
        FROM metrics""",
    "issues": """
        SELECT * FROM (
          SELECT sample_id, CASE WHEN uniquely_mapped_pct < CAST(31.5 AS DOUBLE) THEN 'critical' ELSE 'warning' END severity,
                 'alignment' category, printf('Low uniquely mapped rate: %.1f%%', uniquely_mapped_pct) message
          FROM metrics WHERE uniquely_mapped_pct < 35
          UNION ALL
          SELECT sample_id, CASE WHEN assignment_rate < 47 THEN 'critical' ELSE 'warning' END,
                 'quantification', printf('Low assignment rate: %.1f%%', assignment_rate)
          FROM metrics WHERE assignment_rate < 50)""",
    "axes": """
        SELECT axis, trim(value) AS value, sample_id FROM (
          SELECT sample_id, 'condition' axis, condition AS value FROM sheet
          UNION ALL SELECT sample_id, 'tissue', tissue FROM sheet
          UNION ALL SELECT sample_id, 'sex', sex FROM sheet
          UNION ALL SELECT sample_id, 'library_type', library_type FROM sheet
          UNION ALL SELECT sample_id, 'genome_build', genome_build FROM sheet
          UNION ALL SELECT sample_id, 'batch', batch FROM sheet)
        WHERE trim(value) <> ''""",
    "hits": """
        SELECT a.*, e.gene_id, e.strand f_strand, e.region
        FROM alignments a LEFT JOIN exons e
          ON a.chrom = e.chrom AND a."start" < e."end" AND e."start" < a."end\"""",
    "base_histogram": """
        SELECT sample_id, pos, ascii(substr(qual, CAST(pos AS INT), 1)) - 33 quality, count(*) n,
               count(*) FILTER (substr(seq, CAST(pos AS INT), 1) = 'N') n_base
        FROM (SELECT sample_id, seq, qual, unnest(generate_series(1, length(qual))) pos FROM reads) GROUP BY 1, 2, 3""",
}
_USES = {
    "expected_artifacts": ["runs"], "judged": ["metrics"], "issues": ["metrics"], "axes": ["sheet"],
    "hits": ["alignments", "exons"], "base_histogram": ["reads"],
}


def sql(views: str, body: str) -> str:
    """``body`` after a WITH clause of the named views and those they use."""
    names: list[str] = []
    for name in views.split():
        for used in [*_USES.get(name, []), name]:
            if used not in names:
                names.append(used)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names)
    body = body.strip()
    if not names:
        return body
    # a body with its own WITH continues the list
    return f"WITH {ctes},\n{body[4:].strip()}" if body.startswith("WITH") else f"WITH {ctes}\n{body}"


def register(name: str, views: str = "", oracle: str | None = None):
    """Decorator: add a query, and its SQL when it has one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = sql(views, oracle)
        return fn

    return add
