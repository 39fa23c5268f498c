"""Count-matrix operators on long ``(gene_id, sample_id, count)`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.ranking import first_rows
from readloom.functions.stats import population_variance, share


def sample_columns(samples: DataFrame, column: str = "sample_id") -> list[str]:
    """Sorted ids for the columns of a wide matrix."""
    return sorted(r[0] for r in samples.select(F.col(column).cast("string")).distinct().collect())


def to_wide(counts: DataFrame, samples: Sequence[str], gene_col: str = "gene_id") -> DataFrame:
    """Clean matrix: gene id and one column per listed sample, 0 where absent.

    The sample list is an argument, so no job runs to find it and the columns
    come in its order.
    """
    wide = counts.groupBy(F.col(gene_col).alias("Geneid")).pivot("sample_id", list(samples)).agg(
        F.sum("count").cast("bigint"))
    return wide.na.fill(0, [f"`{s}`" for s in samples])


def library_size(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample_id").agg(F.sum("count").cast("bigint").alias("total_counts"))


def gene_total(counts: DataFrame) -> DataFrame:
    """One row: distinct genes."""
    return counts.agg(F.countDistinct("gene_id").alias("n_genes"))


def sample_expression(counts: DataFrame, n_genes: DataFrame | None = None) -> DataFrame:
    """Totals, detected genes, detection rate and mean count over all genes.

    Genes are counted over the whole matrix, so a long table without zero rows
    gives the same rates as the full matrix.
    """
    genes = (n_genes if n_genes is not None else gene_total(counts)).scalar()
    per_sample = counts.groupBy("sample_id").agg(
        F.sum("count").cast("bigint").alias("total_counts"),
        F.count_if(F.col("count") > 0).alias("genes_detected"),
    )
    return (
        per_sample.withColumn("n_genes", genes)
        .withColumn("detection_rate", share(F.col("genes_detected"), F.col("n_genes")))
        .withColumn("avg_count", share(F.col("total_counts"), F.col("n_genes"), 1))
        .drop("n_genes")
    )


def matrix_totals(counts: DataFrame) -> DataFrame:
    """One row: genes, samples, all counts, detected genes per sample on average."""
    per_gene = counts.groupBy("gene_id").agg(
        F.sum("count").alias("total"), F.count_if(F.col("count") > 0).alias("detected"))
    genes = per_gene.agg(
        F.count("*").alias("n_genes"),
        F.sum("total").cast("bigint").alias("total_counts"),
        F.sum("detected").alias("detected"),
    )
    samples = counts.agg(F.countDistinct("sample_id").alias("n")).scalar()
    return genes.withColumn("n_samples", samples).select(
        "n_genes", "n_samples", "total_counts",
        share(F.col("detected"), F.col("n_samples"), 1).alias("avg_genes_detected"),
    )


def highly_expressed(counts: DataFrame, above: int = 10_000, n: int = 10) -> DataFrame:
    """Top ``n`` genes of each sample among those above the bound; ties by gene id."""
    high = counts.where(F.col("count") > above)
    return first_rows(high, ["sample_id"], [F.desc("count"), F.asc("gene_id")], n)


def gene_variance(counts: DataFrame, n_samples: Column | int | None = None) -> DataFrame:
    """Population variance per gene across samples.

    Without ``n_samples`` only the cells present count; with it, absent cells
    are zeros of a matrix of that many samples. Sums are exact integers.
    """
    x = F.col("count").cast("decimal(19,0)")
    per_gene = counts.groupBy("gene_id").agg(
        F.count("count").alias("n_cells"),
        F.sum(x).cast("decimal(19,0)").alias("total"),
        F.sum((x * x).cast("decimal(28,0)")).cast("decimal(26,0)").alias("squares"),
    )
    n = F.col("n_cells") if n_samples is None else (
        F.lit(n_samples) if isinstance(n_samples, int) else n_samples)
    return per_gene.select(
        "gene_id", population_variance(n, F.col("total"), F.col("squares")).alias("variance"))


def top_variable_genes(
    counts: DataFrame, n: int = 20, n_samples: Column | int | None = None
) -> DataFrame:
    """The ``n`` genes that vary most, the smaller id first where equal."""
    return gene_variance(counts, n_samples).orderBy(F.desc("variance"), "gene_id").limit(n)


def top_variable_counts(
    counts: DataFrame, n: int = 20, n_samples: Column | int | None = None
) -> DataFrame:
    """The counts of the genes that vary most: ``(gene_id, variance, sample_id, count)``.

    The ``n`` genes are sent to the counts, which are not shuffled again.
    """
    top = F.broadcast(top_variable_genes(counts, n, n_samples))
    return counts.join(top, "gene_id").select("gene_id", "variance", "sample_id", "count")


def lookup_genes(counts: DataFrame, patterns: Sequence[str]) -> DataFrame:
    """Rows whose gene id contains any pattern, without case."""
    gene, test = F.lower("gene_id"), F.lit(False)
    for p in patterns:
        test = test | gene.contains(p.lower())
    return counts.where(test)


def drop_samples(counts: DataFrame, excluded: Sequence[str]) -> DataFrame:
    return counts.where(~F.col("sample_id").isin(list(excluded)))


def excluded_not_found(counts: DataFrame, excluded: DataFrame) -> DataFrame:
    """Listed samples the matrix does not have."""
    return excluded.select("sample_id").join(
        counts.select("sample_id").distinct(), "sample_id", "left_anti")


def zero_genes(counts: DataFrame, warn_above: float = 30) -> DataFrame:
    """One row: genes, genes that are 0 in every sample, their share, the warning."""
    per_gene = counts.groupBy("gene_id").agg(F.sum("count").alias("total"))
    return per_gene.agg(
        F.count("*").alias("n_genes"),
        F.count_if(F.col("total") == 0).alias("n_zero_genes"),
    ).withColumn(
        "zero_pct", F.round(share(F.col("n_zero_genes"), F.col("n_genes")), 1)
    ).withColumn("warn", F.col("zero_pct") > warn_above)


def assignment_breakdown(assignment: DataFrame) -> DataFrame:
    """Share of every category in the sample's total.

    Rows are summed per category first, so the totals join is as small as
    samples x categories.
    """
    cells = assignment.groupBy("sample_id", "category").agg(
        F.sum("reads").cast("bigint").alias("reads"))
    totals = cells.groupBy("sample_id").agg(F.sum("reads").alias("total"))
    return cells.join(totals, "sample_id").select(
        "sample_id", "category", "reads", share(F.col("reads"), F.col("total")).alias("pct"))


def matrix_shape(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.countDistinct("gene_id").alias("n_genes"),
        F.countDistinct("sample_id").alias("n_samples"),
    )


def expression_band(genes_detected: Column, species: str = "mouse", bands=None) -> Column:
    """``normal``, ``caution`` or ``problem`` for the number of detected genes."""
    normal, caution = (bands or K.EXPRESSION_BANDS)[species]
    return (
        F.when(genes_detected >= normal, "normal")
        .when(genes_detected >= caution, "caution")
        .otherwise("problem")
    )
