"""Genomic-interval operators: overlap by bins, counted per fragment.

Spark has no range join, so both sides are cut into fixed bins of the genome
and joined on (chromosome, bin). Bins come in levels, each ``FAN`` times as wide as
the one below: a feature stands in the bins of the lowest level of which it
covers a few, so one of a million bases is no more rows than one of a hundred, and a read asks its bins of
every level that has features. Features of a checked size are broadcast.
Beyond it, a third of all reads may sit on one gene, so the reads also carry a
salt and each feature is repeated once per salt.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.session import written


def bin_of(position: Column, width: int) -> Column:
    """Whole bin number, also below 0."""
    at = position.cast("bigint")
    return F.call_function("div", at - F.pmod(at, F.lit(width)), F.lit(width))


def bins(start: Column, end: Column, width: int) -> Column:
    """Bins of a half-open interval; an empty interval lies in the bin of its start."""
    return F.sequence(bin_of(start, width), bin_of(F.greatest(end - 1, start), width))


def bin_width(features: DataFrame, share: float = 0.95, floor: int = 1) -> int:
    """Bin width for a feature table: a high percentile of feature length.

    One small aggregate over the annotation; pass the result on.
    """
    length = features.agg(
        F.percentile_approx(F.col("end") - F.col("start"), share, 1000).alias("w")).first()["w"]
    return max(int(length or 0), floor)


#: A level's bins are so many times as wide as those of the level below; a feature covers ``FAN + 1`` of its level at most.
FAN = 8
#: A floor for the lowest level: bins shorter than a usual read only make more rows of each read.
READ_BASES = 64


@dataclass(frozen=True)
class Layout:
    """Bin widths, one per level, rising; and bytes that the binned features take at most, if measured."""

    widths: tuple[int, ...]
    bytes: int | None = None

    def keys(self, start: Column, end: Column) -> Column:
        """The bins of an interval on every level; a key holds bin and level."""
        each = [self._keyed(bins(start, end, w), k) for k, w in enumerate(self.widths)]
        return each[0] if len(each) == 1 else F.flatten(F.array(*each))

    def _keyed(self, numbers: Column, k: int) -> Column:
        n = len(self.widths)
        return numbers if n == 1 else F.transform(numbers, lambda b: b * n + k)

    def level(self, start: Column, end: Column) -> Column:
        """The lowest level of which the interval covers ``FAN + 1`` bins at most; the highest if there is none."""
        out = F.lit(len(self.widths) - 1)
        for k in reversed(range(len(self.widths) - 1)):
            out = F.when(end - start <= FAN * self.widths[k], k).otherwise(out)
        return out

    def on_level(self, level: Column, use) -> Column:
        """``use(width, k)`` of the given level."""
        out = use(self.widths[-1], len(self.widths) - 1)
        for k in reversed(range(len(self.widths) - 1)):
            out = F.when(level == k, use(self.widths[k], k)).otherwise(out)
        return out

    def feature_keys(self, start: Column, end: Column) -> Column:
        return self.on_level(self.level(start, end), lambda w, k: self._keyed(bins(start, end, w), k))

    def key_at(self, position: Column, key: Column) -> Column:
        """The key of a position on the level of another key."""
        n = len(self.widths)
        return self.on_level(F.pmod(key, F.lit(n)), lambda w, k: bin_of(position, w) * n + k)


def layout(features: DataFrame, share: float = 0.95, floor: int = 1) -> Layout:
    """Levels for a feature table, the lowest as wide as a high percentile of feature length; and its size once binned.

    One aggregate over the annotation, and one more when some features are much longer; pass the result on.
    """
    length = F.greatest(F.col("end") - F.col("start"), F.lit(0)).cast("bigint")
    size = F.octet_length(F.to_json(F.struct(*features.columns))).cast("bigint")
    r = features.agg(F.percentile_approx(length, share, 1000).alias("w"), F.max(length).alias("longest"),
                     F.sum(size).alias("bytes"), F.sum(size * (length.cast("double"))).alias("by_length")).first()
    width = max(int(r.w or 0), floor)
    widths = [width]
    while (r.longest or 0) > FAN * widths[-1]:
        widths.append(widths[-1] * FAN)
    if len(widths) > 1:
        every = Layout(tuple(widths))
        used = features.select(every.level(F.col("start"), F.col("end")).alias("k")).distinct().collect()
        widths = [widths[x.k] for x in sorted(used)]
    rows = min(2 + (r.by_length or 0) / width / max(r.bytes or 0, 1), FAN + 2)
    return Layout(tuple(widths), int((r.bytes or 0) * rows))


def as_layout(width: int | Layout) -> Layout:
    return width if isinstance(width, Layout) else Layout((width,))


def _prepared(features: DataFrame, levels: Layout, columns: list[str]) -> DataFrame:
    return features.select(
        F.col("chrom").alias("f_chrom"), F.col("start").alias("f_start"), F.col("end").alias("f_end"),
        *[F.col(c).alias(f"f_{c}") for c in columns],
        F.explode(levels.feature_keys(F.col("start"), F.col("end"))).alias("f_bin"),
    )


#: Features (one row per bin) up to this size are sent to every task.
BROADCAST_BYTES = 64 << 20
#: Reads of one bin that one task may take before the bin is salted.
BIN_ROWS = 2_000_000


def _binned_bytes(features: DataFrame, levels: Layout) -> int:
    """Bytes of the features as text, each counted once per bin: one aggregate over the annotation."""
    size = F.octet_length(F.to_json(F.struct(*features.columns)))
    return features.agg(F.sum(size.cast("bigint") * F.size(levels.feature_keys(F.col("start"), F.col("end"))))).first()[0] or 0


def _salts_for(left: DataFrame) -> int:
    """Salts that leave no more than ``BIN_ROWS`` reads of the fullest bin together."""
    fullest = left.groupBy("chrom", "_bin").count().agg(F.max("count")).first()[0] or 0
    return -(-fullest // BIN_ROWS) or 1


def overlap_join(
    reads: DataFrame,
    features: DataFrame,
    feature_columns: list[str],
    width: int | Layout,
    salts: int | None = None,
    key: list[str] | None = None,
    strand: int = 0,
    how: str = "left",
) -> DataFrame:
    """Reads with the features they overlap (half-open).

    ``width``: the ``layout`` of the features, or one bin width for all. ``how="inner"`` gives every pair exactly once: a pair counts in the bin of
    the larger start. ``how="left"`` may repeat a pair over bins and keeps
    reads without a feature; aggregate it with idempotent functions.
    ``strand``: 0 ignores strands, 1 wants the same, 2 the opposite.

    Features are measured when this is called, unless their layout knows their size. Up to ``BROADCAST_BYTES`` they
    are broadcast and no read moves. Beyond, or when ``salts`` is given, both
    sides are shuffled by bin and salt; without a number the fullest bin is
    counted and gives it. With ``inner`` the levels of a layout are then joined one by one, each in its own way.
    """
    key = key or ["fragment_id"]
    levels = as_layout(width)
    left = reads.withColumn("_bin", F.explode(levels.keys(F.col("start"), F.col("end"))))
    columns = list(dict.fromkeys([*feature_columns, *(["strand"] if strand else [])]))
    right = _prepared(features, levels, columns)
    on = (
        (F.col("chrom") == F.col("f_chrom")) & (F.col("_bin") == F.col("f_bin"))
        & (F.col("start") < F.col("f_end")) & (F.col("f_start") < F.col("end"))
    )
    if strand == 1:
        on = on & (F.col("strand") == F.col("f_strand"))
    elif strand == 2:
        on = on & (F.col("strand") != F.col("f_strand"))
    size = levels.bytes
    if salts is None and size is None:
        size = _binned_bytes(features.select("chrom", "start", "end", *columns), levels)
    if how == "inner" and salts is None and size > BROADCAST_BYTES and len(levels.widths) > 1:
        # few long features are broadcast by themselves, so that the many short ones need no salt for their reads
        at = levels.level(F.col("start"), F.col("end"))
        each = [overlap_join(reads, features.where(at == k), feature_columns, Layout((w,)), None, key, strand, how)
                for k, w in enumerate(levels.widths)]
        return reduce(DataFrame.unionByName, each)
    if salts is None and size <= BROADCAST_BYTES:
        right = F.broadcast(right)
    else:
        salts = salts or _salts_for(left)
        left = left.withColumn("_salt", F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int"))
        right = right.withColumn("f_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("_salt") == F.col("f_salt"))
    joined = left.join(right, on, how)
    if how == "inner":
        joined = joined.where(
            F.col("_bin") == levels.key_at(F.greatest(F.col("start"), F.col("f_start")), F.col("_bin")))
    return joined.drop("_bin", "_salt", "f_bin", "f_salt", "f_chrom")


def with_before(features: DataFrame, gene: str = "gene_id") -> DataFrame:
    """The features, each with ``before``: the largest end of those of its gene and chromosome that stand before it.

    A read that overlaps a feature overlaps none before it exactly when it starts at ``before`` or later. The
    order is by start; that of equal features makes no difference once the result is stored.
    """
    earlier = W.partitionBy(gene, "chrom").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    return features.withColumn("before", F.max("end").over(earlier))


def count_pairs(alignments: DataFrame, features: DataFrame, gene: str = "gene_id", floor: int = READ_BASES) -> DataFrame:
    """``gene, pairs, fragments``: alignments on features of each gene, and the fragments among them, each once.

    Alignments are shuffled by fragment, not what they overlap: the only alignment of a fragment counts
    with the first feature of a gene that it overlaps, and needs no name any more. Only the genes of fragments
    with several alignments are made distinct.
    """
    known = written(with_before(features, gene), "features-before")
    reads = alignments.select("fragment_id", "chrom", "start", "end").withColumn("_n", F.count("fragment_id").over(W.partitionBy("fragment_id")))
    reads = reads.withColumn("fragment_id", F.when(F.col("_n") > 1, F.col("fragment_id")))
    hits = overlap_join(reads, known, [gene, "before"], layout(known, floor=floor), key=["start", "fragment_id"], how="inner")
    first = F.col("f_before").isNull() | (F.col("f_before") <= F.col("start"))
    # one row per gene and partition leaves for a fragment's only alignment
    rows = hits.select(F.col(f"f_{gene}").alias(gene), "fragment_id", ((F.col("_n") == 1) & first).cast("int").alias("one"), first.alias("first"))
    alone = rows.groupBy(gene).agg(F.count("*").alias("pairs"), F.sum("one").alias("fragments"))
    several = rows.where(F.col("first") & F.col("fragment_id").isNotNull()).select(gene, "fragment_id").distinct().groupBy(gene).agg(
        F.lit(0).cast("bigint").alias("pairs"), F.count("*").alias("fragments"))
    return alone.unionByName(several).groupBy(gene).agg(F.sum("pairs").alias("pairs"), F.sum("fragments").alias("fragments"))


def gene_codes(features: DataFrame) -> DataFrame:
    """``(gene_code, gene_id)``: a number per gene, so aggregates over genes stay in
    hash maps (Spark sorts for a minimum of texts).

    Two genes with one code would be an error, not a wrong count.
    """
    named = features.groupBy(F.xxhash64("gene_id").alias("gene_code")).agg(
        F.min("gene_id").alias("a"), F.max("gene_id").alias("b"))
    return named.select("gene_code", F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        F.raise_error(F.lit("two gene ids share a code"))).alias("gene_id"))


def assign_fragments(
    alignments: DataFrame,
    exons: DataFrame,
    width: int | Layout,
    strand: int = 0,
    salts: int | None = None,
) -> DataFrame:
    """One row per fragment: its category and, when assigned, the code of its gene.

    A fragment counts once over all its rows. The smallest and largest code
    tell none, one and several genes apart without keeping a set, so the
    aggregation is partial before its shuffle.
    """
    reads = alignments.select("sample_id", "fragment_id", "chrom", "start", "end", "strand", "n_hits")
    coded = exons.withColumn("gene_code", F.xxhash64("gene_id"))
    hits = overlap_join(reads, coded, ["gene_code"], width, salts, ["sample_id", "fragment_id"], strand)
    per_fragment = hits.groupBy("sample_id", "fragment_id").agg(
        F.min("f_gene_code").alias("first_gene"),
        F.max("f_gene_code").alias("last_gene"),
        F.max("n_hits").alias("n_hits"),
    )
    category = (
        F.when(F.col("n_hits") > 1, K.MULTI_MAPPING)
        .when(F.col("first_gene").isNull(), K.NO_FEATURES)
        .when(F.col("first_gene") != F.col("last_gene"), K.AMBIGUITY)
        .otherwise(K.ASSIGNED)
    )
    return per_fragment.select(
        "sample_id", "fragment_id", category.alias("category"),
        F.when(category == K.ASSIGNED, F.col("first_gene")).alias("gene_code"))


def with_gene_ids(coded: DataFrame, exons: DataFrame) -> DataFrame:
    """Gene ids in place of codes; rows without a gene keep NULL."""
    return coded.join(gene_codes(exons), "gene_code", "left").drop("gene_code")


def count_features(assigned: DataFrame, exons: DataFrame) -> DataFrame:
    """Gene counts: ``(gene_id, sample_id, count)``. Names come after counting."""
    counts = assigned.where("gene_code is not null").groupBy("gene_code", "sample_id").agg(
        F.count("*").alias("count"))
    return with_gene_ids(counts, exons).select("gene_id", "sample_id", "count")


def assignment_summary(assigned: DataFrame) -> DataFrame:
    """Fragments per category: ``(sample_id, category, reads)``."""
    return assigned.groupBy("sample_id", "category").agg(F.count("*").alias("reads"))


def count_with_summary(assigned: DataFrame, exons: DataFrame) -> DataFrame:
    """Gene counts and category totals from one pass over the fragments."""
    counts = assigned.groupBy("sample_id", "category", "gene_code").agg(F.count("*").alias("count"))
    return with_gene_ids(counts, exons)


def strand_fractions(
    alignments: DataFrame, transcripts: DataFrame, width: int | Layout, salts: int | None = None
) -> DataFrame:
    """Per sample: share of fragments on the strand of their gene, opposite, undetermined.

    Fragments outside all transcripts do not count; one over transcripts of
    both strands is undetermined.
    """
    reads = alignments.select("sample_id", "fragment_id", "chrom", "start", "end", "strand")
    hits = overlap_join(
        reads, transcripts, ["strand"], width, salts, ["sample_id", "fragment_id"], how="left")
    hits = hits.where("f_strand is not null")
    same = F.col("strand") == F.col("f_strand")
    per_fragment = hits.groupBy("sample_id", "fragment_id").agg(
        F.bool_and(same).alias("all_same"), F.bool_or(same).alias("any_same"))
    n = F.count("*")
    return per_fragment.groupBy("sample_id").agg(
        n.alias("n_fragments"),
        (F.count_if("all_same") / n).alias("forward"),
        (F.count_if(~F.col("any_same")) / n).alias("reverse"),
        (F.count_if(F.col("any_same") & ~F.col("all_same")) / n).alias("undetermined"),
    )


def strandedness(undetermined: Column, forward: Column, reverse: Column) -> Column:
    """0 unstranded, 1 forward, 2 reverse."""
    # 0.75 and 0.6.
    return (
        F.when((undetermined > 0.75) | ((forward < 0.6) & (reverse < 0.6)), 0)
        .when(forward >= 0.6, 1)
        .otherwise(2)
    )


# Region classes in order of precedence, and those that are exonic.
REGION_ORDER = ["CDS_Exons", "5'UTR_Exons", "3'UTR_Exons", "Introns", "Intergenic"]
EXONIC = ["CDS_Exons", "5'UTR_Exons", "3'UTR_Exons"]


#: Regions are cut at multiples of this before they are swept, so that a chromosome is many groups.
TILE = 1 << 20


def flat_regions(regions: DataFrame, tile: int = TILE) -> DataFrame:
    """Disjoint segments ``(chrom, start, end, region)``: every base that some region covers, in its best class.

    A boundary sweep: starts and ends are counted per position and class; summed up along
    a tile they say which classes are open, and a segment lasts while the best of them does.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in REGION_ORDER]), F.col("region")).cast("int")
    start, end = F.col("start"), F.col("end")
    cut = regions.select("chrom", rank.alias("rank"), "start", "end", F.explode(bins(start, end, tile)).alias("tile")).where("start < end and rank > 0")
    low, high = F.col("tile") * tile, (F.col("tile") + 1) * tile
    edges = F.array(F.struct(F.greatest(start, low).alias("at"), F.lit(1).alias("n")), F.struct(F.least(end, high).alias("at"), F.lit(-1).alias("n")))
    edge = cut.select("chrom", "tile", "rank", F.explode(edges).alias("e")).select("chrom", "tile", "rank", "e.at", "e.n")
    classes = range(1, len(REGION_ORDER) + 1)
    met = edge.groupBy("chrom", "tile", "at").agg(*[F.sum(F.when(F.col("rank") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in classes])
    along = W.partitionBy("chrom", "tile").orderBy("at")
    opened = [F.when(F.sum(f"n{k}").over(along) > 0, k) for k in classes]
    best = met.select("chrom", "tile", "at", F.coalesce(*opened).alias("best"))
    turns = best.withColumn("before", F.lag("best").over(along)).where(~F.col("best").eqNullSafe(F.col("before")))
    spans = turns.withColumn("until", F.lead("at").over(along)).where("best is not null")
    name = F.element_at(F.array(*[F.lit(r) for r in REGION_ORDER]), F.col("best"))
    return spans.select("chrom", F.col("at").alias("start"), F.col("until").alias("end"), name.alias("region"))


def read_regions(
    alignments: DataFrame, regions: DataFrame, width: int | Layout | None = None, salts: int | None = None, flat: bool = True
) -> DataFrame:
    """``(sample_id, region, tags)``: every fragment in its best region class.

    ``regions(chrom, start, end, region)``; fragments outside all are Intergenic. The regions are flattened before
    any read is joined, so a read meets each base in one class only. ``flat=False`` joins them as they are.
    Without ``width`` the layout of what is joined is measured.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in REGION_ORDER]), F.col("f_region"))
    reads = alignments.select("sample_id", "fragment_id", "chrom", "start", "end")
    joined = written(flat_regions(regions), "flat-regions") if flat else regions
    hits = overlap_join(reads, joined, ["region"], width if width is not None else layout(joined, floor=READ_BASES), salts, ["sample_id", "fragment_id"])
    best = hits.groupBy("sample_id", "fragment_id").agg(F.min(rank).alias("rank"))
    name = F.element_at(F.array(*[F.lit(r) for r in REGION_ORDER]),
                        F.coalesce(F.col("rank").cast("int"), F.lit(len(REGION_ORDER))))
    return best.groupBy("sample_id", name.alias("region")).agg(F.count("*").alias("tags"))


def read_distribution(region_tags: DataFrame) -> DataFrame:
    """Exon and intergenic share (one decimal) with the library verdict."""
    tags, region = F.col("tags"), F.col("region")
    totals = region_tags.groupBy("sample_id").agg(
        F.sum("tags").cast("bigint").alias("total_tags"),
        F.coalesce(F.sum(F.when(region != "Intergenic", tags)), F.lit(0)).cast("bigint")
        .alias("assigned_tags"),
        F.coalesce(F.sum(F.when(region.isin(EXONIC), tags)), F.lit(0)).cast("bigint")
        .alias("exon_tags"),
    )
    total = F.col("total_tags")

    def pct(part: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(part * 100.0, total), F.lit(0.0)), 1)

    return totals.withColumn("exon_pct", pct(F.col("exon_tags"))).withColumn(
        "intergenic_pct", pct(total - F.col("assigned_tags"))
    ).withColumn("verdict", library_verdict(F.col("exon_pct"))).withColumn(
        "high_intergenic", F.col("intergenic_pct") > 40)


def library_verdict(exon_pct: Column) -> Column:
    # 60 and 30.
    return (
        F.when(exon_pct >= 60, "mRNA-seq").when(exon_pct >= 30, "suspicious")
        .otherwise("likely_not_mRNA-seq")
    )


def transcripts_bed12(annotation: DataFrame, span: str = "row") -> DataFrame:
    """BED12 rows from exon and transcript rows of an annotation.

    ``annotation(line_no, chrom, feature, start, end, strand, transcript_id,
    gene_name)`` with 0-based starts. A transcript row sets the bounds; without
    one they are those of the first exon (``span="row"``) or of all exons
    (``span="union"``). The gene name is used when the transcript row comes
    before its exons. A transcript has a bounded number of exons.
    """
    is_tx, is_exon = F.col("feature") == "transcript", F.col("feature") == "exon"
    bounds = F.struct("chrom", "start", "end", "strand")
    line = F.col("line_no")
    rows = annotation.where((is_tx | is_exon) & (F.col("transcript_id") != ""))
    grouped = rows.groupBy("transcript_id").agg(
        F.max_by(F.when(is_tx, bounds), F.when(is_tx, line)).alias("tx"),
        F.min_by(F.when(is_exon, bounds), F.when(is_exon, line)).alias("first_exon"),
        F.min(F.when(is_exon, F.col("start"))).alias("low"),
        F.max(F.when(is_exon, F.col("end"))).alias("high"),
        F.min_by(F.struct("feature", "gene_name"), "line_no").alias("head"),
        F.array_sort(F.collect_list(F.when(is_exon, F.struct("start", "end")))).alias("exons"),
    ).where(F.size("exons") > 0)
    src = F.coalesce("tx", "first_exon")
    if span == "union":
        start = F.when(F.col("tx").isNull(), F.col("low")).otherwise(src["start"])
        end = F.when(F.col("tx").isNull(), F.col("high")).otherwise(src["end"])
    else:
        start, end = src["start"], src["end"]
    name = F.when((F.col("head.feature") == "transcript") & (F.col("head.gene_name") != ""),
                  F.col("head.gene_name")).otherwise(F.col("transcript_id"))
    out = grouped.select(
        "transcript_id", src["chrom"].alias("chrom"), start.alias("start"), end.alias("end"),
        name.alias("name"), src["strand"].alias("strand"), "exons")

    def joined(values: Column) -> Column:
        return F.concat(F.array_join(values, ","), F.lit(","))

    return out.select(
        "transcript_id", "chrom", "start", "end", "name", F.lit(0).alias("score"), "strand",
        F.col("start").alias("thick_start"), F.col("end").alias("thick_end"), F.lit(0).alias("rgb"),
        F.size("exons").alias("block_count"),
        joined(F.transform("exons", lambda e: (e["end"] - e["start"]).cast("string"))).alias("block_sizes"),
        joined(F.transform("exons", lambda e: (e["start"] - F.col("start")).cast("string")))
        .alias("block_starts"),
    )
