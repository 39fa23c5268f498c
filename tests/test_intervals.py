"""Overlap by bins against plain inequalities, and the counting rules."""

import random

import pytest

from readloom.operators import intervals as I

READ = "sample_id string, fragment_id string, chrom string, start bigint, end bigint, strand string, n_hits int"
EXON = "gene_id string, chrom string, start bigint, end bigint, strand string"


def random_tables(spark, seed, hot=False):
    rnd = random.Random(seed)
    reads, exons = [], []
    for i in range(400):
        start = 500 if hot and i % 3 == 0 else rnd.randint(0, 1000)
        reads.append(("s", f"f{i // 2}", rnd.choice("12"), start, start + rnd.choice([0, 1, 30, 250]), rnd.choice("+-"), 1 + (i % 50 == 0)))
    for i in range(60):
        start = rnd.randint(0, 1000)
        exons.append((f"g{i % 20}", rnd.choice("12"), start, start + rnd.choice([1, 10, 64, 300]), rnd.choice("+-")))
    return reads, exons


def brute(reads, exons, strand=0):
    out = {}
    for s, f, c, a, b, st, hits in reads:
        genes, n = out.setdefault((s, f), (set(), []))
        n.append(hits)
        for g, ec, ea, eb, es in exons:
            if c == ec and a < eb and ea < b and (strand == 0 or (st == es) == (strand == 1)):
                genes.add(g)
    names = ["Unassigned_NoFeatures", "Assigned", "Unassigned_Ambiguity"]
    return {k: "Unassigned_MultiMapping" if max(n) > 1 else names[min(len(g), 2)] for k, (g, n) in out.items()}


@pytest.mark.parametrize("width,salts,strand", [(7, 1, 0), (64, 16, 0), (64, 3, 1), (1000, 5, 2), (100000, 2, 0)])
def test_categories_match_inequality(spark, width, salts, strand):
    reads, exons = random_tables(spark, width + salts, hot=True)
    got = I.assign_fragments(spark.createDataFrame(reads, READ), spark.createDataFrame(exons, EXON), width, strand, salts)
    assert {(r.sample_id, r.fragment_id): r.category for r in got.collect()} == brute(reads, exons, strand)


@pytest.mark.parametrize("width", [3, 50, 700])
@pytest.mark.parametrize("parts", [1, 4, 17])
def test_every_pair_once(spark, width, parts):
    reads, exons = random_tables(spark, 5)
    df = spark.createDataFrame(reads, READ).repartition(parts)
    got = I.overlap_join(df, spark.createDataFrame(exons, EXON), ["gene_id"], width, 4, how="inner")
    want = sum(c == ec and a < eb and ea < b for _, _, c, a, b, _, _ in reads for _, ec, ea, eb, _ in exons)
    assert got.count() == want


def skewed_features(spark, rnd):
    """Many short features and some up to the whole chromosome."""
    exons = [(f"g{i}", rnd.choice("12"), (a := rnd.randint(-2000, 200_000)), a + rnd.choice([0, 1, 5, 20, 30]), rnd.choice("+-")) for i in range(300)]
    exons += [(f"long{i}", rnd.choice("12"), (a := rnd.randint(-2000, 100_000)), a + rnd.choice([200, 3000, 40_000, 150_000]), rnd.choice("+-")) for i in range(12)]
    return exons


@pytest.mark.parametrize("salts", [None, 3])
def test_long_features_stand_in_few_bins(spark, salts):
    rnd = random.Random(8)
    exons = skewed_features(spark, rnd)
    reads = [("s", f"f{i}", rnd.choice("12"), (a := rnd.randint(-2500, 210_000)), a + rnd.choice([0, 1, 40, 900]), rnd.choice("+-"), 1) for i in range(1500)]
    features, df = spark.createDataFrame(exons, EXON), spark.createDataFrame(reads, READ)
    levels = I.layout(features)
    assert 1 < len(levels.widths) < 8
    kept = I._prepared(features, levels, ["gene_id"])
    assert kept.groupBy("f_gene_id").count().agg({"count": "max"}).first()[0] <= I.FAN + 2
    assert I._binned_bytes(features, levels) <= levels.bytes
    want = sorted((f, g) for _, f, c, a, b, _, _ in reads for g, ec, ea, eb, _ in exons if c == ec and a < eb and ea < b)
    got = I.overlap_join(df, features, ["gene_id"], levels, salts, how="inner")
    assert sorted((r.fragment_id, r.f_gene_id) for r in got.collect()) == want
    left = I.overlap_join(df, features, ["gene_id"], levels, salts)
    assert sorted({(r.fragment_id, r.f_gene_id) for r in left.collect() if r.f_gene_id}) == sorted(set(want))
    assert left.select("fragment_id").distinct().count() == 1500


def test_layout_of_few_and_no_features(spark):
    assert I.layout(spark.createDataFrame([], EXON)).widths == (1,)
    assert I.layout(spark.createDataFrame([("x", "1", 5, 5, "+")], EXON)).widths == (1,)
    # two lengths far apart: no level in between
    far = [("x", "1", 0, 10, "+")] * 99 + [("y", "1", 0, 10_000_000, "+")]
    assert len(I.layout(spark.createDataFrame(far, EXON)).widths) == 2


@pytest.mark.parametrize("tile", [7, 100, 1 << 20])
def test_flat_regions_by_base(spark, tile):
    rnd = random.Random(tile)
    regions = [(rnd.choice("12"), (a := rnd.randint(-50, 400)), a + rnd.choice([0, 1, 9, 80, 300]), rnd.choice([*I.REGION_ORDER, "else", None])) for _ in range(80)]
    df = spark.createDataFrame(regions, "chrom string, start bigint, end bigint, region string")
    got = I.flat_regions(df, tile).collect()
    bases = {}
    for r in got:
        assert r.start < r.end
        for p in range(r.start, r.end):
            assert (r.chrom, p) not in bases
            bases[r.chrom, p] = r.region
    want = {}
    for c, a, b, region in regions:
        for p in range(a, b) if region in I.REGION_ORDER else ():
            want[c, p] = min(want.get((c, p), region), region, key=I.REGION_ORDER.index)
    assert bases == want
    reads = [("s", f"f{i}", rnd.choice("12"), (a := rnd.randint(-60, 800)), a + rnd.choice([1, 20, 90]), "+", 1) for i in range(300)]
    known = df.where("region <> 'else' and start < end")
    flat, plain = (I.read_regions(spark.createDataFrame(reads, READ), known, flat=f).collect() for f in (True, False))
    assert sorted(flat) == sorted(plain)


def test_touching_is_not_overlap(spark):
    reads = spark.createDataFrame([("s", "f", "1", 0, 10, "+", 1), ("s", "g", "1", 0, 11, "+", 1)], READ)
    exons = spark.createDataFrame([("x", "1", 10, 20, "+")], EXON)
    named = I.with_gene_ids(I.assign_fragments(reads, exons, 8), exons)
    assert {r.fragment_id: r.gene_id for r in named.collect()} == {"f": None, "g": "x"}
    counts = I.count_features(I.assign_fragments(reads, exons, 8), exons).collect()
    assert [tuple(r) for r in counts] == [("x", "s", 1)]
    assert I.bin_width(exons) == 10


@pytest.mark.parametrize("u,f,r,want", [(.8, .1, .1, 0), (0., .6, .4, 1), (0., .4, .6, 2), (0., .5, .5, 0)])
def test_strandedness(spark, u, f, r, want):
    df = spark.createDataFrame([(u, f, r)], "u double, f double, r double")
    assert df.select(I.strandedness(df.u, df.f, df.r)).first()[0] == want


def test_strand_fractions(spark, rows):
    reads = spark.createDataFrame([("s", "a", "1", 0, 5, "+", 1), ("s", "b", "1", 0, 5, "-", 1), ("s", "c", "1", 90, 95, "+", 1), ("s", "d", "1", 30, 35, "+", 1)], READ)
    genes = spark.createDataFrame([("x", "1", 0, 10, "+"), ("y", "1", 30, 40, "+"), ("z", "1", 30, 40, "-")], EXON)
    assert rows(I.strand_fractions(reads, genes, 16)) == [("s", 3, 1 / 3, 1 / 3, 1 / 3)]


@pytest.mark.parametrize("pct,want", [(60.0, "mRNA-seq"), (59.9, "suspicious"), (29.9, "likely_not_mRNA-seq")])
def test_library_verdict(spark, pct, want):
    df = spark.createDataFrame([(pct,)], "p double")
    assert df.select(I.library_verdict(df.p)).first()[0] == want


GTF = """#!header
1\tx\ttranscript\t101\t400\t.\t+\t.\tgene_id "G"; transcript_id "t1"; gene_name "Alpha";
1\tx\texon\t301\t400\t.\t+\t.\tgene_id "G"; transcript_id "t1"; gene_name "Alpha";
1\tx\texon\t101\t150\t.\t+\t.\tgene_id "G"; transcript_id "t1"; gene_name "Alpha";
1\tx\texon\t11\t20\t.\t-\t.\tgene_id "G"; transcript_id "t2"; gene_name "Beta";
1\tx\ttranscript\t1\t50\t.\t-\t.\tgene_id "G"; transcript_id "t2"; gene_name "Beta";
2\tx\texon\t31\t40\t.\t-\t.\tgene_id "H"; transcript_id "t3";
2\tx\texon\t11\t20\t.\t-\t.\tgene_id "H"; transcript_id "t3";
2\tx\ttranscript\t1\t50\t.\t-\t.\tgene_id "H"; transcript_id "t4";
2\tx\tCDS\t1\t50\t.\t-\t.\tgene_id "H"; transcript_id "t5";
2\tx\texon\t1\t50\t.\t-\t.\tgene_id "H";
short line
"""


def test_bed12(spark, tmp_path):
    from readloom.sinks.writers import write_bed12
    from readloom.sources.files import read_gtf

    (tmp_path / "a.gtf").write_text(GTF)
    ann = read_gtf(spark, str(tmp_path / "a.gtf"))
    got = {r.transcript_id: (r.chrom, r.start, r.end, r.name, r.block_count, r.block_sizes, r.block_starts)
           for r in I.transcripts_bed12(ann).collect()}
    assert got == {
        "t1": ("1", 100, 400, "Alpha", 2, "50,100,", "0,200,"),
        "t2": ("1", 0, 50, "t2", 1, "10,", "10,"),
        "t3": ("2", 30, 40, "t3", 2, "10,10,", "-20,0,")}
    union = {r.transcript_id: (r.start, r.end, r.block_starts) for r in I.transcripts_bed12(ann, span="union").collect()}
    assert union["t3"] == (10, 40, "0,20,") and union["t1"] == (100, 400, "0,200,")
    write_bed12(I.transcripts_bed12(ann), str(tmp_path / "out"))
    lines = [x for p in (tmp_path / "out").glob("*.csv") for x in p.read_text().splitlines()]
    assert "1\t100\t400\tAlpha\t0\t+\t100\t400\t0\t2\t50,100,\t0,200," in lines


@pytest.mark.parametrize("most", [0, 64 << 20])
def test_pairs_and_fragments_by_brute_force(spark, monkeypatch, most):
    """Repeated fragments, features that nest, repeat, touch and are empty; with and without broadcasts."""
    monkeypatch.setattr(I, "BROADCAST_BYTES", most)
    r = random.Random(12)
    exons = [(r.choice(["g1", "g2", None]), r.choice("12"), a, a + r.choice([0, 1, 7, 30])) for a in (r.randint(0, 400) for _ in range(60))]
    exons += exons[:5] + [("g1", "1", 0, 5000), ("g3", "2", 100, 4000)]
    reads = [(r.choice([None, *map(str, range(120))]), r.choice("12"), a, a + r.choice([0, 1, 20])) for a in (r.randint(0, 600) for _ in range(200))]
    want = {}
    for gene, chrom, start, end in exons:
        for fragment, c, a, b in reads:
            if c == chrom and a < end and start < b:
                pairs = want.setdefault(gene, [0, set()])
                pairs[0] += 1
                pairs[1] |= {fragment} - {None}
    got = I.count_pairs(spark.createDataFrame(reads, "fragment_id string, chrom string, start bigint, end bigint"),
                        spark.createDataFrame(exons, "gene_id string, chrom string, start bigint, end bigint"))
    assert {x.gene_id: (x.pairs, x.fragments) for x in got.collect()} == {g: (n, len(f)) for g, (n, f) in want.items()}
