"""Near copies: SimHash fingerprints two bits apart or less, and texts that share most of their word shingles.

SimHash comes first: the fingerprints of ``simhash``, looked up in its segment
tables, link texts that differ in two bits at most, as in ``op5``. Copies with more
changes lie farther apart: a text's words (between ASCII blanks, A-Z as a-z) give the
set of its five-word shingles, as XXH64 values; a shorter text is one shingle, a text
without words has none. Texts with the same set are one node from the start. Two nodes
are near copies, too, when their sets have a Jaccard similarity of ``LEAST`` or more.

Candidates for that: ``BANDS`` bands of ``ROWS`` MinHash values each. A pair of
similarity 0.8 meets in none of them with probability ``(1 - 0.8 ** ROWS) **
BANDS``, 3e-6; a more similar one less often. Fingerprints alone do not
reach such pairs: they differ by about ten of the 64 bits, and an index for ten
bits has segments of so few bits that everything meets.

Each bucket first links its members to one centre, the one that meets most others in all
its buckets; a large group of copies has the same centre in nearly all of them. What
such stars leave in different components of a bucket is tried one by one, but only
where the sets can still reach the bound: a shingle that just one component holds
is in common with nothing, a text with too few others is near to none of
the rest, and two that share only what most share, after too many rare ones of their own, are not near.
That leaves out no pair that could be near. Sets are compared whole; only
texts that met another are cut into shingles again for that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.functions.shipping import ship
from readloom.llm.simhash import components, fingerprint, links
from readloom.session import by_shuffle, written

SHINGLE = 5
LEAST = 80  # per cent
BANDS = 24
ROWS = 4
SEED = 42
SLICE = 1 << 9
PART = 128


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text, as sorted 64-bit hashes."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n))


def node_of(shingles: np.ndarray) -> int:
    """A signed number that stands for the whole set."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).view(np.int64))


def multipliers() -> np.ndarray:
    r = np.random.default_rng(SEED)
    return r.integers(0, 1 << 64, (2, BANDS * ROWS + BANDS), dtype=np.uint64) | np.uint64(1)


def band_values(shingles: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """One value for each band, different from band to band; none of an empty set."""
    if not len(shingles):
        return np.empty(0, np.int64)
    k = BANDS * ROWS
    least = np.full(k, np.iinfo(np.uint64).max)
    for low in range(0, len(shingles), SLICE):
        mixed = (shingles[low:low + SLICE, None] ^ numbers[0, :k]) * numbers[1, :k]
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(32))).min(axis=0))
    least = least.reshape(BANDS, ROWS)
    out = numbers[0, k:].copy()
    for row in range(ROWS):
        out = (out ^ least[:, row]) * numbers[1, k:]
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def sketches(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, node, n, bands, fp``: each text's set of shingles, as its number, size and band values, and its fingerprint."""
    rows = df.select(F.col(row_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    of_id = rows.schema["doc_id"].dataType.simpleString()

    def compute(batches):
        numbers = multipliers()
        for batch in batches:
            for low in range(0, batch.num_rows, PART):
                part = batch.slice(low, PART)
                texts = part.column(2).to_pylist()
                sets = [shingle_set(t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(map(node_of, sets), pa.int64()), pa.array(map(len, sets), pa.int64()),
                     pa.array([band_values(s, numbers) for s in sets], pa.list_(pa.int64())), pa.array(map(fingerprint, texts), pa.int64())],
                    ["doc_id", "text_hash", "node", "n", "bands", "fp"])

    return rows.mapInArrow(compute, f"doc_id {of_id}, text_hash long, node long, n long, bands array<long>, fp long")


def sets_of(df: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """``node, shingles`` for the texts whose hashes are wanted."""
    texts = df.select(F.xxhash64(text).alias("text_hash"), F.col(text).alias("text")).join(wanted, "text_hash", "left_semi")

    def compute(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, PART):
                sets = [shingle_set(t.as_py()) for t in batch.column(0).slice(low, PART)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(node_of, sets), pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["node", "shingles"])

    return texts.dropDuplicates(["text_hash"]).select("text").mapInArrow(compute, "node long, shingles array<long>")


def alike(pairs: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """The pairs ``(a, b)`` whose sets have a Jaccard similarity of ``least`` per cent or more."""
    both = (pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(common * (100 + least) >= least * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def _sizes_fit(a: str, b: str, least: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * least


def fingerprint_links(rows: DataFrame) -> DataFrame:
    """``(a, b)``: nodes connected by fingerprints two bits apart or less; ``rows`` as from ``sketches``."""
    of_text = written(rows.select("node", "fp").distinct(), "node-prints")
    prints = written(of_text.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("copies")), "prints")
    found, _ = links(prints)
    first = [by_shuffle(prints.select(F.col("fp").alias(c), F.col("least").alias(f"least_{c}"))) for c in "ab"]
    apart = found.join(first[0], "a").join(first[1], "b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    same = of_text.join(by_shuffle(prints), "fp").select(F.col("least").alias("a"), F.col("node").alias("b"))
    return apart.unionByName(same).where(F.col("a") != F.col("b"))


def stars(met: DataFrame) -> DataFrame:
    """Members ``bucket, node, n, text_hash`` of buckets shared by several, each with its bucket's ``centre`` and ``centre_n``.

    The centre is the member that meets most in all its buckets.
    """
    shared = met.join(by_shuffle(met.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")), "bucket")
    shared = written(shared, "shared")
    weighed = written(shared.join(shared.groupBy("node").agg(F.sum("members").alias("weight")), "node"), "weighed")
    centres = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node", "n")).alias("centre"))
    return weighed.join(centres, "bucket").select(
        "bucket", "node", "n", "text_hash", F.col("centre.node").alias("centre"), F.col("centre.n").alias("centre_n"))


def _split(apart: DataFrame) -> DataFrame:
    """The rows ``(bucket, root, ...)`` of buckets with several roots."""
    several = apart.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return apart.join(several.select("bucket"), "bucket", "left_semi")


#: How often the texts that cannot be near to any of the rest are taken out.
ROUNDS = 3


def contenders(apart: DataFrame, sets: DataFrame, least: int = LEAST, rounds: int = ROUNDS) -> DataFrame:
    """Rows ``bucket, root, node, n``: those of ``apart`` that may still be near one of another root in their bucket.

    A shingle is usable that nodes of several roots hold. Two sets of similarity ``least`` have
    ``least / (100 + least)`` of both their sizes in common, so a node with fewer usable ones than that, with the smallest that may
    be its mate, goes. Others then lose shingles, so that is done ``rounds`` times; any number gives all pairs.
    """
    apart = written(_split(apart), "apart")
    for _ in range(rounds):
        held = apart.select("node", "root").distinct().join(sets, "node").select("node", "root", F.explode("shingles").alias("shingle"))
        several = held.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        usable = held.join(several.select("shingle"), "shingle").groupBy("node").agg(F.count("*").alias("usable"))
        smallest = apart.groupBy("bucket").agg(F.min("n").alias("smallest"))
        mate = F.greatest(F.col("smallest") * 100, F.col("n") * least)
        kept = (apart.select("bucket", "root", "node", "n").join(usable, "node").join(smallest, "bucket")
                .where(F.col("usable") * (100 + least) * 100 >= (F.col("n") * 100 + mate) * least))
        apart = written(_split(written(kept.select("bucket", "root", "node", "n"), "kept")), "apart")
    return apart


def tries(apart: DataFrame, sets: DataFrame, least: int = LEAST) -> DataFrame:
    """``(a, b)``: all pairs of different roots among the nodes of ``contenders`` that may be near.

    The shingles of each set stand in one order, those that one root alone holds first, then the rare ones. What two sets have in
    common lies behind the first shingle they share, in both; so only places are joined behind which enough is left.
    """
    held = apart.select("node", "root", "n").distinct().join(sets, "node").select("node", "root", "n", F.explode("shingles").alias("shingle"))
    known = held.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("holders"))
    order = W.partitionBy("node").orderBy(F.col("low") < F.col("high"), "holders", "shingle")
    placed = held.join(known, "shingle").withColumn("rest", F.col("n") + 1 - F.row_number().over(order))
    first = written(placed.where((F.col("low") < F.col("high")) & (F.col("rest") * 100 >= F.col("n") * least))
                    .select("shingle", "root", "node", "n", "rest"), "prefixes")
    left, right = (first.select("shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("root", "node", "n", "rest"))) for s in "ab")
    tried = left.join(by_shuffle(right), "shingle").where(
        (F.col("root_a") < F.col("root_b")) & _sizes_fit("n_a", "n_b", least)
        & (F.least("rest_a", "rest_b") * (100 + least) >= (F.col("n_a") + F.col("n_b")) * least))
    return tried.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def near_copies(df: DataFrame, row_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``doc_id, text_hash, root`` for every row: rows connected by near copies have the same root."""
    rows = written(sketches(df, row_id, text), "sketches")
    close = written(fingerprint_links(rows), "close")
    nodes = rows.groupBy("node").agg(F.min("text_hash").alias("text_hash"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    met = written(stars(nodes.select("node", "n", "text_hash", F.explode("bands").alias("bucket"))), "candidates")
    sets = written(sets_of(df, met.select("text_hash").distinct(), text), "sets")
    to_centre = met.where((F.col("node") != F.col("centre")) & _sizes_fit("n", "centre_n", least))
    near = alike(to_centre.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), sets, least)
    edges = written(close.unionByName(near), "stars")

    placed = met.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    # the centre has been tried with every member
    apart = placed.where(F.col("node") != F.col("centre")).select("bucket", "root", "node", "n")
    more = alike(tries(contenders(apart, sets, least), sets, least), sets, least)
    roots = components(written(edges.unionByName(more), "near"))
    return (rows.join(roots, "node", "left")
            .select("doc_id", "text_hash", F.coalesce("root", "node").alias("root")))


def keep_one(df: DataFrame, row_id: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """One document of each group of near copies: the one with the least id, then the least hash of its text.

    Rows with the same id and text count as one, the least as JSON stays. Rows
    without an id cannot be told apart and all stay.
    """
    placed = near_copies(df, row_id, text, least).where(F.col("doc_id").isNotNull())
    first = placed.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select(
        F.col("first.doc_id").alias("_doc"), F.col("first.text_hash").alias("_hash"))
    named = df.join(first, (F.col(row_id) == F.col("_doc")) & (F.xxhash64(text) == F.col("_hash")), "left_semi")
    whole = F.struct(*map(F.col, df.columns))
    named = named.groupBy(F.col(row_id).alias("_doc"), F.xxhash64(text).alias("_hash")).agg(
        F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")
    return named.unionByName(df.where(F.col(row_id).isNull()))


ship(__name__)
