"""A mix of sources with target weights, apportioned in blocks of equal words by highest quotients.

Sources in code point order (null last) weigh ``WEIGHTS``, repeating, and share
the words of all documents. A target stops at ``MOST`` times its source's words;
what is left over is shared by weight among the others until none is above:
``target = min(MOST * words, weight * level)``, with the one level at which the
targets add up to the whole.

Blocks. The documents of a source stand in a seeded order, end to end and round
again up to ``MOST`` times; block ``r`` of a source is words ``[r * b, (r + 1) *
b)`` of that ring, so every block has ``b`` words and no word is met more than
``MOST`` times. ``b`` is the largest power of two up to 512 that is a thousandth
of the smallest target at most (or 1), so every source comes within a thousandth
of its target or one word.

Quotas. The mix has one block for each ``b`` words. Blocks go one after another to
the source with the highest quotient ``target / (2 k - 1)``, ``k`` being the
block it would get, ties to the earlier source (Sainte-Lague); a source without
blocks left drops out. The first ``1 / shards`` of this row of blocks is shard 0,
and so on: each shard has a whole number of blocks of every source, and any first
few shards together are apportioned as well. The row is never made: the quotient at
which a shard ends is searched by counting, for many trial values at once, how
many quotients lie above it. So only counts reach the driver, whatever the number
of sources.

Selection. A source's blocks go to the shards in the order of its ring. Word
offsets are prefix sums: rows are dealt out by range of (source, seeded place)
and stored, so a source with a third of all rows is spread over a third of the
ranges. Texts are not shuffled, only ids, sizes and digests.

A null text has no words, null sources are one source, the last. Rows repeated in
full stand side by side in the ring. Sources without words have target 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.functions.ranking import number_rows
from readloom.functions.shipping import ship
from readloom.session import broadcast_if_small, written

WEIGHTS = (5, 2, 1)
MOST = 3
SHARDS = 24
SEED = 42
LARGEST_BLOCK = 512
#: A block is this part of the smallest target at most.
FINENESS = 1000
TRIALS = 63
PART = 1 << 10
BLANK = r"\x20\x09-\x0D"


def n_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks; each is shrunk to one letter, with the blanks around it."""
    shrunk = F.regexp_replace(text, f"[{BLANK}]*+[^{BLANK}]++[{BLANK}]*+", "w")
    return F.when(text.rlike(f"[^{BLANK}]"), F.length(shrunk)).otherwise(0).cast("long")


def placed_words(df: DataFrame, row_id: str, text: str, source: str, seed: int, ranges: int | None) -> DataFrame:
    """``doc_id, source, size, word_at``: words before the row in the seeded order of its source."""
    place = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(row_id).cast("string"), F.lit("")), F.lit(":"),
                           F.coalesce(F.md5(F.col(text).cast("binary")), F.lit(""))))
    rows = df.select(F.col(row_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"),
                     place.alias("place"))
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = (rows.repartitionByRange(ranges, "source", "place").sortWithinPartitions("source", "place")
             .withColumn("range_no", F.spark_partition_id()).withColumn("range_row", F.monotonically_increasing_id()))
    dealt = written(dealt, "mix-ranges")
    totals = dealt.groupBy("range_no", "source").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = totals.select(F.col("range_no").alias("_range"), F.col("source").alias("_source"),
                           F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    here = Window.partitionBy("range_no", "source").orderBy("range_row").rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("inside", F.coalesce(F.sum("size").over(here), F.lit(0)))
    met = (F.col("range_no") == F.col("_range")) & F.col("source").eqNullSafe(F.col("_source"))
    return local.join(starts, met).select("doc_id", "source", "size", (F.col("start") + F.col("inside")).alias("word_at"))


def sources_of(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, ordinal, weight``: one row per source, numbered from 1."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("unnamed", F.col("source").isNull())
    numbered = number_rows(sizes, [], ["unnamed", "source"], "ordinal").drop("unnamed")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("ordinal") - 1, F.lit(len(weights))) + 1).cast("int"))
    return numbered.withColumn("weight", weight.cast("long"))


def level_of(sources: DataFrame, most: int = MOST) -> tuple[int, float]:
    """All words, and words for each unit of weight in a source below its limit.

    Each round sums the limits of the sources above theirs and shares the rest
    anew; a round that finds no further source above ends it.
    """
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return 0, 0.0
    level = total / weight
    limit = F.col("source_size") * most
    while True:
        above = limit < F.col("weight") * F.lit(level)
        held, left = sources.agg(F.coalesce(F.sum(F.when(above, limit)), F.lit(0)), F.sum(F.when(~above, F.col("weight")))).first()
        further = (total - held) / left if left else level
        if further <= level:
            return total, level
        level = further


def block_size(least_target: float | None) -> int:
    size = 1
    while size < LARGEST_BLOCK and least_target and size * 2 <= least_target / FINENESS:
        size *= 2
    return size


def blocks_above(target: np.ndarray, limit: np.ndarray, least: np.ndarray) -> np.ndarray:
    """For each source (row) and quotient (column): blocks whose quotient is the given one or higher."""
    t, most = target[:, None], limit[:, None].astype(float)
    with np.errstate(over="ignore"):
        k = np.minimum(np.floor((t / least + 1) / 2), most)
    # the rounded division may be one off; what counts is the quotient itself
    k += t / (2 * k + 1) >= least
    k -= (k > 0) & (t / np.maximum(2 * k - 1, 1) < least)
    return np.minimum(k, most).astype(np.int64)


def summed(sources: DataFrame, count, n: int) -> np.ndarray:
    """Sums over all sources of the ``n`` numbers that ``count(targets, limits, ordinals)`` gives for some of them."""

    def add(batches):
        sums = np.zeros(n, np.int64)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            for low in range(0, batch.num_rows, PART):
                sums += count(*(c[low:low + PART] for c in columns))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int64)), pa.array(sums)], ["i", "n"])

    out = np.zeros(n, np.int64)
    for r in sources.select("target", "blocks_left", "ordinal").mapInArrow(add, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r.i] = r.n
    return out


def last_with(wanted: np.ndarray, low: int, high: int, count) -> np.ndarray:
    """For each wanted number the last point in ``[low, high)`` whose count, which never rises, is that or more.

    ``count`` gives the counts of an array of points, ``len(wanted)`` rows by ``TRIALS``.
    """
    lows, highs = np.full(len(wanted), low, np.int64), np.full(len(wanted), high, np.int64)
    part = np.arange(1, TRIALS + 1)
    while (highs - lows > 1).any():
        step = (highs - lows) // (TRIALS + 1)
        rest = (highs - lows) % (TRIALS + 1)
        points = np.clip(lows[:, None] + step[:, None] * part + rest[:, None] * part // (TRIALS + 1), lows[:, None], highs[:, None] - 1)
        enough = count(points) >= wanted[:, None]
        held = np.where(enough, points, lows[:, None]).max(axis=1)
        highs = np.where(enough, highs[:, None], points).min(axis=1)
        lows = held
    return lows


def cuts_of(sources: DataFrame, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted number of blocks the least quotient among them, and the last source that has a block with just that quotient.

    Positive doubles have the order of their bits, so the search runs over whole numbers.
    """
    greatest, n = sources.agg(F.max("target"), F.max("ordinal")).first()
    size = len(wanted) * TRIALS

    def quotients(points):
        least = points.view(np.float64).ravel()
        return summed(sources, lambda t, m, _: blocks_above(t, m, least).sum(axis=0), size).reshape(points.shape)

    bits = last_with(wanted, 1, int(np.float64(greatest).view(np.int64)) + 1, quotients)
    least, over = bits.view(np.float64), (bits + 1).view(np.float64)
    sure = summed(sources, lambda t, m, _: blocks_above(t, m, over).sum(axis=0), len(wanted))

    def tied(points):
        upto = -points

        def count(t, m, o):
            has = blocks_above(t, m, least) - blocks_above(t, m, over)
            return (has[:, :, None] * (o[:, None, None] <= upto)).sum(axis=0).ravel()

        return summed(sources, count, size).reshape(points.shape)

    return least, -last_with(wanted - sure, -n, 0, tied)


def quotas_of(sources: DataFrame, shards: int, block: int, total: int) -> DataFrame:
    """The sources with ``quotas``: blocks in shard 0, in shards 0 and 1, and so on up to all."""
    limited = written(sources.withColumn("blocks_left", F.expr(f"source_size * {MOST} div {block}")), "mix-sources")
    most = limited.agg(F.sum("blocks_left")).first()[0] or 0
    n = min((2 * total + block) // (2 * block), most)
    wanted = np.array([n * i // shards for i in range(1, shards + 1)], np.int64)
    if not n:
        return limited.withColumn("quotas", F.array_repeat(F.lit(0).cast("long"), shards))
    some = wanted > 0
    least, last = np.full(shards, np.inf), np.zeros(shards, np.int64)
    least[some], last[some] = cuts_of(limited, wanted[some])
    over = np.where(some, np.nextafter(least, np.inf), np.inf)
    names = limited.columns

    def share(batches):
        for batch in batches:
            t, m, o = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("target", "blocks_left", "ordinal"))
            sure = blocks_above(t, m, over)
            tie = (blocks_above(t, m, least) > sure) & (o[:, None] <= last)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(sure + tie), pa.list_(pa.int64()))], [*names, "quotas"])

    return limited.mapInArrow(share, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in limited.schema)}, quotas array<long>")


def mix(df: DataFrame, row_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
        shards: int = SHARDS, seed: int = SEED, block: int | None = None, ranges: int | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken, blocks, source, word_at, block, quotas`` for every row.

    ``taken``: words of the row in the mix, repeats counted. ``blocks``: blocks of
    the row's source. ``pieces`` tells which words go to which shard.
    """
    rows = written(placed_words(df, row_id, text, source, seed, ranges), "mix-rows")
    sources = written(sources_of(rows, weights), "mix-weights")
    total, level = level_of(sources)
    limit = F.col("source_size") * MOST
    sources = sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(level)))
    block = block or block_size(sources.where("target > 0").agg(F.min("target")).first()[0])
    shared = quotas_of(sources, shards, block, total).select(
        F.col("source").alias("_source"), "source_size", "target", "quotas", F.element_at("quotas", -1).alias("blocks"))
    joined = rows.join(broadcast_if_small(shared, "mix-quotas"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    words = F.col("blocks") * block
    round_ = F.greatest("source_size", F.lit(1))
    rounds, rest = F.call_function("div", words, round_), F.pmod(words, round_)
    taken = rounds * F.col("size") + F.least(F.greatest(rest - F.col("word_at"), F.lit(0)), F.col("size"))
    return joined.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "blocks", "source", "word_at",
                         F.lit(block).cast("long").alias("block"), "quotas")


def pieces(mixed: DataFrame) -> DataFrame:
    """``doc_id, source, shard, round, first_word, n_words``: the words of each row in each shard, from the result of ``mix``.

    ``first_word`` counts from 0 within the text. A row of no words has no pieces.
    """
    again = mixed.where("taken > 0").withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    start = F.col("word_at") + F.col("round") * F.col("source_size")
    ends = F.transform("quotas", lambda q: q * F.col("block"))
    spans = F.transform(ends, lambda e, i: F.struct(
        i.alias("shard"), F.greatest(start, F.when(i > 0, F.get(ends, i - 1)).otherwise(0)).alias("a"),
        F.least(start + F.col("size"), e).alias("b")))
    one = again.select("doc_id", "source", "round", start.alias("start"), F.explode(F.filter(spans, lambda s: s["a"] < s["b"])).alias("s"))
    return one.select("doc_id", "source", "s.shard", "round", (F.col("s.a") - F.col("start")).alias("first_word"),
                      (F.col("s.b") - F.col("s.a")).alias("n_words"))


ship(__name__)
