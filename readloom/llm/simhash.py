"""Near-duplicate documents by SimHash fingerprints and multi-index hashing.

Fingerprints: 64 bits over the XXH64 values of a text's three-word shingles.

Search for pairs with at most two differing bits: a fingerprint is two segments
of 32 bits, each with a table from segment values to fingerprints. Of two such
fingerprints one segment differs by one bit at most, so each fingerprint
enumerates the ball of radius one around each of its segments, fetches what the
table holds there, and the whole distance is verified inside the join. A changed
bit is set in one of the two only; it is enough that this one looks the other
up, so a ball holds the segment and its set bits' changes, 17 values on average.

A slot of more than ``CROWD`` fingerprints (they share 32 bits and may all be
far apart) is not gone through by each that asks. Whoever meets one is put
aside, and among these the other segment joins the key: each enumerates the
radius-one ball around its whole value, and values at distance two meet there,
in buckets of no more than 65 fingerprints. Such a bucket is a bit set, added up
map-side, and links its members to the least of them. Two balls of radius one
share exactly two values if their centres are one or two bits apart and none
otherwise, so half of what a fingerprint meets there is its number of links.

Equal fingerprints are one node from the start. Components come from rounds of
min-label hooking and pointer jumping over stored tables in the shared folder;
a lost executor repeats one round at most. Nothing of that passes through the
driver but the number of labels that changed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.shipping import ship
from readloom.session import by_shuffle, written

SEED = 42
SHINGLE = 3
DISTANCE = 2
#: Fingerprints in a slot of a segment table that are looked up one by one.
CROWD = 256
SLICE = 1 << 16


def fingerprint(text: str | None) -> int:
    """The text's 64 bits, as a signed number; 0 without words."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    counts = np.zeros(64, np.int64)
    n = max(1, len(words) - SHINGLE + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SLICE):
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[at:at + SLICE], stops[at:at + SLICE])),
                        np.uint64, min(SLICE, n - at))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", into: str = "fp") -> DataFrame:
    """All columns but the text, and the fingerprint (long). A-Z count as a-z; words lie between ASCII blanks.

    A null or empty text has the fingerprint 0. A column already named like
    ``into`` is replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in (text, into)]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(into, T.LongType(), False)])

    def compute(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            found = pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(n)) for n in names), found], [*names, into])

    return df.mapInArrow(compute, schema)


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)


def _slots(fp: Column) -> list[Column]:
    """Keys of both segments: 32 bits of the fingerprint and the table's number."""
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    return [low, F.call_function("shiftrightunsigned", fp, F.lit(32)).bitwiseOR(F.lit(1 << 32))]


def lookups(nodes: DataFrame, fp: str = "fp", distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """``(a, b)``: what the fingerprints meet in the segment tables, at ``distance`` (2) or less; ``b`` null for a crowded slot.

    ``a`` is the fingerprint that asks. Pairs that differ in one segment by one
    bit may come from both tables.
    """
    if distance != DISTANCE:
        raise ValueError("the balls are those for two differing bits")
    whole = F.col(fp)
    table = nodes.select(F.explode(F.array(*_slots(whole))).alias("slot"), whole.alias("b"))
    hot = written(table.groupBy("slot").count().where(F.col("count") > crowd).select("slot"), "crowded")
    held = table.join(hot, "slot", "left_anti").unionByName(hot.select("slot", F.lit(None).cast("long").alias("b")))

    def ball(slot: Column) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(-1), F.lit(31)), lambda i: (i < 0) | (slot.bitwiseAND(_bit(i)) != 0)),
                           lambda i: F.when(i < 0, slot).otherwise(slot.bitwiseXOR(_bit(i))))

    asked = nodes.select(whole.alias("a"), F.explode(F.concat(*map(ball, _slots(whole)))).alias("slot"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return asked.join(by_shuffle(held), "slot").where(F.col("b").isNull() | ((F.col("a") != F.col("b")) & near)).select("a", "b")


def crowd_links(nodes: DataFrame, fp: str = "fp", copies: str = "copies") -> DataFrame:
    """``(a, b, weight)``: each member ``b`` of a shared bucket of whole-value balls, the least member, the copies of all."""
    whole = F.col(fp)
    # -1 stands for the value as it is
    points = nodes.select(whole, copies, F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("i")).select(
        F.when(F.col("i") < 0, whole).otherwise(whole.bitwiseXOR(_bit(F.col("i")))).alias("point"),
        F.when(F.col("i") < 0, F.lit(0).cast("long")).otherwise(_bit(F.col("i"))).alias("bit"), (F.col("i") < 0).alias("own"), copies)
    buckets = points.groupBy("point").agg(F.bit_or("bit").alias("bits"), F.max("own").alias("own"), F.sum(copies).alias("weight"))
    members = F.concat(
        F.when(F.col("own"), F.array("point")).otherwise(F.array().cast("array<bigint>")),
        F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("bits").bitwiseAND(_bit(i)) != 0),
                    lambda i: F.col("point").bitwiseXOR(_bit(i))))
    shared = buckets.where(F.bit_count("bits") + F.col("own").cast("int") > 1)
    return shared.select(members.alias("m"), "weight").select(F.array_min("m").alias("a"), F.explode("m").alias("b"), "weight")


def links(nodes: DataFrame, fp: str = "fp", copies: str = "copies", crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """Edges ``(a, b)`` that connect all fingerprints two bits apart or less, and ``(fp, near)``: documents at the others within two bits."""
    met = written(lookups(nodes, fp, crowd=crowd), "lookups")
    pairs = met.where(F.col("b").isNotNull()).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    aside = written(met.where(F.col("b").isNull()).select(F.col("a").alias(fp)).distinct().join(by_shuffle(nodes.select(fp, copies)), fp), "aside")
    stars = written(crowd_links(aside, fp, copies), "stars")
    edges = pairs.unionByName(stars.where(F.col("a") != F.col("b")).select("a", "b").distinct())
    # pairs of two that were put aside are counted by their buckets
    both = (pairs.join(aside.select(F.col(fp).alias("a"), F.lit(True).alias("a_aside")), "a", "left")
            .join(aside.select(F.col(fp).alias("b"), F.lit(True).alias("b_aside")), "b", "left")
            .where(F.col("a_aside").isNull() | F.col("b_aside").isNull()))
    ways = both.select("a", "b").unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    single = ways.join(by_shuffle(nodes.select(F.col(fp).alias("b"), copies)), "b").groupBy(F.col("a").alias(fp)).agg(F.sum(copies).alias("near"))
    in_crowd = stars.groupBy(F.col("b").alias(fp)).agg(F.sum("weight").alias("weight"), F.count("*").alias("shared")).join(aside, fp).select(
        fp, F.expr(f"(weight - shared * {copies}) div 2").alias("near"))
    return edges, single.unionByName(in_crowd).groupBy(fp).agg(F.sum("near").alias("near"))


def components(edges: DataFrame, a: str = "a", b: str = "b", label: str = "root") -> DataFrame:
    """``(node, root)``: the least node that each node of the edges is connected with.

    Each round every node takes the least label around it (hooking), then the
    label of its label (jumping); rounds end when no label changes. Every table
    of a round is stored before the next.
    """
    both = written(edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
                   .unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))), "edges")
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root")), "labels")
    while True:
        around = (both.join(labels.select(F.col("node").alias("other"), "root"), "other")
                  .groupBy("node").agg(F.min("root").alias("near")))
        # a root hears of lower labels through its members too
        told = around.join(labels, "node").where(F.col("near") < F.col("root")).groupBy("root").agg(
            F.min("near").alias("near")).select(F.col("root").alias("node"), F.col("near").alias("told"))
        hooked = (labels.join(around, "node", "left").join(told, "node", "left")
                  .select("node", F.col("root").alias("old"), F.least("root", "near", "told").alias("root")))
        hooked = written(hooked, "hooked")
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        jumped = written(hooked.join(up, "root", "left")
                         .select("node", F.coalesce("higher", "root").alias("root"), "old"), "labels")
        labels = jumped.select("node", "root")
        if jumped.where(F.col("root") != F.col("old")).limit(1).count() == 0:
            return labels.withColumnRenamed("root", label)


def near_duplicates(df: DataFrame, row_id: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits), ``component_id`` and ``n_links`` for every row.

    ``component_id`` is the least id among documents connected by links; ties
    and repeated rows share it. ``n_links``: other rows whose fingerprint
    differs in two bits at most. Rows without an id never lend theirs to a component.
    """
    prints = written(with_fingerprints(df.select(F.col(row_id).alias("doc_id"), F.col(text).alias("text"))), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "nodes")
    found, degree = links(nodes, crowd=crowd)
    edges = written(found, "links")
    roots = components(edges).withColumnRenamed("node", "fp")
    placed = nodes.join(by_shuffle(roots), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    heads = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = (placed.join(heads, "root").join(degree, "fp", "left")
             .select("fp", "component_id", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links")))
    return (prints.join(by_shuffle(written(known, "components")), "fp")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links"))


def keep_one(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: the one with the least id; of rows that share that id one stays.

    Rows without an id cannot be told apart and all stay.
    """
    first = near_duplicates(df, row_id, text).where(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias(row_id)).distinct()
    named = df.where(F.col(row_id).isNotNull()).join(first, row_id, "left_semi").dropDuplicates([row_id])
    return named.select(df.columns).unionByName(df.where(F.col(row_id).isNull()))


ship(__name__)
