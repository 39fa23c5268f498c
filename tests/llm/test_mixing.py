"""The mix against a plain apportionment, one block at a time."""

import heapq
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle import compare, connect
from readloom.llm import mixing, queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows],
                                 "doc_id long, text string, source string, size int, target string, block int, quotas string, ordinal int")


def documents(seed, n, sources):
    r = random.Random(seed)
    return [(i, " ".join(["w"] * int(r.paretovariate(0.8))), r.choice(sources)) for i in range(n)]


def targets(sizes):
    """Shares by weight, the excess of sources above their limit shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, held = sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in held]
        if not left:
            return names, {s: 3.0 * sizes[s] for s in names}
        level = (total - sum(3 * sizes[s] for s in held)) / sum(weight[s] for s in left)
        above = {s for s in left if 3 * sizes[s] < weight[s] * level}
        if not above:
            return names, {s: min(3.0 * sizes[s], weight[s] * level) for s in names}
        held |= above


def apportioned(names, target, limit, n):
    """The blocks one after another: the source of each."""
    heap = [(-target[s], i, 1) for i, s in enumerate(names) if limit[s]]
    heapq.heapify(heap)
    row = []
    while heap and len(row) < n:
        _, i, k = heapq.heappop(heap)
        row.append(names[i])
        if k < limit[names[i]]:
            heapq.heappush(heap, (-target[names[i]] / (2 * k + 1), i, k + 1))
    return row


@pytest.mark.parametrize("sources,block", [(["a", "b", None], 1), (["a", "b", "c", "d", "é", "z", None], None), ([f"s{i}" for i in range(40)], 3),
                                           (["only"], 7)])
def test_against_blocks_given_out_one_by_one(spark, sources, block):
    rows = documents(len(sources), 400, sources) + [(None, "two words", "a"), (5, None, "b"), (5, "", None), (5, "same", "a"), (5, "same", "a")]
    rows += [(900 + i, "w " * 20_000, sources[0]) for i in range(2)]
    mixed = mixing.mix(frame(spark, rows), block=block, shards=5, ranges=6)
    got = mixed.collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    names, target = targets(sizes)
    size = got[0].block
    assert block is None or size == block
    row = apportioned(names, target, {s: 3 * sizes[s] // size for s in names}, round(sum(sizes.values()) / size + 1e-9))
    taken, by_source = {}, {r.source: r for r in got}
    for r in got:
        assert r.target == pytest.approx(target[r.source], rel=1e-12) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in names:
        assert by_source[s].blocks == row.count(s) and taken[s] == row.count(s) * size
        if block is None:
            assert abs(taken[s] - target[s]) <= max(1, target[s] / 500)
        assert by_source[s].quotas == [row[:len(row) * i // 5].count(s) for i in range(1, 6)]
    pieces = mixing.pieces(mixed).collect()
    given = {}
    for p in pieces:
        assert p.n_words > 0 and p.first_word >= 0
        given[p.source, p.shard] = given.get((p.source, p.shard), 0) + p.n_words
    for s in names:
        for i in range(5):
            assert given.get((s, i), 0) == size * row[len(row) * i // 5:len(row) * (i + 1) // 5].count(s)


def test_equal_targets_break_ties_by_source(spark):
    rows = [(i, "a b c d e f g h i j", f"s{i:03d}") for i in range(99)]
    got = {r.source: r.blocks for r in mixing.mix(frame(spark, rows), weights=(1,), block=4, shards=7).collect()}
    names = [r[2] for r in rows]
    row = apportioned(names, dict.fromkeys(names, 10.0), dict.fromkeys(names, 7), 248)
    assert got == {s: row.count(s) for s in names} and len(set(got.values())) == 2


def test_counts_of_quotients_by_trial():
    r = np.random.default_rng(5)
    target, limit = r.uniform(0, 1e6, 50).round(3), r.integers(0, 400, 50)
    target[:3] = 0, 1e-9, 1e15
    least = np.concatenate([r.uniform(1, 1e6, 40), target[3:9] / np.arange(1, 13, 2)])
    got = mixing.blocks_above(target, limit, least)
    want = [[sum(t / (2 * k - 1) >= q for k in range(1, m + 1)) for q in least] for t, m in zip(target, limit)]
    assert got.tolist() == want


def test_reruns_and_ranges_agree(spark):
    df = frame(spark, documents(8, 300, ["a", "b", "c", None]))
    first = sorted(map(repr, mixing.mix(df, ranges=3).collect()))
    assert first == sorted(map(repr, mixing.mix(df.repartition(5), ranges=11).collect()))
    assert first != sorted(map(repr, mixing.mix(df, seed=1).collect()))


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " \n", "b")]], ids=["none", "null", "no words"])
def test_tables_without_words(spark, rows):
    got = mixing.mix(frame(spark, rows)).collect()
    assert [(r.size, r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * len(rows)


def test_words_are_runs_between_ascii_blanks(spark):
    texts = [None, "", " ", "a", " a b c ", "\x1ca \x85 b", "x\x0b\x0cy\rz\t", "a" * 2_000_000 + " b", "日 本" * 1000, "\n\n.\n\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", mixing.n_words(F.col("text")).alias("n"))
    for r in df.collect():
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))


def test_query_equals_sql(spark):
    assert compare(spark, connect(SF), "op13_mix", queries.QUERIES["op13_mix"], queries.ORACLE["op13_mix"], SF) is None
