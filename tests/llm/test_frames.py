"""The operators on small frames: brute force, and nulls, empty and long texts, ties, repeats, no rows, clashing columns."""

import itertools
import os
import random
import subprocess
import sys
import zlib

import pytest

xxhash = pytest.importorskip("xxhash")

import corpus_pipeline  # noqa: E402
from oracle import compare, connect  # noqa: E402
from readloom.llm import decontaminate, licenses, near_copies, quality, queries, sharding, simhash, substring_dedup, toxicity, url_filter  # noqa: E402

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, item_id string, fp string, margin string, h string"


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice(["ba", "ne", "ti", "ro", "ku", "sa", "mel", "dor"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def frame(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "x", "x", "x", "x") for i, t in zip(ids, texts)], SCHEMA)


LONG = prose(99, 30_000)
ODD = [None, "", " \n", "one", "one", LONG, LONG, prose(1, 60), "né ü 日本 \x00", "a" * 40_000]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF) is None


def test_pipeline_runs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = docs
    kept = [docs.count()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-stage-{n}"
        stage(spark, docs, SF).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if n < 4:
            assert docs.columns == start.columns
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.5 * kept[0]
    assert docs.where("not round_trip").count() == 0
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()) == sorted(
        r.doc_id for r in docs.select("doc_id").collect())


@pytest.mark.parametrize("texts", [ODD, []], ids=["odd", "empty"])
def test_odd_rows(spark, texts):
    """Every operator gives each row its result, whatever the text."""
    df = frame(spark, texts, [3, None, 5, 6, 6, 7, 8, 9, 10, 11][:len(texts)])
    items = spark.createDataFrame([(1, prose(7, 20), "x"), (2, None, "x"), (3, "", "x")], "item_id long, text string, h string")
    labels = spark.createDataFrame([(3, 0, 1), (None, 0, 0), (6, None, None)], "doc_id long, quality int, toxic int")
    n = len(texts)
    assert substring_dedup.cut_repeats(df).count() == n
    assert decontaminate.judge(df, items).where("not contaminated").count() == n
    assert decontaminate.drop_contaminated(df, items).count() == n
    assert licenses.scan_licenses(df).where("n_notices = 0").count() == n
    assert simhash.near_duplicates(df).count() == n
    assert toxicity.judge(df, labels).where("score between 0 and 1").count() == n
    assert toxicity.drop_toxic(df, labels).columns == df.columns
    assert sharding.assign_shards(df).count() == n
    assert quality.judge(df).count() == n


def test_repeats_by_brute_force(spark):
    shared, other = prose(5, 60), prose(6, 90)
    texts = [f"{prose(10, 40)} {shared} {prose(11, 30)}", prose(12, 200), f"{prose(13, 70)}\n{shared}. {prose(14, 40)}",
             f"{other} {prose(15, 10)}", f"{prose(16, 33)} {other}", f"{other[:200]} inserted {other[200:]}", "few words only", "few words only"]
    got = {r.doc_id: r for r in substring_dedup.cut_repeats(frame(spark, texts)).collect()}
    for d in (0, 1, 3, 6, 7):
        assert got[d].text == texts[d] and got[d].n_removed_words == 0
    assert got[2].first_docs == [0] and got[4].first_docs == [3] and got[5].first_docs == [3]
    for d, passage, low in ((2, shared, 25), (4, other, 60), (5, other, 40)):
        assert got[d].n_removed_words >= low
        left, words = got[d].text.split(), texts[d].split()
        assert len(left) == len(words) - got[d].n_removed_words
        # what lies outside the passage stays
        assert all(w in passage.split() for w in words if words.count(w) > left.count(w))


def test_repeats_leave_no_long_passage(spark):
    shared = [prose(s, 50 + s) for s in range(200, 230)]
    texts = [f"{prose(1000 + n, 30)} {shared[n % 30]} {prose(3000 + n, 30)}" for n in range(150)]
    got = [r.text.split() for r in substring_dedup.cut_repeats(frame(spark, texts)).orderBy("doc_id").collect()]
    seen = {}
    for d, w in enumerate(got):
        for k in range(len(w) - 49):
            assert seen.setdefault(tuple(w[k:k + 50]), d) == d


def test_cuts_resist_insertion():
    table = substring_dedup.gear_table()
    text = prose(3, 400)
    words = text.split()
    plain = {d for d in substring_dedup.chunks_of(text, table)[2]}
    moved = {d for d in substring_dedup.chunks_of(" ".join([*words[:200], "new", *words[200:]]), table)[2]}
    assert len(plain & moved) >= 0.8 * len(plain)


def test_simhash_by_brute_force(spark):
    r = random.Random(2)
    base = prose(20, 400).split()
    texts = [" ".join(base)]
    for _ in range(40):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(len(w))] = prose(r.random(), 1)
        texts.append(" ".join(w))
    texts += [prose(50 + n, r.choice([1, 2, 3, 30])) for n in range(40)] + ["", None, "  "]

    def fp(text):
        w = (text or "").encode().lower().split()
        grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    want = [fp(t) for t in texts]
    parent = list(range(len(want)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(want)), 2):
        if (want[i] ^ want[j]).bit_count() <= 2:
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    # whatever is put aside as crowded: nothing, all that meets two, everything
    for crowd in (simhash.CROWD, 1, 0):
        got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, texts), crowd=crowd).collect()}
        for i, f in enumerate(want):
            n_links = sum((f ^ g).bit_count() <= 2 for g in want) - 1
            assert (got[i].fingerprint, got[i].component_id, got[i].n_links) == (f"{f:016x}", find(i), n_links), crowd
    assert sorted(r.doc_id for r in simhash.keep_one(frame(spark, texts)).collect()) == sorted({find(i) for i in range(len(want))})


def test_links_of_close_fingerprints(spark):
    """Fingerprints of zero to four changed bits around few centres, many sharing a whole segment."""
    r = random.Random(12)
    centres = [r.getrandbits(64) for _ in range(4)]
    prints = {0, (1 << 64) - 1, 1 << 63, *centres}
    for _ in range(300):
        f = r.choice(centres)
        for _ in range(r.randint(0, 4)):
            f ^= 1 << r.randrange(64)
        prints.add(f)
        prints.add(centres[0] & 0xFFFFFFFF | r.getrandbits(32) << 32)
    prints = [f - (f >> 63 << 64) for f in sorted(prints)]
    copies = {f: r.randint(1, 3) for f in prints}
    near = {(a, b) for a, b in itertools.combinations(sorted(prints), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    want = {f: sum(copies[b] if a == f else copies[a] for a, b in near if f in (a, b)) for f in prints}
    nodes = spark.createDataFrame(list(copies.items()), "fp long, copies long")
    met = {tuple(sorted(p)) for p in simhash.lookups(nodes, crowd=10_000).collect()}
    assert met == near
    for crowd in (10_000, 40, 3):
        edges, degree = simhash.links(nodes, crowd=crowd)
        got = {r.fp: r.near for r in degree.collect()}
        assert {f: n for f, n in want.items() if n} == {f: n for f, n in got.items() if n}, crowd
        linked = {tuple(sorted(e)) for e in edges.collect()}
        assert linked <= near
        for pairs in (near, linked):
            root = {f: f for f in prints}
            for _ in range(len(prints)):
                before = dict(root)
                for a, b in pairs:
                    root[a] = root[b] = min(root[a], root[b])
                if root == before:
                    break
            if pairs is near:
                whole = root
        assert root == whole, crowd


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95), (200, 201)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 90, 90: 90, 95: 90, 200: 200, 201: 200}


def test_reparameterised_items(spark):
    item = "In spring Anna bought 12 baskets of ripe apples and walked 3 km to the old market where Anna sold 5 of them for a fair price"
    texts = {1: f"{prose(1, 30)} {item} {prose(2, 20)}",
             2: f"{prose(3, 30)} {item.replace('Anna', 'Clara').replace('12', '40').replace('km', 'miles').replace('5', '17')}",
             3: f"{prose(4, 20)} {item.upper()}", 4: " ".join(item.split()[:14]), 5: prose(5, 80)}
    swapped = item.split()
    names = iter(["Clara", "Dora"])
    numbers = iter(["1", "2", "3"])
    texts[6] = " ".join(next(names) if w == "Anna" else next(numbers) if w.isdigit() else w for w in swapped)
    items = spark.createDataFrame([(7, item), (8, "short one"), (9, None)], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate.judge(frame(spark, list(texts.values()), list(texts)), items).collect()}
    assert got == {1: [7], 2: [7], 3: got[3], 4: [], 5: [], 6: got[6]}
    short = frame(spark, ["here is a short one indeed", "short two"], [1, 2])
    assert {r.doc_id: r.item_ids for r in decontaminate.judge(short, items).collect()} == {1: [8], 2: []}


def test_contamination_equals_containment(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = {r.doc_id for r in queries.QUERIES["op3_decontamination"](spark, SF).where("contaminated").collect()}
    assert got >= {d for d, t in docs.items() if any(i in t for i in items)}


def test_toxic_words_are_learnt_and_gaps_tolerated(spark):
    bad = ["grumblor", "snarfik"]
    r = random.Random(4)
    texts, labels = [], []
    for d in range(400):
        words = prose(5000 + d, 60).split()
        toxic = d % 4 == 0
        if toxic:
            words[r.randrange(60)] = r.choice(bad)
        texts.append(" ".join(words))
        labels.append((d, 1, int(toxic)))
    plain = len(texts)
    texts += [f"{prose(1, 30)} {w} {prose(2, 30)}" for w in ("grumblor", "grumbxlor", "grum.blor", "s n a r f i k", "GRUMBLOR!")]
    texts += [prose(9000 + n, 60) for n in range(40)]
    df = frame(spark, texts)
    got = {r.doc_id: r for r in toxicity.judge(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [d for d in range(plain) if zlib.crc32(str(d).encode()) % 3 == 1]
    assert all(got[d].held_out for d in held)
    assert sum(got[d].predicted == labels[d][2] for d in held) >= 0.97 * len(held)
    assert [got[plain + n].predicted for n in range(5)] == [1] * 5
    assert sum(got[plain + 5 + n].predicted for n in range(40)) <= 1


def test_rare_insults_are_learnt_and_chance_words_pass(spark):
    ends = ["ane", "obi", "ule", "ist", "arp", "enk", "oft", "udi", "emo", "irg"]
    r = random.Random(9)
    texts, labels = [], []
    for d in range(1500):
        n = r.randrange(80, 400)
        words = prose(20_000 + d, n).split()
        if d % 10 == 0:  # each word is in few toxic documents, but a toxic document holds several
            for at in r.sample(range(n), max(2, n // 40)):
                words[at] = "grovv" + r.choice(ends)
        elif d % 10 == 5:  # one such word by chance, or the stem alone
            words[r.randrange(n)] = "grovv" + r.choice([*ends, "", ""])
        texts.append(" ".join(words))
        labels.append((d, 1, int(d % 10 == 0)))
    got = {x.doc_id: x for x in toxicity.judge(frame(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    held = [d for d in range(1500) if got[d].held_out]
    toxic = [d for d in held if labels[d][2]]
    assert sum(got[d].predicted for d in toxic) >= 0.9 * len(toxic)
    assert sum(got[d].predicted for d in held if not labels[d][2]) <= 0.02 * len(held)


def test_stretches_counted_in_parts(spark, monkeypatch):
    """A task hands its counts on when it holds so many; the sums stay."""
    texts = [prose(40 + n, 40) + (" gravvik" if n % 3 == 0 else "") for n in range(60)]
    train = spark.createDataFrame([(n, t, int(n % 3 == 0)) for n, t in enumerate([*texts, None, ""])], "doc_id long, text string, toxic int")
    whole = [toxicity.telling_stretches(train), toxicity.telling_stretches(train, (4, 5, 6), "^", None)]
    assert "ravv" in whole[0] and "^grav" in whole[1]
    monkeypatch.setattr(toxicity, "KEPT_STRETCHES", 30)
    assert [toxicity.telling_stretches(train), toxicity.telling_stretches(train, (4, 5, 6), "^", None)] == whole


def test_rows_with_their_text_score_alike(spark):
    """The text goes to a task once, inside the row; batches of more than 256 rows are cut."""
    model = toxicity.train_words({"grumblor": 3, "snarfik": 2}, {w: 1 for w in set(prose(3, 60).split())})
    df = frame(spark, [*(f"{prose(n, 5)} {'grumblor' if n % 7 == 0 else ''}" for n in range(600)), None, ""]).coalesce(1)
    apart = {r.doc_id: (r.score, r.word) for r in toxicity.score(df, model).select("row.doc_id", "score", "word").collect()}
    whole = toxicity.score(df, model, whole=True)
    assert {r.doc_id: (r.score, r.word) for r in whole.select("row.doc_id", "score", "word").collect()} == apart
    assert whole.select("row.*").columns == df.columns
    assert {r.doc_id: r.text for r in whole.select("row.*").collect()} == {r.doc_id: r.text for r in df.collect()}


def test_scores_need_no_package_on_executors(tmp_path):
    code = """
import sys
sys.path.insert(0, {root!r})
from readloom.session import build_session
from readloom.llm import toxicity
import numpy as np
spark = build_session(master="local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
table = np.zeros(toxicity.KINDS ** 3, np.float32)
got = toxicity.score(spark.createDataFrame([(1, "a text"), (2, None)], "doc_id long, text string"), toxicity.Model(table, -1.0))
print("RESULT", got.count(), got.where("predicted = 0").count())
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code.format(root=root)], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=300)
    assert "RESULT 2 2" in out.stdout, out.stderr[-2000:]


def test_shards_are_contiguous_and_even(spark):
    texts = [prose(n % 37, 5 + n % 50) for n in range(900)] + ["same text"] * 500
    rows = sharding.assign_shards(frame(spark, texts), ranges=7).collect()
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    by = {}
    for r in rows:
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id]) + 8
        by.setdefault(r.shard, []).append(r)
    assert all(sorted(x.slot for x in g) == list(range(len(g))) for g in by.values())
    assert all(abs(sum(x.size for x in g) - total / 24) < largest + 1 for g in by.values())
    again = sharding.assign_shards(frame(spark, texts).repartition(5), ranges=3).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)


def test_urls_by_brute_force(spark):
    r = random.Random(6)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "ab.com", "a.b", "é.com", ""]
    paths = ["/", "/en/", "/en/x", "/en", "", "/e"]
    rules = sorted({(r.choice(hosts), r.choice(paths)) for _ in range(25)})
    rules = [(h, p, r.choice(["allow", "block"])) for h, p in rules]
    urls = [f"{r.choice(['http://', 'https://', ''])}{r.choice(['', 'w.', 'W.q.'])}{r.choice(hosts)}{r.choice(paths)}{r.choice(['', '1', '?a=/en/', '#x'])}"
            for _ in range(400)] + [None, "", "://", "http://A.COM/en/\n"]
    df = spark.createDataFrame([(n, u, "x") for n, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {x.page_id: x for x in url_filter.judge_urls(df, spark.createDataFrame(rules, "host string, path string, verdict string"), ranges=5).collect()}
    for n, u in enumerate(urls):
        rest = (u or "").partition("://")[2]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert (got[n].host, got[n].path) == (host, path)
        assert (got[n].rule, got[n].verdict) == best[2:], u


def test_urls_without_rows_or_rules(spark):
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/")], "page_id long, url string")
    assert [x.verdict for x in url_filter.judge_urls(pages, rules).collect()] == ["block"] * 2
    assert [x.verdict for x in url_filter.judge_urls(pages, rules.limit(0)).collect()] == ["allow"] * 2
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_license_bands_and_containment(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction"
    texts = [f"{prose(1, 300)} {mit} {prose(2, 50)}", f"{prose(3, 17)}\n{mit.replace('free of charge', 'at no cost')}", mit[:60],
             f"{prose(4, 500)}. Released under the MIT License.", "licensed software license version"]
    got = {r.doc_id: (r.n_notices, r.licenses) for r in licenses.scan_licenses(frame(spark, texts)).collect()}
    assert got[0] == (1, "MIT") and got[3] == (1, "MIT") and got[2] == got[4] == (0, "")
    for _, text in licenses.TEMPLATES:
        words = licenses.words_of(text)
        marks = set(licenses.anchors(words))
        shingles = licenses.shingle_words(words)
        assert sum(not marks & set(s) for s in shingles) < licenses.LEAST * len(shingles)


def test_quality_thresholds_follow_the_group(spark):
    rows = [(n, prose(n, 80) + (" #tag" * 3 if lang == "xx" else ""), lang, "s") for lang in ("en", "xx") for n in range(300)]
    rows += [(9000, prose(1, 80) + " #tag ###" * 9, "en", "s"), (9001, prose(1, 80) + " $$$ &&& ***" * 30, "xx", "s"),
             (9002, prose(2, 80), None, None), (9003, None, "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {(r.doc_id, r.lang): r.kept for r in quality.judge(df).collect()}
    assert sum(v for (d, _), v in got.items() if d < 9000) == 600
    assert not got[9000, "en"] and not got[9001, "xx"] and got[9002, None] and not got[9003, "en"]


def test_quality_fences_by_brute_force(spark):
    r = random.Random(11)
    groups = {("en", "a"): 400, ("en", "b"): 7, (None, None): 90, ("de", "a"): 1}
    rows = [(n, " ".join([prose(r.random(), 60), "#" * (r.random() < 0.2) * r.randint(1, 90)]), *g)
            for g, size in groups.items() for n in range(size)]
    measured = quality.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    values = {}
    for x in measured.select("lang", "source", *[c.alias(m) for m, c in quality.rates().items()]).collect():
        for m in quality.RULES:
            for key in ((x.lang, x.source), (x.lang,), ()):
                values.setdefault((m, key), []).append(x[m])

    def width(v):
        return 1 << max(v.bit_length() - quality.BITS, 0)

    def fence(m, key):
        bins = sorted(v // width(v) * width(v) for v in values[m, key])
        n = len(bins)
        lowest, q1, q3, highest = (bins[-(-n * share // 100) - 1] for share in (100 - quality.TAIL, 25, 75, quality.TAIL))
        low, high = (lowest - width(lowest), highest + width(highest)) if q1 == q3 else (q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1))
        low = max(low, 0)
        if not key:
            return low, high
        upper, k = fence(m, key[:-1]), quality.PRIOR
        return (n * low + k * upper[0]) // (n + k), -(-(n * high + k * upper[1]) // (n + k))

    got = quality.adaptive_fences(measured).collect()
    assert {(x.lang, x.source) for x in got} == set(groups)
    for x in got:
        for m in quality.RULES:
            assert tuple(x[f"{m}_fence"]) == fence(m, (x.lang, x.source)), (m, x.lang, x.source)


def test_stage_keeps_one_of_near_copies(spark):
    """Groups by brute force: five-word Jaccard of 0.8 or more, whatever the distance of fingerprints."""
    r = random.Random(8)
    texts = []
    for g in range(12):
        base = prose(7000 + g, r.choice([4, 30, 120, 400])).split()
        texts.append(" ".join(base))
        for _ in range(12):
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 8, 14])):
                w[r.randrange(len(w))] = prose(r.random(), 1)
            texts.append(" ".join(w))
    texts += ["", None, " \n"]

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))
    far = 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] == sets[j] or 10 * both >= 8 * len(sets[i] | sets[j]):
            far += (simhash.fingerprint(texts[i]) ^ simhash.fingerprint(texts[j])).bit_count() > 2
            a, b = sorted((root[i], root[j]))
            root = [a if x == b else x for x in root]
    assert far > 20
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, texts), SF)
    assert got.columns == frame(spark, texts).columns
    assert sorted(x.doc_id for x in got.collect()) == sorted(set(root))


def test_stage_links_close_fingerprints(spark):
    """Texts of one fingerprint are one group, however few five-word shingles they share."""
    texts = [" ".join([prose(31, 5)] * 60 + [prose(40 + n, 20)]) for n in range(3)] + [prose(50, 90)]
    assert len({simhash.fingerprint(t) for t in texts[:3]}) == 1
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, texts), SF)
    assert sorted(x.doc_id for x in got.collect()) == [0, 3]


def test_large_group_is_not_tried_pair_by_pair(spark):
    """Variants too far from all others are told by their shingles; pairs that are near stay."""
    r = random.Random(4)
    base = prose(8000, 150).split()

    def variant(words, n):
        w = list(words)
        for at in r.sample(range(len(w)), n):
            w[at] = prose(r.random(), 3).replace(" ", "")
        return w

    # up to 3 words off the base; 7 and more off it; two of those once more, so that they are near each other only
    far = [variant(base, r.choice([7, 8, 12])) for _ in range(60)]
    every = [variant(base, r.choice([1, 2, 3])) for _ in range(60)] + far + [variant(w, 1) for w in far[:2]]
    sets = spark.createDataFrame([(n, near_copies.shingle_set(" ".join(w)).view("int64").tolist()) for n, w in enumerate(every)], "node long, shingles array<long>")
    rows = [("x", 0 if n < 60 else n, n, len(near_copies.shingle_set(" ".join(w)))) for n, w in enumerate(every)]
    left = near_copies.contenders(spark.createDataFrame(rows, "bucket string, root long, node long, n long"), sets)
    pairs = {(x.a, x.b) for x in near_copies.tries(left, sets).collect()}
    assert {(60, 120), (61, 121)} <= pairs and len(pairs) < 20  # of 5,600


def test_stage_with_repeated_ids(spark):
    texts = [prose(1, 80), prose(2, 80), prose(2, 80), prose(1, 80), prose(3, 80), prose(3, 80)]
    got = corpus_pipeline.drop_near_copies(spark, frame(spark, texts, [5, 5, 5, 6, None, None]), SF)
    assert sorted((x.doc_id or 0, x.text) for x in got.collect()) == sorted(
        [(5, texts[0]), (5, texts[1]), (0, texts[4]), (0, texts[4])])


def test_items_in_any_case(spark):
    """The case of an item's words makes no difference, other names and numbers none either; other plain words do."""
    item = "In spring Anna bought 12 baskets of ripe apples and walked 3 km to the old market where Anna sold 5 of them for a fair price"
    names = iter(["Clara", "Dora"])
    numbers = iter(["1", "2", "3"])
    swapped = " ".join(next(names) if w == "Anna" else next(numbers) if w.isdigit() else w for w in item.split())
    texts = [item.lower(), f"{prose(4, 20)} {item.upper()}", item.title(), swapped,
             f"yes, in spring{item[9:].replace('Anna', 'Clara')}", "one day Clara and Dora met and " * 5, item.lower()[:50]]
    items = spark.createDataFrame([(7, item), (8, "Anna Berg"), (9, "Where did Anna Berg of Kent live")], "item_id long, text string")
    got = {r.doc_id: r.item_ids for r in decontaminate.judge(frame(spark, texts), items).collect()}
    # two capitalised words in a row are the second item with another name
    assert got == {0: [7], 1: [7], 2: [7, 8], 3: [7], 4: [7], 5: [], 6: []}
    lower = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    found = decontaminate.judge(frame(spark, lower), bench).collect()
    assert all(r.contaminated for r in found)


def test_licenses_shorter_than_a_shingle(spark):
    texts = [f"{prose(1, 40)}\nAll rights\n reserved.", "ALL RIGHTS RESERVED", "All rights are reserved", "overall rights reserved", None, "",
             f"{prose(2, 20)} Released under the MIT License. All rights reserved. All rights reserved."]
    df = frame(spark, texts)
    got = {r.doc_id: r.licenses for r in licenses.scan_licenses(df, licenses.NOTICES).collect()}
    name = "All-rights-reserved"
    assert got == {0: name, 1: name, 2: "", 3: "", 4: "", 5: "", 6: f"{name},MIT"}
    alone = licenses.find_notices(df, licenses.NOTICES[-1:]).collect()
    assert sorted((r.doc_id, r.template_id, r.window_no, r.contained) for r in alone) == [(0, 0, 5, 1.0), (1, 0, 0, 1.0), (6, 0, 3, 1.0)]


def test_repeated_rows_share_their_spans(spark):
    shared = prose(5, 200)
    texts = [f"{prose(10, 40)} {shared}"] + [f"{shared} {prose(11, 30)}"] * 300
    df = frame(spark, texts, [1] + [None] * 300)
    chunked = substring_dedup.chunks(df)
    once = substring_dedup.chunks(df.dropDuplicates(["text"])).count()
    spans = substring_dedup.spans_by_text(substring_dedup.later_occurrences(chunked)).collect()
    assert spans and max(len(r["_spans"]) for r in spans) <= once
    assert substring_dedup.cut_repeats(df).select("text").distinct().count() == 2


def test_lookups_are_not_broadcast(spark):
    """Spark takes the rows of an exploded ball for as few as the fingerprints; all of them were built in the driver."""
    nodes = near_copies.written(spark.range(3000).selectExpr("xxhash64(id) fp", "id least", "1L copies"), "nodes")
    asked = simhash.lookups(nodes)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    # the few crowded slots may be
    assert [line.split("Join ")[0].split()[-1] + ("" if "LeftAnti" in line else " whole") for line in plan.splitlines() if "Join " in line] == [
        "SortMerge whole", "BroadcastHash"]
    assert asked.count() == 0
