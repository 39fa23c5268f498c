"""Encoding, decoding and counting against the tokenizers library."""

import gc
import hashlib
import random
import weakref

import pytest
import regex
from pyspark.sql import Row

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("ahocorasick")

from readloom.llm import bpe, merges, queries, token_counts  # noqa: E402
from readloom.llm.merges import Matcher, Vocabulary  # noqa: E402

PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "\r", "'", "'s", "'re", "'r", "'ll", "'l", "'v", "'d", "'t", "1",
          "23", "!", "...", "é", "ñ", "日本", " ", "　", "\x1c", "՘", "​", "́", "<|endoftext|>",
          "<|end", "²", "😀", "٣", "ations", "aaaaaaaaaa", "    ", "\x00"]


@pytest.fixture(scope="module")
def path():
    return queries.vocabulary_path()


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


@pytest.fixture(scope="module")
def vocabulary(path):
    return Vocabulary.of_file(path)


def texts(n, seed=5):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randint(0, 16))) for _ in range(n)]


def want(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(vocabulary, library):
    encoder = bpe.Encoder(vocabulary)
    for t in texts(4000):
        assert encoder.encode(t).tolist() == want(library, t), t


def test_bounded_tables_give_the_same(vocabulary, library):
    encoder = bpe.Encoder(vocabulary, kept=3, kept_pairs=5)
    counter = token_counts.Transducer(vocabulary, max_states=7)
    for t in texts(300, 6):
        assert encoder.encode(t).tolist() == want(library, t), t
        assert counter.of_text(t) == len(want(library, t)), t


def test_long_words(vocabulary, library):
    encoder, counter = bpe.Encoder(vocabulary), token_counts.Transducer(vocabulary)
    r = random.Random(1)
    for alphabet in ("a", "ab", "etaoinshr", "=-", " ", "日本語"):
        t = "".join(r.choice(alphabet) for _ in range(3000))
        assert encoder.encode(t).tolist() == want(library, t)
        assert counter.of_text(t, 100) == len(want(library, t))


def test_every_code_point_has_the_librarys_class(vocabulary, library):
    encoder, counter = bpe.Encoder(vocabulary), token_counts.Transducer(vocabulary)
    step = 64
    for low in range(0, 0x30000, step):
        chars = [chr(c) for c in range(low, low + step) if not 0xD800 <= c < 0xE000]
        t = "".join(f"a{c}{c}a1{c}1" for c in chars)
        ids = want(library, t)
        assert encoder.encode(t).tolist() == ids, hex(low)
        assert counter.of_text(t) == len(ids), hex(low)


def test_endings_after_every_code_point(vocabulary, library):
    """After a letter or number an apostrophe opens an ending; after another character it does not. Newer letters too."""
    encoder, counter = bpe.Encoder(vocabulary), token_counts.Transducer(vocabulary)
    step = 64
    for low in range(0, 0x110000, step):
        chars = [chr(c) for c in range(low, low + step) if not 0xD800 <= c < 0xE000]
        if low > 0x33480 and not any(merges.kind(c) in "LN" or regex.match(r"[\p{L}\p{N}]", c) for c in chars) and low % 0x4000:
            continue  # planes without letters: one step in 256
        for t in ("".join(f"{c}'re" for c in chars), "".join(f" {c}'re!a{c}1" for c in chars)):
            ids = want(library, t)
            assert encoder.encode(t).tolist() == ids, hex(low)
            assert counter.of_text(t) == len(ids), hex(low)


def test_both_rules_give_the_same_words(vocabulary):
    encoder = bpe.Encoder(vocabulary)
    for t in texts(3000, 11):
        assert encoder.far.findall(t) == encoder.words(t)
        if all(ord(c) < 0x10000 for c in t):
            assert encoder.near.findall(t) == encoder.far.findall(t)


def test_codes_in_one_pass(spark, path, library):
    df = rows_of(spark).union(spark.createDataFrame([(9, "né \U00016d40's 😀 <|endoftext|><|endoftext|> x", "", 0, "")], rows_of(spark).schema))
    got = bpe.codes(df, path, list(bpe.CODES), ["doc_id", "text"]).collect()
    assert len(got) == 7
    for r in got:
        ids = want(library, r.text)
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.ids, r.n_tokens, r.decoded, r.round_trip) == (ids, len(ids), decoded, True)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    few = bpe.codes(df, path, ["n_tokens"], ["doc_id"])
    assert few.columns == ["doc_id", "n_tokens"] and few.count() == 7


def test_counts_do_not_depend_on_chunks(vocabulary, library):
    counter = token_counts.Transducer(vocabulary)
    for n, t in enumerate(texts(1500, 8)):
        assert counter.of_text(t, n % 9 + 1) == counter.of_text(t) == len(want(library, t)), t


def test_maps_compose_in_any_order(vocabulary):
    counter = token_counts.Transducer(vocabulary)
    for n, t in enumerate(texts(300, 9)):
        maps = [counter.chunk_map(t[i:i + 3]) for i in range(0, len(t), 3)]
        if len(maps) >= 3:
            a, b, c = maps[:3]
            left = counter.compose(counter.compose(a, b), c)
            right = counter.compose(a, counter.compose(b, c))
            assert counter.scan([left, *maps[3:]]) == counter.scan([right, *maps[3:]]) == counter.of_text(t)


def test_matcher_counts_every_prefix(vocabulary, library):
    matcher = Matcher(vocabulary)
    word = "unbelievablenesses"
    state, total = matcher.root, 0
    for n, letter in enumerate(word, 1):
        state, _, added = state[letter]
        total += added
        assert total == len(want(library, word[:n]))


def rows_of(spark, extra=()):
    data = [(1, "plain words"), (2, None), (3, ""), (4, "x" * 70_000 + " y"), (4, "x" * 70_000 + " y"), (5, "<|endoftext|>a")]
    return spark.createDataFrame([Row(doc_id=d, text=t, ids="clash", n_tokens=-1, decoded=None) for d, t in data],
                                 "doc_id long, text string, ids string, n_tokens int, decoded string")


def test_frames(spark, path, library):
    df = rows_of(spark)
    got = bpe.decode_ids(bpe.encode_texts(df, path), path).collect()
    assert len(got) == 6
    for r in got:
        assert r.ids == want(library, r.text) and r.decoded == (r.text or "") and r.n_tokens == -1
    counted = token_counts.count_tokens(df, path, chunk=1000).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in counted) == sorted((r.doc_id, len(r.ids)) for r in got)
    assert "text" not in counted[0]


def test_empty_frame(spark, path):
    df = rows_of(spark).limit(0)
    assert bpe.decode_ids(bpe.encode_texts(df, path), path).count() == 0
    assert token_counts.count_tokens(df, path).count() == 0


def test_invalid_utf8_decodes_to_marks(spark, path, vocabulary, library):
    ids = [[i for i, b in vocabulary.bytes_of.items() if b == b"\xe6"], [50256], []]
    got = bpe.decode_ids(spark.createDataFrame([(i,) for i in ids], "ids array<int>"), path).collect()
    assert [r.decoded for r in got] == [library.decode(i, skip_special_tokens=False) for i in ids]


def test_queries_equal_the_library(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = {d: want(library, t) for d, t in docs.items()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r.doc_id: r for r in queries.QUERIES["op2_bpe"](spark, sf).collect()}
    assert got.keys() == docs.keys()
    for d, r in got.items():
        decoded = library.decode(ids[d], skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids[d]), sha(",".join(map(str, ids[d]))), sha(decoded))
    counts = {r.doc_id: r for r in queries.QUERIES["op8_token_counts"](spark, sf).collect()}
    assert {d: (r.n_bytes, r.n_tokens, r.over_limit) for d, r in counts.items()} == {
        d: (len(t.encode()), len(ids[d]), len(ids[d]) > 1024) for d, t in docs.items()}


def test_what_is_built_goes_with_its_vocabulary(path):
    """A worker that lets the vocabulary go has its tables back at once, without the garbage collector."""
    vocabulary = Vocabulary.of_file(path)
    vocabulary.once(bpe.Codec).both("words to keep")
    vocabulary.once(token_counts.Transducer).of_text("words to keep", 64)
    gone = [weakref.ref(x) for x in (vocabulary, vocabulary.once(bpe.Encoder), vocabulary.once(bpe.Decoder))]
    gc.disable()
    try:
        del vocabulary
        assert [x() for x in gone] == [None] * 3
    finally:
        gc.enable()
    assert bpe.Codec(Vocabulary.of_file(path)).both("a word")[0]


def test_codes_without_digests(spark, path, library):
    rows = [(n, t) for n, t in enumerate([*texts(60), "", None])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in bpe.codes(df, path, ["ids", "n_tokens", "decoded", "round_trip"], ["doc_id"]).collect()}
    for n, text in rows:
        ids = want(library, text)
        assert got[n].ids == ids and got[n].n_tokens == len(ids) and got[n].decoded == (text or "") and got[n].round_trip
