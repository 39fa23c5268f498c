"""BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word the last token of its encoding is unique: it ends
the prefix and stays apart from the last token of what lies before it. One walk
over the bytes stores that token for each prefix (an automaton with suffix links
gives the tokens that end at a byte; pair-compatibility tests choose), and following the stored
tokens back from the end gives the ids. Words repeat, so their ids are kept in
a bounded table.

Rows are independent: no shuffle, a lost task is simply run again. A null text
counts as an empty one; no column but the text is looked at, so rows may
repeat and carry any further columns.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.shipping import ship
from readloom.llm import merges
from readloom.llm.merges import Vocabulary, byte_letters, kind

KEPT_WORDS = 250_000
KEPT_PAIRS = 500_000
LONGEST_KEPT = 64
ROWS_AT_ONCE = 64


class Encoder(dict):
    """Word -> ids as int32 bytes; a dict that fills itself.

    Words not met lately go: at ``kept`` words the table becomes the older
    half, from which words come back when met again. Pair tests are bounded in
    the same way by ``kept_pairs``.
    """

    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT_WORDS, kept_pairs: int = KEPT_PAIRS):
        self.v, self.kept, self.kept_pairs = vocabulary, kept, kept_pairs
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.spelled = {i: t for t, i in vocabulary.ids.items()}
        self.automaton = ahocorasick.Automaton()
        for t, i in vocabulary.ids.items():
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.size = {i: len(t) for t, i in vocabulary.ids.items()}
        self.split = regex.compile("|".join(regex.escape(s) for s in vocabulary.specials)) if vocabulary.specials else None
        self.near, self.far = word_rules()

    def __missing__(self, word: str) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = array("i", self.of_word(word)).tobytes()
        if len(word) <= LONGEST_KEPT:
            if len(self) >= self.kept:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found

    def of_word(self, word: str) -> list[int]:
        """Store the last token of every prefix, then follow them back.

        The automaton gives the tokens that end at each byte; of these, one is
        compatible with the last token of the prefix before it.
        """
        spelling = byte_letters(word)
        if spelling in self.v.ids:
            return [self.v.ids[spelling]]
        lasts = [-1] * (len(spelling) + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(spelling):
            if lasts[end + 1] < 0:
                before = lasts[end + 1 - size]
                if before < 0:
                    lasts[end + 1] = token
                    continue
                key = before << 24 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = self._test(key, before, token)
                if fits:
                    lasts[end + 1] = token
        at, back, sizes = len(spelling), [], self.size
        while at:
            token = lasts[at]
            back.append(token)
            at -= sizes[token]
        return back[::-1]

    def _test(self, key: int, left: int, right: int) -> bool:
        if len(self.pairs) >= self.kept_pairs:
            self.pairs.clear()
        found = self.pairs[key] = self.v.compatible(self.spelled[left], self.spelled[right])
        return found

    def words(self, text: str) -> list[str]:
        """The words of a text without special strings."""
        # two bytes a character: none lies beyond the first 65536 code points
        rule = self.near if text.isascii() or len(text.encode("utf-16-le")) == 2 * len(text) else self.far
        return rule.findall(text)

    def parts(self, text: str):
        """``(text, id)``: stretches of a text up to a special string, and its id; none after the last."""
        at = 0
        if self.split is not None:
            for m in self.split.finditer(text):
                yield text[at:m.start()], self.v.specials[m.group()]
                at = m.end()
        yield text[at:], None

    def encode(self, text: str) -> np.ndarray:
        found = []
        for part, special in self.parts(text):
            found += map(self.__getitem__, self.words(part))
            if special is not None:
                found.append(array("i", [special]).tobytes())
        return np.frombuffer(b"".join(found), "i4")

    def decode(self, ids) -> str:
        return b"".join(map(self.v.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class Decoder(dict):
    """Ids of a word (as int32 bytes) -> their number, decimals joined by commas, and the bytes they stand for; fills itself, bounded."""

    def __init__(self, vocabulary: Vocabulary, kept: int = KEPT_WORDS):
        self.bytes_of, self.kept = vocabulary.bytes_of, kept

    def __missing__(self, packed: bytes) -> tuple[int, bytes, bytes]:
        ids = array("i", packed).tolist()
        found = len(ids), ",".join(map(str, ids)).encode(), b"".join(map(self.bytes_of.__getitem__, ids))
        if len(packed) <= 4 * LONGEST_KEPT:
            if len(self) >= self.kept:
                self.clear()
            self[packed] = found
        return found


class Codec:
    """Encodes texts and decodes their ids again, word by word: both are joins of what their words give."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.encoder, self.decoder = vocabulary, vocabulary.once(Encoder), vocabulary.once(Decoder)

    def both(self, text: str) -> tuple[list[bytes], list[tuple[int, bytes, bytes]]]:
        """The ids of each word, and what ``Decoder`` says of them."""
        e, packed = self.encoder, []
        for part, special in e.parts(text):
            packed += map(e.__getitem__, e.words(part))
            if special is not None:
                packed.append(array("i", [special]).tobytes())
        return packed, list(map(self.decoder.__getitem__, packed))


def word_rules() -> tuple:
    """The word rule of byte-level vocabularies, for texts of the first 65536 code points and for any text.

    Classes are those of ``kind``. In the first rule they are spelt out, as the standard
    library looks such a class up in a table; the second takes the regex library's, but for
    letters and numbers that only it knows, which count as others.
    """
    space, letter, number = ("".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in _runs(range(0x10000), lambda c, k=k: kind(chr(c)) == k)) for k in "SLN")
    near = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")
    known = regex.compile(r"[\p{L}\p{N}]")
    new = _runs(range(128, 0x110000), lambda c: known.match(chr(c)) and kind(chr(c)) == "O")
    new = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in new) or "\\U0010ffff"
    return near, regex.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?(?:(?![{new}])\p{{L}})+| ?(?:(?![{new}])\p{{N}})+| ?(?:[{new}]|[^\s\p{{L}}\p{{N}}])+|\s+(?!\S)|\s+")


def _runs(numbers, fits) -> list[tuple[int, int]]:
    """Runs of numbers that fit; surrogates do not count."""
    found: list[tuple[int, int]] = []
    for c in numbers:
        if not 0xD800 <= c < 0xE000 and fits(c):
            found[-1:] = [(found[-1][0], c)] if found and found[-1][1] == c - 1 else [*found[-1:], (c, c)]
    return found


def _slices(batch: pa.RecordBatch):
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(at, ROWS_AT_ONCE)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    values = np.concatenate([np.empty(0, np.int32), *arrays]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))


def encode_texts(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns and ``ids`` (array<int>): the tokens of the text, no tokens added.

    ``vocabulary_path`` is read on the driver. A column already named like
    ``ids`` is replaced. The text's own column may have any name.
    """
    table = df.sparkSession.sparkContext.broadcast(Vocabulary.of_file(vocabulary_path))
    kept = [f for f in df.schema.fields if f.name != ids]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])
    names = [f.name for f in kept]

    def encode(batches):
        encoder = table.value.once(Encoder)
        for batch in batches:
            for part in _slices(batch):
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                found = _lists([encoder.encode(t or "") for t in texts])
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, found], [*names, ids])

    return df.mapInArrow(encode, schema)


def decode_ids(df: DataFrame, vocabulary_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns and ``text``: the text the ids stand for (null ids: null; broken UTF-8: replacement marks)."""
    table = df.sparkSession.sparkContext.broadcast(Vocabulary.of_file(vocabulary_path))
    kept = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField(text, T.StringType(), True)])
    names = [f.name for f in kept]

    def decode(batches):
        known = table.value.bytes_of.__getitem__
        for batch in batches:
            for part in _slices(batch):
                lists = part.column(part.schema.get_field_index(ids))
                texts = [None if not x.is_valid else b"".join(map(known, x.values.to_pylist())).decode("utf-8", "replace")
                         for x in lists]
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*names, text])

    return df.mapInArrow(decode, schema)


#: What ``codes`` can give, and the types.
CODES = {"ids": T.ArrayType(T.IntegerType(), False), "n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded": T.StringType(),
         "decoded_sha256": T.StringType(), "round_trip": T.BooleanType()}


def codes(df: DataFrame, vocabulary_path: str, wanted: list[str], keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and those ``wanted`` of ``CODES``: a text is encoded and its ids are decoded in one pass.

    ``ids_sha256`` is that of the ids in decimal, joined by commas; ``round_trip`` says whether the ids decode to the
    text. Only what is wanted leaves the Python worker, one worker per task.
    """
    table = df.sparkSession.sparkContext.broadcast(Vocabulary.of_file(vocabulary_path))
    fields = [f for f in df.select(*keep).schema.fields]
    schema = T.StructType([*fields, *(T.StructField(c, CODES[c], False) for c in wanted)])
    spelt = bool({"decoded", "decoded_sha256", "round_trip"} & set(wanted))
    # the decoder's table of words pays where ids are spelt out in decimal; their bytes alone are looked up id by id
    worded = "ids_sha256" in wanted

    def run(batches):
        codec = table.value.once(Codec if worded else Encoder)
        for batch in batches:
            for part in _slices(batch):
                out = {c: [] for c in wanted}
                for value in part.column(part.num_columns - 1):
                    plain = value.as_py() or ""
                    if worded:
                        packed, said = codec.both(plain)
                        ids = np.frombuffer(b"".join(packed), "i4")
                        decoded = b"".join([x[2] for x in said]).decode("utf-8", "replace") if spelt else ""
                    else:
                        ids = codec.encode(plain)
                        decoded = codec.decode(ids.tolist()) if spelt else ""
                    for c in wanted:
                        if c == "ids":
                            out[c].append(ids)
                        elif c == "n_tokens":
                            out[c].append(len(ids))
                        elif c == "ids_sha256":
                            out[c].append(hashlib.sha256(b",".join([x[1] for x in said])).hexdigest())
                        elif c == "decoded":
                            out[c].append(decoded)
                        elif c == "decoded_sha256":
                            out[c].append(hashlib.sha256(decoded.encode()).hexdigest())
                        else:
                            out[c].append(decoded == plain)
                arrays = [_lists(v) if c == "ids" else pa.array(v, {"n_tokens": pa.int64(), "round_trip": pa.bool_()}.get(c, pa.string())) for c, v in out.items()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], [*keep, *wanted])
        pa.default_memory_pool().release_unused()  # else the worker keeps them while it waits, or runs other tasks

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def digests(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``doc_id``, the number of tokens and the SHA-256 of the ids (decimal, joined by commas) and of the decoded text."""
    return encoded.select(
        "doc_id", F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"))


ship(__name__)
ship(merges.__name__)
