"""Passages that occur in the corpus before are cut out, by content-defined chunks.

A text's words (between ASCII blanks) are cut where a gear rolling hash of the
last ``GEAR`` bytes, taken at word ends, is the least within ``REACH`` words on
either side (where words go on repeating, at each equal place). Cuts depend on what lies near them only, so an insertion moves the
cuts around it and no others. A chunk goes from a cut to the first cut at least
``WORDS`` words on; chunks start at every cut. Gaps between cuts have no bound,
so a passage of a given length holds a whole chunk in most places, not in all,
and words of it beyond its first and last shared chunk stay. Chunks are
told apart by a 128-bit digest of their words. The first occurrence of a digest
(by id, then place) stays; words under later occurrences are cut out, what lies
between stays letter for letter.

Chunk rows are narrow and stored once. Digests are first counted by half of
their bits, which adds up map-side, so a passage that thousands of documents
share is one row by the time it is shuffled; only rows whose half occurs twice
go on. The join that tells the later occurrences can be split where a digest is
frequent: its other side has one row for each digest and is stored before, so
that both sides are dealt out for the join alone. A document's spans
are no more than its chunks.

Null texts stay null. Texts of fewer than ``WORDS`` words have no chunk and stay.
Rows with the same id and text count as one text and are treated alike.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.shipping import ship
from readloom.session import written

WORDS = 20
REACH = 4
GEAR = 16
SEED = 20

CHUNK_SCHEMA = "doc_id long, text_hash long, start int, stop int, d1 long, d2 long"


def gear_table() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 64, 256, dtype=np.uint64)


def gear(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte: each byte's number shifted by its distance, over the last ``GEAR`` bytes, by doubling."""
    h = table[data]
    step = 1
    while step < GEAR:
        older = h[:-step] << np.uint64(step)
        h = h.copy()
        h[step:] += older
        step *= 2
    h ^= h >> np.uint64(29)
    return h * np.uint64(0x9E3779B97F4A7C15)


def cuts(words: list[bytes], joined: bytes, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Numbers of the words that begin a chunk, and the number of words."""
    n = len(words)
    value = gear(np.frombuffer(joined, np.uint8), table)[ends - 1]
    padded = np.full(n + 2 * REACH, np.iinfo(np.uint64).max)
    padded[REACH:REACH + n] = value
    least = np.ones(n, bool)
    for d in range(1, REACH + 1):
        least &= value <= padded[REACH - d:REACH - d + n]
        least &= value <= padded[REACH + d:REACH + d + n]
    inner = np.flatnonzero(least) + 1
    return np.concatenate([[0], inner[(inner > 0) & (inner < n)], [n]])


def chunks_of(text: str, table: np.ndarray, least: int = WORDS) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """``(start, stop, digest)`` of the text's chunks, in words."""
    words = text.encode().split()
    none = np.empty(0, np.int64)
    if len(words) < least:
        return none, none, []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    at = cuts(words, joined, starts, ends, table)
    stop = np.searchsorted(at, at[:-1] + least)
    whole = stop < len(at)
    start, stop = at[:-1][whole], at[stop[whole]]
    digest = [hashlib.blake2b(joined[a:b], digest_size=16).digest()
              for a, b in zip(starts[start].tolist(), ends[stop - 1].tolist())]
    return start, stop, digest


def chunks(df: DataFrame, row_id: str = "doc_id", text: str = "text", least: int = WORDS) -> DataFrame:
    """``doc_id, text_hash, start, stop, d1, d2``: the chunks of every text."""
    rows = df.select(F.col(row_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def cut(batches):
        table = gear_table()
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                found = [chunks_of(t or "", table, least) for t in part.column(2).to_pylist()]
                owner = np.repeat(np.arange(len(found)), [len(f[2]) for f in found])
                halves = np.frombuffer(b"".join(d for f in found for d in f[2]), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)),
                     pa.array(np.concatenate([f[0] for f in found]), pa.int32()),
                     pa.array(np.concatenate([f[1] for f in found]), pa.int32()),
                     pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                    ["doc_id", "text_hash", "start", "stop", "d1", "d2"])

    return rows.mapInArrow(cut, CHUNK_SCHEMA)


def later_occurrences(chunked: DataFrame) -> DataFrame:
    """``doc_id, text_hash, start, stop, first_doc`` of chunks whose digest occurs before, by id and place."""
    twice = chunked.groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1")
    twice = written(twice, "twice")
    again = written(chunked.join(twice, "d1", "left_semi"), "repeats")
    place = F.struct("doc_id", "text_hash", "start")
    first = (again.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
             .where("n > 1").select("d1", "d2", "first"))
    first = written(first, "firsts")
    return (again.join(first, ["d1", "d2"]).where(~place.eqNullSafe(F.col("first")))
            .where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
                     & (F.col("start") == F.col("first.start"))))
            .select("doc_id", "text_hash", "start", "stop", F.col("first.doc_id").alias("first_doc")))


def spans_by_text(later: DataFrame) -> DataFrame:
    """``doc_id, text_hash, _spans, first_docs``: each span once, however many rows have that id and text."""
    return later.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("start", "stop")).alias("_spans"), F.array_sort(F.collect_set("first_doc")).alias("first_docs"))


def without(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the words in the spans, its number of words, and how many went."""
    raw = text.encode()
    at = [m.start() for m in re.finditer(rb"[^ \t-\r]+", raw)]
    gone = np.zeros(len(at) + 1, np.int64)
    for a, b in spans:
        gone[a] += 1
        gone[b] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    keep, last = [], 0
    for a, b in edges.reshape(-1, 2).tolist():
        keep.append(raw[last:at[a]])
        last = at[b] if b < len(at) else len(raw)
    keep.append(raw[last:])
    return b"".join(keep).decode("utf-8", "replace"), len(at), int(gone.sum())


def cut_repeats(df: DataFrame, row_id: str = "doc_id", text: str = "text", least: int = WORDS) -> DataFrame:
    """All columns, the text without repeated passages, and ``n_removed_words`` and ``first_docs``.

    ``first_docs``: ids of the documents that hold the passages first. Columns
    already named like these two are replaced.
    """
    chunked = written(chunks(df, row_id, text, least), "chunks")
    spans = written(spans_by_text(later_occurrences(chunked)), "spans").withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    base = df.drop("n_removed_words", "first_docs")
    marked = base.join(spans, F.col(row_id).eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_hash")), "left")
    schema = T.StructType([*base.schema.fields, T.StructField("n_removed_words", T.LongType()),
                           T.StructField("first_docs", T.ArrayType(T.LongType()))])
    names = base.columns

    def cut(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                texts = part.column(part.schema.get_field_index(text)).to_pylist()
                removed = []
                for n, spans_here in enumerate(part.column(part.schema.get_field_index("_spans")).to_pylist()):
                    gone = 0
                    if spans_here:
                        texts[n], _, gone = without(texts[n], [(s["start"], s["stop"]) for s in spans_here])
                    removed.append(gone)
                columns = [pa.array(texts, pa.string()) if c == text else part.column(part.schema.get_field_index(c)) for c in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(removed, pa.int64()), part.column(part.schema.get_field_index("first_docs"))],
                    [*names, "n_removed_words", "first_docs"])

    return marked.select(*names, "_spans", F.coalesce("first_docs", F.array().cast("array<bigint>")).alias("first_docs")
                         ).mapInArrow(cut, schema)


ship(__name__)
