"""Benchmark questions in documents, also with other numbers, names and units.

Canonical form: words are folded (lower case, marks passed over), and
numbers, names (a capital, then small letters) and units become typed
placeholders. A capitalised word may as well be the plain word, so each window has
a form for every choice of its capitalised words as names or as plain words: the
same word fits in any case, another one where both are capitalised. Windows of
``WINDOW`` canonical words of the benchmark and of the documents are joined by
the hashes of their forms. Where a document's window meets an item's, the
two words under each placeholder are a pair of slot values; along one alignment
of document and item, each item value must go with one document value (a share
of ``STRAY`` exceptions is allowed). A document holds an item when the aligned,
consistent windows are ``LEAST`` of the item's windows or more.

Before the join, documents' windows are looked up in a bitmap of the benchmark's
hashes. Its size is fixed (2 MB); a larger benchmark only lets more windows
through to the join. So documents send what resembles the benchmark, and no
text. A frequent passage meets one row for each item window, and its hits are
grouped by document, never by window.

Windows of placeholders with fewer than two plain words count only for items
that have no others; items shorter than a window are one window. Null and empty
texts hold nothing; items without words are passed over; rows with the same id
and text count as one text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.shipping import ship
from readloom.session import written

WINDOW = 5
LEAST = 0.8
STRAY = 0.25
BITS = 24
SEED = 3

# Units of measure, money and time.
UNITS = ("mm cm m km inch inches foot feet yard yards mile miles g kg mg ton tons pound pounds ounce ounces l ml liter liters "
         "litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
         "dollar dollars cent cents euro euros percent degree degrees mph kmh watt watts volt volts").split()

HIT_SCHEMA = "doc_id long, text_hash long, at int, words int, h long, slots array<long>, plain int"


class Tables:
    """Numbers for bytes, places and window positions; the hashes of units."""

    def __init__(self):
        r = np.random.default_rng(SEED)
        self.byte = r.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
        self.place = r.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
        self.window = r.integers(0, 1 << 64, WINDOW, dtype=np.uint64) | np.uint64(1)
        self.types = r.integers(0, 1 << 64, 4, dtype=np.uint64)  # plain, number, name, unit
        fold = np.arange(256, dtype=np.uint8)
        fold[ord("A"):ord("Z") + 1] += 32
        self.fold = fold
        # capitals beyond A-Z whose small letter takes as many bytes
        self.small = {c: ord(low) for c in range(0x80, 0x20000) if len(low := chr(c).lower()) == 1 and ord(low) != c
                      and not 0xD800 <= c < 0xE000 and len(low.encode()) == len(chr(c).encode())}
        self.small[ord("ς")] = ord("σ")
        kept = np.zeros(256, bool)
        kept[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = True
        self.kept = kept
        self.blank = np.zeros(256, bool)
        self.blank[[0x20, *range(0x09, 0x0E)]] = True
        self.units = np.sort(self.words(" ".join(UNITS).encode())[0])

    def words(self, raw: bytes):
        """Hash, type, type apart from capitals and first byte of each word that has a letter or digit."""
        data = np.frombuffer(raw, np.uint8)
        low = data if raw.isascii() else np.frombuffer(raw.decode().translate(self.small).encode(), np.uint8)
        at = np.flatnonzero(self.kept[data])
        if not len(at):
            return np.empty(0, np.uint64), np.empty(0, np.int8), np.empty(0, np.int8), np.empty(0, np.int64)
        group = np.cumsum(self.blank[data])[at]  # changes at blanks
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([first, [len(at)]]))
        b = data[at]
        place = np.arange(len(at)) - np.repeat(first, size)
        h = np.add.reduceat(self.byte[self.fold[low[at]]] * self.place[place & 63], first)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        digit = np.add.reduceat(((b >= 48) & (b <= 57)).astype(np.int32), first)
        upper = (b >= 65) & (b <= 90)
        uppers = np.add.reduceat(upper.astype(np.int32), first)
        folded = np.zeros(len(first), np.int8)
        if hasattr(self, "units"):
            near = np.minimum(np.searchsorted(self.units, h), len(self.units) - 1)
            folded[self.units[near] == h] = 3
        folded[digit > 0] = 1
        kind = np.where(upper[first] & (uppers == 1) & (size > 1) & (digit == 0), np.int8(2), folded)
        return h, kind, folded, at[first]

    def windows(self, raws: list[bytes], size: int = WINDOW):
        """Hashes of all forms of several texts' windows: owner, first word, hash, slots (0 for plain words), number of plain words."""
        joined = b"\n".join(raws)
        h, kind, folded, at = self.words(joined)
        ends = np.cumsum([len(r) + 1 for r in raws])
        owner = np.searchsorted(ends, at, side="right")
        begin = np.searchsorted(owner, np.arange(len(raws)))
        n = max(0, len(h) - size + 1)
        whole = owner[:n] == owner[size - 1:size - 1 + n]
        canonical = np.where(folded == 0, h, self.types[folded])
        base = np.zeros(n, np.uint64)
        plain = np.zeros(n, np.int64)
        names = np.zeros(n, np.int64)
        for k in range(size):
            base += canonical[k:k + n] * self.window[k]
            plain += kind[k:k + n] == 0
            names |= (kind[k:k + n] == 2).astype(np.int64) << k
        rows, totals = [], []
        for form in range(1 << size):  # bits of the words that stand as names
            chosen = np.flatnonzero(whole & (names & form == form))
            total = base[chosen]
            for k in range(size):
                if form >> k & 1:
                    total += (self.types[2] - canonical[chosen + k]) * self.window[k]
            rows.append(chosen)
            totals.append(total)
        row, total = np.concatenate(rows), np.concatenate(totals)
        total ^= total >> np.uint64(30)
        total *= np.uint64(0x94D049BB133111EB)
        total ^= total >> np.uint64(27)
        total += np.uint64(size)
        counts = np.bincount(owner, minlength=len(raws))
        slots = np.where(kind == 0, np.uint64(0), h | np.uint64(1))
        return owner[row], row - begin[owner[row]], total, plain[row], row, slots, counts


def _rows(tables: Tables, part: pa.RecordBatch, sizes: list[int], bitmap) -> pa.RecordBatch:
    raws = [(t or "").encode() for t in part.column(2).to_pylist()]
    columns: list[list] = [[] for _ in range(6)]
    for size in sizes:
        owner, at, h, plain, row, slots, counts = tables.windows(raws, size)
        if bitmap is not None:
            bit = h >> np.uint64(64 - BITS)
            found = (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
            owner, at, h, plain, row = owner[found], at[found], h[found], plain[found], row[found]
        values = slots[row[:, None] + np.arange(size)].view(np.int64) if len(row) else np.empty((0, size), np.int64)
        for c, v in zip(columns, (owner, at, counts[owner], h.view(np.int64), list(values), plain)):
            c.append(v)
    owner = np.concatenate(columns[0])
    slots = [v for c in columns[4] for v in c]
    return pa.RecordBatch.from_arrays(
        [part.column(0).take(pa.array(owner)), part.column(1).take(pa.array(owner)),
         pa.array(np.concatenate(columns[1]), pa.int32()), pa.array(np.concatenate(columns[2]), pa.int32()),
         pa.array(np.concatenate(columns[3])), pa.array(slots, pa.list_(pa.int64())),
         pa.array(np.concatenate(columns[5]), pa.int32())],
        ["doc_id", "text_hash", "at", "words", "h", "slots", "plain"])


def windows(df: DataFrame, row_id: str, text: str, sizes: list[int], bitmap=None) -> DataFrame:
    """``doc_id, text_hash, at, words, h, slots, plain``: canonical windows of every text (all, or those in the bitmap)."""
    rows = df.select(F.col(row_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def cut(batches):
        tables = Tables()
        bits = None if bitmap is None else bitmap.value
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                yield _rows(tables, batch.slice(low, 128), sizes, bits)

    return rows.mapInArrow(cut, HIT_SCHEMA)


def item_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, at, h, slots, size, total``: forms of the windows that count for each item, and how many windows these are."""
    cut = windows(items, item_id, text, list(range(1, WINDOW + 1))).withColumn("size", F.size("slots"))
    cut = cut.where((F.col("size") == WINDOW) | (F.col("size") == F.col("words")))  # a short item is one window
    rich = cut.groupBy("doc_id", "text_hash").agg(F.count(F.when(F.col("plain") >= 2, 1)).alias("rich"))
    chosen = cut.join(rich, ["doc_id", "text_hash"]).where((F.col("plain") >= 2) | (F.col("rich") == 0))
    total = chosen.groupBy("doc_id", "text_hash").agg(F.count_distinct("at").alias("total"))
    return chosen.join(total, ["doc_id", "text_hash"]).select(
        F.col("doc_id").alias("item_id"), F.col("text_hash").alias("item_hash"), F.col("at").alias("item_at"),
        "h", F.col("slots").alias("item_slots"), "size", "total")


def _bitmap(hashes: DataFrame):
    """The bits of all hashes, as numpy bytes of fixed size: 512 pieces of 4 KB at most come to the driver."""
    bit = F.shiftrightunsigned("h", 64 - BITS)
    pieces = hashes.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits")).collect()
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in pieces:
        piece = np.frombuffer(bytes(r.bits), np.uint8)
        low = (r.piece - 1) * len(piece)
        out[low:low + len(piece)] = piece
    return hashes.sparkSession.sparkContext.broadcast(out)


def find_items(docs: DataFrame, items: DataFrame, row_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
               item_text: str = "text", least: float = LEAST) -> DataFrame:
    """``doc_id, text_hash, item_id, share`` of the items a document holds."""
    known = written(item_windows(items, item_id, item_text), "items")
    sizes = sorted({WINDOW, *(r.size for r in known.select("size").distinct().collect())})  # five values at most
    hits = windows(docs, row_id, text, sizes, _bitmap(known))
    met = hits.select("doc_id", "text_hash", "at", "h", "slots").join(known, "h").where(F.size("slots") == F.col("size"))
    pairs = F.filter(F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")), lambda p: p["i"] != 0)
    aligned = met.groupBy("doc_id", "text_hash", "item_id", "item_hash", (F.col("at") - F.col("item_at")).alias("shift")).agg(
        F.max("total").alias("total"), F.collect_set("item_at").alias("places"),
        F.array_distinct(F.flatten(F.collect_list(pairs))).alias("pairs"))
    values = F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"])))
    consistent = aligned.where(F.size("pairs") <= values * (1 + STRAY))
    share = F.size(F.array_distinct(F.flatten(F.collect_list("places")))) / F.max("total")
    return (consistent.groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(share.alias("share"))
            .where(F.col("share") >= least).drop("item_hash"))


def judge(docs: DataFrame, items: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, contaminated, item_ids`` (in order), ``share`` (of the fullest item) for every document."""
    found = find_items(docs, items, row_id, text).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("item_ids"), F.max("share").alias("share"))
    found = found.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    rows = docs.select(F.col(row_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash")), "left")
            .select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                    F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"),
                    F.coalesce("share", F.lit(0.0)).alias("share")))


def drop_contaminated(docs: DataFrame, items: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that hold no item, with all their columns."""
    found = written(find_items(docs, items, row_id, text).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "contaminated")
    return docs.join(found, F.col(row_id).eqNullSafe(F.col("_doc")) & (F.xxhash64(text) == F.col("_hash")), "left_anti")


ship(__name__)
