"""Toxic documents by a support vector machine on a subsequence string kernel.

The kernel of two strings is the weighted number of three-letter subsequences
they share; one that spans ``k`` letters weighs ``DECAY ** k``, spans end at
``SPAN``. So a word with letters put in or left out still shares most with the
plain one. Letters are folded (case, common digits for letters; marks inside a
word are passed over, single letters in a row are read as one word), and the
kernel is divided by what the lengths alone make likely.

Landmarks are strings from labelled sentences. By Nyström, a string's features
are its kernel values with the landmarks times the inverse root of the
landmarks' own kernel; a linear machine with squared hinge loss is trained on
them. Its decision is linear in the subsequences, so it folds into one table of
weights, and a string is scored by looking its subsequences up, whatever the
number of landmarks. There are two such machines. By the first, a sentence is as
toxic as its worst word, a document as its worst sentence; a logistic curve turns
that margin into a score. The second knows rarer words, some of which clean texts
hold now and then by chance: its curve takes its highest margin and the share of
words above its bound. The higher of the two scores stands.

Labels are those of documents. Letter quadruples that occur in a part of the toxic
training documents and almost no other point to the words of the first machine;
words of clean documents, first at random and then those that score highest, are
the other class. Words of the second are found by stretches of four to nine letters
(with a mark where a word begins) in more toxic documents than chance would give.

Training sees at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled documents, those
with the least hash of the id; all else is measured on all rows. Scoring needs
no shuffle. Null and empty texts score as the curve does without any word.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from readloom.functions.shipping import ship
from readloom.session import written

MAX_TOXIC = 1500
MAX_CLEAN = 10_000
MAX_WORDS = 3000
LANDMARKS = 240
COST = 30.0
DECAY = 0.7
SPAN = 6
THRESHOLD = 0.7
KINDS = 64
LONGEST = 24
BLOCK = 1 << 20
#: Stretches that a task counts before it hands their counts on.
KEPT_STRETCHES = 150_000
#: The margin of a text without any word.
NO_WORD = -4.0

# Digits and signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
BLANK_KIND, NO_KIND = 255, 0


def letter_kinds() -> np.ndarray:
    """Byte -> kind: 1-26 letters, 27-58 last bytes of other letters, 0 passed over, 255 blank."""
    kinds = np.zeros(256, np.uint8)
    for b in range(128):
        c = LOOKALIKES.get(chr(b), chr(b)).lower()
        if "a" <= c <= "z":
            kinds[b] = ord(c) - ord("a") + 1
    for b in (0x21, 0x24, 0x40):  # at a word's end these are marks more often than letters
        kinds[b] = 0
    for b in range(0x80, 0xC0):
        kinds[b] = 27 + b % 32
    for b in (0x20, *range(0x09, 0x0E)):
        kinds[b] = BLANK_KIND
    return kinds


def offsets() -> list[tuple[int, int, float]]:
    return [(d, e, DECAY ** (d + e + 1)) for d in range(1, SPAN - 1) for e in range(1, SPAN - d)]


def lengths() -> np.ndarray:
    """What a string is divided by: the norm of a string of that length without repeated subsequences."""
    n = np.arange(LONGEST + 1)
    square = sum(np.maximum(n - d - e, 0) * w * w for d, e, w in offsets())
    return np.sqrt(np.maximum(square, DECAY ** 6))


def subsequences(kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the string's subsequences and their weights, divided by the length's norm."""
    numbers, weights = [np.empty(0, np.int64)], [np.empty(0)]
    k = kinds[:LONGEST].astype(np.int64)
    for d, e, w in offsets():
        n = len(k) - d - e
        if n > 0:
            numbers.append((k[:n] * KINDS + k[d:d + n]) * KINDS + k[d + e:d + e + n])
            weights.append(np.full(n, w))
    return np.concatenate(numbers), np.concatenate(weights) / lengths()[min(len(k), LONGEST)]


def kinds_of(word: str) -> np.ndarray:
    kinds = letter_kinds()[np.frombuffer(word.encode(), np.uint8)]
    return kinds[(kinds != NO_KIND) & (kinds != BLANK_KIND)]


@dataclass
class Model:
    """``weights`` by subsequence number, ``bias``, and the curve ``1 / (1 + exp(-(slope * margin + shift)))``.

    ``common`` and ``common_bias`` are those of the second machine, if there is one; ``curve`` weighs its highest margin
    and the logarithm of the share of words above 0, and ends with the shift.
    """

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    common: np.ndarray | None = None
    common_bias: float = 0.0
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)


def _pieces(data: np.ndarray):
    """Stretches of about ``BLOCK`` bytes that end at blanks."""
    at = 0
    while at < len(data):
        end = min(len(data), at + BLOCK)
        while end < len(data):
            blank = np.flatnonzero(np.isin(data[end:end + 4096], BLANKS))
            if len(blank):
                end += int(blank[0])
                break
            end = min(len(data), end + 4096)
        yield at, end
        at = end


BLANKS = np.array([0x20, *range(0x09, 0x0E)], np.uint8)


def word_margins(data: np.ndarray, model: Model, tables: tuple) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """``(start, end, margins)`` of the words in bytes of text, margins by each machine; words without letters are left out.

    Neighbouring words of one letter count as one word. Of words longer than
    ``LONGEST`` letters every stretch of that length is part of the sum, which
    is then divided by that length's norm.
    """
    kinds_table, norm = tables
    kinds = kinds_table[data]
    blank = kinds == BLANK_KIND
    # blanks between single-letter words do not part them
    at = np.flatnonzero(kinds != NO_KIND)
    is_blank = blank[at]
    word_at = np.cumsum(np.concatenate([[True], is_blank[1:] != is_blank[:-1]])) if len(at) else np.empty(0, np.int64)
    sizes = np.bincount(word_at)[word_at] if len(at) else np.empty(0, np.int64)
    if len(at):
        first = np.flatnonzero(np.concatenate([[True], word_at[1:] != word_at[:-1]]))
        run_blank, run_size = is_blank[first], sizes[first]
        left = np.concatenate([[0], np.where(run_blank[:-1], 0, run_size[:-1])])
        right = np.concatenate([np.where(run_blank[1:], 0, run_size[1:]), [0]])
        soft = run_blank & (left == 1) & (right == 1)
        hard = np.repeat(run_blank & ~soft, run_size)
    else:
        hard = np.empty(0, bool)
    letter = ~is_blank
    word = np.cumsum(hard)[letter]  # a number that changes at hard blanks
    place = at[letter]
    k = kinds[place].astype(np.int32)
    machines = [(model.weights, model.bias)] + ([] if model.common is None else [(model.common, model.common_bias)])
    if not len(k):
        return np.empty(0, np.int64), np.empty(0, np.int64), [np.empty(0, np.float32) for _ in machines]
    word = word.astype(np.int32)
    totals = [np.zeros(len(k), np.float32) for _ in machines]
    for d, e, w in offsets():
        n = len(k) - d - e
        if n <= 0:
            continue
        number = (k[:n] * KINDS + k[d:d + n]) * KINDS + k[d + e:d + e + n]
        weight = (word[:n] == word[d + e:d + e + n]) * np.float32(w)
        for total, (weights, _) in zip(totals, machines):
            part = weights[number]
            part *= weight
            total[:n] += part
    starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    size = np.diff(np.concatenate([starts, [len(k)]]))
    by = norm[np.minimum(size, LONGEST)]
    margin = [np.add.reduceat(total, starts) / by + np.float32(bias) for total, (_, bias) in zip(totals, machines)]
    begin = place[starts]
    begin = begin - ((begin > 0) & (data[np.maximum(begin - 1, 0)] >= 0xC0))  # the first byte of a letter of several
    return begin, place[starts + size - 1] + 1, margin


def worst_words(texts: pa.Array, model: Model, tables: tuple, most: int = 1) -> list[dict]:
    """For each text: ``worst``, the ``most`` highest margins and their words, and ``words``, how many it has.

    By the second machine: ``over``, the words above 0, and ``common``, the highest margin and its word.
    """
    out = []
    for value in texts:
        data = np.frombuffer((value.as_py() or "").encode(), np.uint8)
        best, words, over, common = [], 0, 0, None

        def named(margin, i):
            return {"margin": float(margin[i]), "word": bytes(data[a + start[i]:a + end[i]]).decode("utf-8", "replace")}

        for a, b in _pieces(data):
            start, end, found = word_margins(data[a:b], model, tables)
            best += [named(found[0], i) for i in np.argsort(-found[0], kind="stable")[:most]]
            words += len(start)
            if len(found) > 1 and len(start):
                over += int((found[1] > 0).sum())
                top = named(found[1], int(np.argmax(found[1])))
                common = top if common is None or top["margin"] > common["margin"] else common
        best.sort(key=lambda x: -x["margin"])
        out.append({"worst": best[:most], "words": words, "over": over, "common": common})
    return out


def training_rows(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id, text, toxic`` of the labelled training documents, bounded for each class by the least hash of the id.

    A document is held out when the CRC-32 of its id as text leaves the
    remainder ``held_out``. Labels that are null or contradict another row of the
    same id are passed over.
    """
    usable = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
              .groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
              .where((F.col("toxic") == F.col("other")) & ~is_held_out("doc_id", folds, held_out)))
    chosen = None
    for cls, most in ((1, MAX_TOXIC), (0, MAX_CLEAN)):
        part = usable.where(F.col("toxic") == cls).select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most MAX_TOXIC + MAX_CLEAN rows of two numbers
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["text", "toxic"])


def is_held_out(row_id: str = "doc_id", folds: int = 3, held_out: int = 1):
    return F.crc32(F.col(row_id).cast("string").cast("binary")) % folds == held_out


def telling_stretches(train: DataFrame, sizes: tuple[int, ...] = (4,), mark: str = "", part: float | None = 0.02,
                      share: float = 0.95, most: int = 2000) -> list[str]:
    """Stretches of words (after ``mark``) that occur in a ``part`` of the toxic documents and, ``share`` of the time, in such only.

    At least in so many that chance would give less than one such stretch among
    a million (if stretches fell on documents of either class alike), or, with a
    ``part``, in a quarter of them. Without a ``part`` that chance alone decides.
    """

    def counted_batch(counts: dict[str, int], toxic: int) -> pa.RecordBatch:
        n, none = pa.array(list(counts.values()), pa.int64()), pa.array(np.zeros(len(counts), np.int64))
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *((n, none) if toxic else (none, n))], ["q", "toxic", "clean"])

    def stretches(batches):
        found: tuple[dict[str, int], dict[str, int]] = ({}, {})
        for batch in batches:
            for value, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = {mark + w for w in set((value.as_py() or "").lower().split())}
                seen = {w[i:i + n] for w in words if len(w) <= LONGEST for n in sizes for i in range(len(w) - n + 1)}
                counts = found[toxic]
                for q in seen:
                    counts[q] = counts.get(q, 0) + 1
                if len(counts) >= KEPT_STRETCHES:
                    yield counted_batch(counts, toxic)
                    counts.clear()
        for toxic, counts in enumerate(found):
            if counts:
                yield counted_batch(counts, toxic)
        pa.default_memory_pool().release_unused()

    counted = (train.select("text", F.col("toxic").cast("int").alias("toxic")).repartition(32, "toxic", F.xxhash64("text"))
               .mapInArrow(stretches, "q string, toxic long, clean long")
               .groupBy("q").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    n = train.agg(F.count(F.when(F.col("toxic") == 1, 1)), F.count(F.when(F.col("toxic") == 0, 1))).first()
    if not n[0]:
        return []
    rate = F.col("toxic") / n[0]
    odds = (n[0] + 1) / (n[0] + n[1] + 2)
    by_chance = math.log(1e6) / -math.log(odds)
    least_docs = by_chance if part is None else max(part * n[0], min(by_chance, n[0] / 4))
    picked = (counted.where((F.col("toxic") >= least_docs) & (rate >= share * (rate + F.col("clean") / max(n[1], 1))))
              .orderBy(F.col("toxic").desc(), "q").limit(most).select("q").collect())
    return [r.q for r in picked]


def training_words(train: DataFrame, telling: list[str], mark: str = "", most: int = MAX_WORDS) -> tuple[dict, dict]:
    """Words of toxic documents with a telling stretch, and words of clean documents by the least hash and by frequency.

    Both with the number of training documents that hold them.
    """
    word = F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+", -1)))
    words = train.select("toxic", word.alias("word")).where(F.length("word").between(3, LONGEST))
    known, sizes = frozenset(telling), sorted({len(q) for q in telling})

    def tell(batches):
        for batch in batches:
            marks = [mark + w for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([any(w[i:i + n] in known for n in sizes for i in range(len(w) - n + 1)) for w in marks],
                                          pa.bool_())], ["word", "toxic", "n", "found"])

    marked = written(words.groupBy("word").agg(F.sum("toxic").cast("long").alias("toxic"), F.count("*").alias("n"))
                     .mapInArrow(tell, "word string, toxic long, n long, found boolean"), "toxic-words")
    bad = (marked.where((F.col("toxic") > 0) & F.col("found") & (F.col("toxic") * 2 > F.col("n")))
           .orderBy(F.col("toxic").desc(), "word").limit(most).select("word", "toxic").collect())
    good = marked.where(F.col("toxic") == 0).orderBy(F.xxhash64("word")).limit(most).select("word", "n").collect()
    often = marked.where(~F.col("found")).orderBy(F.col("n").desc(), "word").limit(most // 4).select("word", "n").collect()
    return {r.word: r.toxic for r in bad}, {r.word: r.n for r in [*good, *often]}


def train_words(toxic: dict[str, int], clean: dict[str, int], landmarks: int = LANDMARKS, cost: float = COST) -> Model:
    """The machine, folded into a table of weights; a word counts by the root of its number of documents.

    Without words of both classes it finds nothing toxic.
    """
    features = {w: subsequences(kinds_of(w)) for w in {*toxic, *clean}}
    toxic = {w: n for w, n in toxic.items() if len(features[w][0])}
    clean = {w: n for w, n in clean.items() if len(features[w][0])}
    if not toxic or not clean:
        return Model(np.zeros(KINDS ** 3, np.float32), -1.0)
    words = [*toxic, *clean]
    used, column = np.unique(np.concatenate([features[w][0] for w in words]), return_inverse=True)
    ends = np.cumsum([len(features[w][0]) for w in words])
    rows = [(column[end - len(features[w][0]):end], features[w][1]) for w, end in zip(words, ends)]

    def dense(row) -> np.ndarray:
        out = np.zeros(len(used), np.float32)
        np.add.at(out, row[0], row[1])
        return out

    def with_all(marks: np.ndarray, among: list) -> np.ndarray:
        return np.stack([marks[:, c] @ w for c, w in among])

    # landmarks of each class: always the string that resembles the chosen ones least
    chosen: list[np.ndarray] = []
    for pool, n in ((rows[:len(toxic)][:1200], landmarks // 2), (rows[len(toxic):][:1200], landmarks - landmarks // 2)):
        closest = np.zeros(len(pool))
        for _ in range(min(n, len(pool))):
            i = int(np.argmin(closest))
            if closest[i] > 0.98:
                break
            chosen.append(dense(pool[i]))
            closest = np.maximum(closest, with_all(chosen[-1][None], pool)[:, 0])
            closest[i] = np.inf
    marks = np.stack(chosen)
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    root = vectors[:, values > 1e-6] / np.sqrt(values[values > 1e-6])
    x = with_all(marks, rows) @ root
    y = np.concatenate([np.ones(len(toxic)), -np.ones(len(clean))])
    weight = np.sqrt(np.array([*toxic.values(), *clean.values()], float))
    weight *= cost * len(y) / 2 / np.where(y > 0, weight[y > 0].sum(), weight[y < 0].sum())
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    ridge = np.eye(len(beta))
    ridge[-1, -1] = 1e-6
    for _ in range(50):  # Newton steps on the squared hinge
        inside = y * (x1 @ beta) < 1
        xi, wi = x1[inside], weight[inside]
        new = np.linalg.solve(ridge + (xi * wi[:, None]).T @ xi, (xi * wi[:, None]).T @ y[inside])
        if np.allclose(new, beta, atol=1e-9):
            break
        beta = new
    table = np.zeros(KINDS ** 3, np.float32)
    table[used] = root @ beta[:-1] @ marks
    return Model(table, float(beta[-1]))


def fit_curve(measures: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Weights and shift of the logistic curve, with smoothed targets (so that even parted classes have a finite curve)."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    beta = np.zeros(measures.shape[1] + 1)
    beta[0] = 1.0
    if not n1 or not n0:
        return beta
    target = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    middle = measures.mean(axis=0)
    x = np.hstack([measures - middle, np.ones((len(measures), 1))])

    def loss(b):
        z = x @ b
        return np.sum(np.logaddexp(0, z) - target * z) + 0.5e-4 * b @ b

    for _ in range(100):  # Newton steps, halved until they lower the loss
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ x + 1e-4 * np.eye(len(beta)),
                               x.T @ (target - p) - 1e-4 * beta)
        now = loss(beta)
        while np.abs(step).max() > 1e-8 and loss(beta + step) > now:
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    beta[-1] -= beta[:-1] @ middle
    return beta


def log_share(over, words):
    """The logarithm of the share of words above the bound, drawn towards little in short texts."""
    return F.log((over + 0.3) / (words + 50))


MARGIN = T.StructType([T.StructField("margin", T.DoubleType()), T.StructField("word", T.StringType())])
MARGINS = {"worst": T.ArrayType(MARGIN), "words": T.LongType(), "over": T.LongType(), "common": MARGIN}


def margins(df: DataFrame, model: Model, text: str = "text", most: int = 1, whole: bool = False) -> DataFrame:
    """All columns but the text (``whole``: with it) in ``row``, and those of ``MARGINS`` as ``worst_words`` gives them."""
    if whole:  # the text goes to the task once, inside the row
        rows, at_text = df.select(F.struct(*df.columns).alias("row")), df.columns.index(text)
    else:
        rows = df.select(F.struct(*(c for c in df.columns if c != text)).alias("row") if len(df.columns) > 1
                         else F.struct(F.lit(0).alias("none")).alias("row"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["row"], *(T.StructField(n, t) for n, t in MARGINS.items())])
    kind = pa.struct([("margin", pa.float64()), ("word", pa.string())])
    kinds = {"worst": pa.list_(kind), "words": pa.int64(), "over": pa.int64(), "common": kind}
    # one or two tables of KINDS ** 3 weights; as plain values, so that executors need no class of this package
    sent = df.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.common, model.common_bias))

    def measure(batches):
        tables = letter_kinds(), lengths().astype(np.float32)
        weights, bias, common, common_bias = sent.value
        known = Model(weights, bias, common=common, common_bias=common_bias)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = worst_words(part.column(0).field(at_text) if whole else part.column(1), known, tables, most)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array([f[n] for f in found], k) for n, k in kinds.items())], ["row", *kinds])
        pa.default_memory_pool().release_unused()  # else the worker keeps them while it waits, or runs other tasks

    return rows.mapInArrow(measure, schema)


def fit_words(train: DataFrame, toxic: dict[str, int], clean: dict[str, int], rounds: int, most: int) -> Model:
    """A machine for these words; in each round, words of clean documents that score high join the other class."""
    for _ in range(rounds):
        model = train_words(toxic, clean)
        hard = (margins(train.where(F.col("toxic") == 0).select("text"), model, most=most)
                .select(F.explode("worst").alias("x")).where(F.col("x.margin") > -1)
                .groupBy(F.lower("x.word").alias("word")).agg(F.max("x.margin").alias("margin"), F.count("*").alias("n"))
                .orderBy(F.col("margin").desc(), "word").limit(MAX_WORDS // 3).collect())
        clean = {**{r.word: r.n for r in hard if len(r.word) <= LONGEST and r.word not in toxic}, **clean}
    return train_words(toxic, clean)


def fit(docs: DataFrame, labels: DataFrame, rounds: int = 2) -> Model:
    """Train on the labelled documents that are not held out."""
    train = written(training_rows(docs, labels), "toxic-train")
    model = fit_words(train, *training_words(train, telling_stretches(train)), rounds, 3)
    rare = training_words(train, telling_stretches(train, tuple(range(4, 10)), "^", None), "^")
    if rare[0] and rare[1]:
        second = fit_words(train, *rare, rounds, 8)
        model.common, model.common_bias = second.weights, second.bias
    # bounded like the training rows
    seen = margins(train.select("toxic", "text"), model).select(
        F.col("row.toxic").cast("double"), F.coalesce(F.get("worst", F.lit(0))["margin"], F.lit(NO_WORD)),
        F.coalesce("common.margin", F.lit(NO_WORD)), log_share(F.col("over"), F.col("words"))).collect()
    seen = np.array([list(r) for r in seen], float).reshape(-1, 4)
    slope, shift = fit_curve(seen[:, 1:2], seen[:, 0])
    model.slope, model.shift = max(float(slope), 1e-3), float(shift)
    curve = fit_curve(seen[:, 2:], seen[:, 0])
    if curve[1] > 0:
        model.curve = tuple(map(float, curve))
    else:  # words that are no more frequent in toxic texts
        model.common = None
    return model


def score(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD, whole: bool = False) -> DataFrame:
    """``row`` (all columns but the text, or with it if ``whole``), ``score`` (0 to 1), ``predicted`` (0 or 1), ``margin`` and ``word``.

    The last two are of the machine that gives the score: its highest margin and that margin's word.
    """
    worst = F.get("worst", F.lit(0))
    first = F.lit(model.slope) * F.coalesce(worst["margin"], F.lit(NO_WORD)) + F.lit(model.shift)
    a, b, c = map(F.lit, model.curve)
    second = F.when(F.col("over") > 0, a * F.col("common.margin") + b * log_share(F.col("over"), F.col("words")) + c)
    higher = F.coalesce(second > first, F.lit(False))
    return (margins(df, model, text, whole=whole)
            .select("row", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.when(higher, second).otherwise(first)))).alias("score"),
                    F.when(higher, F.col("common.margin")).otherwise(F.coalesce(worst["margin"], F.lit(NO_WORD))).alias("margin"),
                    F.when(higher, F.col("common.word")).otherwise(worst["word"]).alias("word"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def judge(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted, margin, word`` for every document."""
    model = model or fit(docs, labels)
    return score(docs.select("doc_id", "text"), model).select("row.doc_id", "score", "predicted", "margin", "word").select(
        "doc_id", F.coalesce(is_held_out(), F.lit(False)).alias("held_out"), "score", "predicted", "margin", "word")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    scored = score(docs, fit(docs, labels), threshold=threshold, whole=True)
    return scored.where(F.col("predicted") == 0).select("row.*")


ship(__name__)
