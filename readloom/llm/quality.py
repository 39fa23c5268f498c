"""Quality rules whose thresholds follow the data of each language and source.

Every text is measured (words, symbols, repeated lines, words in repeated
three-word windows). For each language and source, and each rule's measure, a
quantile sketch is kept: counts in log-linear bins (a number keeps its
``BITS`` leading bits, so quantiles are right within 1 / 32). Sketches merge by
adding counts and do not depend on how rows are dealt out.

The fences come from the sketch alone: the quartiles widened by three
interquartile ranges; where both quartiles fall into one bin, as in measures
that are zero for most texts, the outermost 2 % quantiles and one bin more. A
fence is then shrunk towards the one of the merged sketches: a group of n rows
counts n, its language ``PRIOR``, and a language towards all rows likewise. So
groups of any size follow one rule; a small one mostly stands by its language.
The fences are joined to the rows, and rows outside are not kept.

The measures stay inside one row's functions, so no text is shuffled; the
sketches are added up map-side before any shuffle, and a group that holds a
third of all rows is a few thousand counts by then. Fences have one row per
language and source; they are joined without a hint.

Null or empty texts have no words and fail. Null languages and sources are
groups of their own. Long texts cost n log n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.session import written

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MOST_REPEATED = 50
BITS = 6
RANGES = 3
#: Percent of rows within the outermost quantile, on either side.
TAIL = 98
#: Rows that the coarser group counts for.
PRIOR = 200
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
RULES = ("symbols", "dup_lines", "repeats", "word_length")


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row, however often ``use`` looks at it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """Runs of characters other than the six ASCII blanks; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+", -1), "")


def n_covered(windows: Column) -> Column:
    """Words inside three-word windows found twice or more, from the windows' hashes in the order of the text.

    Without equal windows there are none. Else windows are sorted with their
    places; one that equals a neighbour is repeated. Of repeated windows in the
    order of places, each covers as many words as lie before the next, three at
    most.
    """

    def marked(placed: Column) -> Column:
        def same(i, k):
            return F.coalesce(F.get(placed, i)["w"] == F.get(placed, k)["w"], F.lit(False))

        twice = F.filter(F.transform(placed, lambda x, i: F.when(
            ((i > 0) & same(i, i - 1)) | same(i, i + 1), x["i"])), lambda p: p.isNotNull())
        return once(F.sort_array(twice), lambda p: F.aggregate(
            F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.least(F.lit(3), b - a)),
            F.lit(3), lambda total, n: total + n))

    placed = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
        once(F.sort_array(placed), marked))


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """All columns and ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` (long)."""
    t = F.coalesce(F.col(text), F.lit(""))
    w, h, x = "_words", "_windows", "_lines"
    three = F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    # steps of their own, so that each list is made once
    return (
        df.withColumns({w: words_of(F.col(text)), "n_symbols": F.length(F.regexp_replace(t, f"[^{SYMBOLS}]+", "")).cast("long"),
                        x: F.filter(F.split(t, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))})
        .withColumns({"n_words": F.size(w).cast("long"), "word_chars": F.length(F.array_join(w, "")).cast("long"),
                      "n_lines": F.size(x).cast("long"),
                      "n_dup_lines": (F.size(x) - F.size(F.array_distinct(x))).cast("long"),
                      h: F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(three)})
        .drop(w, x).withColumn("n_repeat_words", n_covered(F.col(h)).cast("long")).drop(h))


def rates() -> dict[str, Column]:
    """The rules' measures: per thousand of characters, lines and words, and characters in a hundred words."""
    def per(part, whole, n):
        return F.expr(f"coalesce(({n} * {part}) div nullif({whole}, 0), 0)")

    return {"symbols": per("n_symbols", "word_chars", 1000), "dup_lines": per("n_dup_lines", "n_lines", 1000),
            "repeats": per("n_repeat_words", "n_words", 1000), "word_length": per("word_chars", "n_words", 100)}


def bin_width(value: Column, bits: int = BITS) -> Column:
    """Width of the number's bin, as a power of two's exponent."""
    return F.greatest(F.length(F.bin(value)) - F.lit(bits), F.lit(0))


def sketch_bin(value: Column, bits: int = BITS) -> Column:
    """The lower end of the number's bin: its ``bits`` leading bits."""
    drop = bin_width(value, bits)
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame, group: list[str]) -> DataFrame:
    """``group, measure, bin, n``: one sketch per group and measure, of rows with words."""
    bins = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), sketch_bin(c).alias("bin")) for m, c in rates().items()]))
    return (measured.where(F.col("n_words") > 0).select(*group, bins.alias("b")).select(*group, "b.*")
            .groupBy(*group, "measure", "bin").agg(F.count("*").alias("n")))


def merged(sketch: DataFrame, group: list[str]) -> DataFrame:
    """The sketches of a coarser group."""
    return sketch.groupBy(*group, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, group: list[str], n_ranges: int = RANGES, tail: int = TAIL) -> DataFrame:
    """``group, measure, n, fence`` (``low, high``, 0 at least) from the quantiles of each sketch."""
    keys = [*group, "measure"]
    whole, upto = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("bin")
    ranked = sketch.withColumn("total", F.sum("n").over(whole)).withColumn("upto", F.sum("n").over(upto))
    q = ranked.groupBy(*keys).agg(F.max("total").alias("n"), *[
        F.min(F.when(F.col("upto") * 100 >= F.col("total") * share, F.col("bin"))).alias(name)
        for name, share in (("lowest", 100 - tail), ("q1", 25), ("q3", 75), ("highest", tail))])
    one = F.lit(1).cast("long")
    step = {c: F.call_function("shiftleft", one, bin_width(F.col(c))) for c in ("lowest", "highest")}
    reach, flat = (F.col("q3") - F.col("q1")) * n_ranges, F.col("q1") == F.col("q3")
    low = F.when(flat, F.col("lowest") - step["lowest"]).otherwise(F.col("q1") - reach)
    high = F.when(flat, F.col("highest") + step["highest"]).otherwise(F.col("q3") + reach)
    return q.select(*keys, "n", F.struct(F.greatest(low, F.lit(0)).alias("low"), high.alias("high")).alias("fence"))


def shrunk(own: str, n: str, coarser: str, prior: int = PRIOR) -> Column:
    """The fence ``own`` of ``n`` rows drawn towards ``coarser``, which counts for ``prior`` rows; rounded outwards."""
    low = f"({n} * {own}.low + {prior} * {coarser}.low) div ({n} + {prior})"
    high = f"({n} * {own}.high + {prior} * {coarser}.high + {n} + {prior} - 1) div ({n} + {prior})"
    return F.struct(F.expr(low).alias("low"), F.expr(high).alias("high"))


def adaptive_fences(measured: DataFrame, prior: int = PRIOR) -> DataFrame:
    """One row per language and source: ``lang, source`` and ``low, high`` per measure (``symbols_fence`` ...)."""
    by_group = sketches(measured, ["lang", "source"])
    by_lang = merged(by_group, ["lang"])
    own = fences(by_group, ["lang", "source"])
    every = fences(merged(by_lang, []), []).select("measure", F.col("fence").alias("all_fence"))
    lang = fences(by_lang, ["lang"]).join(every, "measure").select(
        F.col("measure").alias("m"), F.col("lang").alias("of_lang"), shrunk("fence", "n", "all_fence", prior).alias("lang_fence"))
    joined = own.join(lang, (F.col("measure") == F.col("m")) & F.col("lang").eqNullSafe(F.col("of_lang")))
    return joined.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == m, shrunk("fence", "n", "lang_fence", prior))).alias(f"{m}_fence") for m in RULES])


def judge(df: DataFrame, carry: tuple[str, ...] = ("doc_id",), prior: int = PRIOR) -> DataFrame:
    """The ``carry`` columns, ``lang, source``, all measures, ``base_failed`` and ``kept`` for every row.

    The measured rows are stored under the shared folder once (without texts,
    unless carried): the sketches are made from them, then the verdicts.
    """
    whole = measure(df)
    names = [c for c in whole.columns if c in {*carry, "lang", "source", *MEASURES}]
    measured = written(whole.select(*names), "measured")
    limits = adaptive_fences(measured, prior).select(
        F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), *[f"{m}_fence" for m in RULES])
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    inside = F.lit(True)
    for m, c in rates().items():
        fence = F.col(f"{m}_fence")
        inside = inside & c.between(fence["low"], fence["high"])
    return (measured.join(limits, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
            .withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(inside, F.lit(False)))
            .drop("of_lang", "of_source", *[f"{m}_fence" for m in RULES]))
