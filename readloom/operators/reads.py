"""Read-level operators on ``(sample_id | file, read_no, header, seq, plus, qual)``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from readloom.functions.shipping import ship
from readloom import constants as K
from readloom.functions.stats import share
from readloom.session import written

PHRED_OFFSET = 33

ship(__name__)


# --- format checks -----------------------------------------------------------------


def read_error(
    header: Column, plus: Column, seq: Column, qual: Column
) -> Column:
    """First broken rule of a record, or NULL."""
    return (
        F.when(~header.startswith("@"), "header")
        .when(~plus.startswith("+"), "plus")
        .when(F.length(F.trim(seq)) != F.length(F.trim(qual)), "length")
    )


def validate_reads(reads: DataFrame) -> DataFrame:
    """Per file and error: reads, first read number and its header. All reads are checked."""
    broken = reads.withColumn("error", read_error(
        F.coalesce("header", F.lit("")), F.coalesce("plus", F.lit("")),
        F.coalesce("seq", F.lit("")), F.coalesce("qual", F.lit("")))).where("error is not null")
    return broken.groupBy("file", "error").agg(
        F.count("*").alias("n_reads"),
        F.min("read_no").alias("first_read"),
        F.min_by("header", "read_no").alias("first_header"),
    )


def repair_wrapped_lines(lines: DataFrame) -> DataFrame:
    """Six-line records to four-line ones. ``lines(file, line_no, line)``, 0-based."""
    slot = F.col("line_no") % 6

    def at(i: int) -> Column:
        return F.max(F.when(slot == i, F.col("line")))

    return lines.groupBy("file", F.floor(F.col("line_no") / 6).cast("bigint").alias("read_no")).agg(
        at(0).alias("header"), F.concat(F.trim(at(1)), F.trim(at(2))).alias("seq"),
        at(3).alias("plus"), F.concat(F.trim(at(4)), F.trim(at(5))).alias("qual"),
    )


def find_reads(reads: DataFrame, ids: Sequence[str]) -> DataFrame:
    """First read of each file whose header contains an id, with its lengths."""
    wanted = F.array(*[F.lit(i) for i in ids])
    hits = reads.select(
        "file", "read_no", "header", F.length(F.trim("seq")).alias("seq_length"),
        F.length(F.trim("qual")).alias("qual_length"),
        F.explode(F.filter(wanted, lambda i: F.col("header").contains(i))).alias("id"))
    first = hits.groupBy("id", "file").agg(
        F.min_by(F.struct("read_no", "header", "seq_length", "qual_length"), "read_no").alias("r"))
    return first.select("id", "file", "r.*").withColumn(
        "mismatch", F.col("seq_length") != F.col("qual_length"))


def subset_reads(reads: DataFrame, n: int = 500_000) -> DataFrame:
    """The first ``n`` reads of every sample, by 0-based read number. No shuffle."""
    return reads.where(F.col("read_no") < n)


# --- quality profile ---------------------------------------------------------------


def _bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and the offset of every value, without copying."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset: column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), at


def _positions(lengths: np.ndarray) -> np.ndarray:
    """0-based position of every byte within its value."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def _pieces(values, column=None, limit: int = 1 << 22):
    """Slices of at most ``limit`` bases, or of one longer read, to bound memory."""
    text = values if column is None else values.column(column)
    _, at = _bytes(text)
    first = 0
    while first < len(values):
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(values))
        yield values.slice(first, last - first)
        first = last


_CELLS = "sample_id string, kind string, a bigint, b bigint, n bigint, m bigint"


def _cells(names, code, kind, a, b, n, m=None):
    import pyarrow as pa

    size = len(n)
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(code)).cast(pa.string()), pa.array([kind] * size, pa.string()),
         *[pa.array(np.broadcast_to(np.asarray(x, np.int64), size)) for x in (a, b, n)],
         pa.array(np.zeros(size, np.int64) if m is None else np.asarray(m, np.int64))],
        names=["sample_id", "kind", "a", "b", "n", "m"])


def _base_cells(names, code, qual, seq):
    """Reads and N bases per sample, position and score of one batch."""
    (data, at), (bases, seq_at) = qual, seq
    length, seq_length = np.diff(at), np.diff(seq_at)
    if not length.sum():
        return
    pos = _positions(length)
    # N where the sequence has it; a sequence may be shorter than its scores
    inside = pos < np.repeat(seq_length, length)
    is_n = np.zeros(len(pos), bool)
    is_n[inside] = np.isin(bases[(np.repeat(seq_at[:-1], length) + pos)[inside]], (78, 110))
    width = int(length.max())
    place = np.repeat(code, length) * width + pos
    # sample, position, score and "is N" in one number per base
    key = (place << 8 | data[at[0]: at[-1]]) << 1 | is_n
    if (len(names) * width) << 9 <= 1 << 23:
        n = np.bincount(key)
        cells = np.flatnonzero(n)
        n = n[cells]
    else:
        cells, n = np.unique(key, return_counts=True)
    place = cells >> 9
    yield _cells(names, place // width, "base", place % width + 1,
                 (cells >> 1 & 255) - PHRED_OFFSET, n, n * (cells & 1))


def _score_cells(names, code, qual):
    """Reads per sample and whole mean score of one batch."""
    data, at = qual
    length = np.diff(at)
    keep = length > 0
    total = np.concatenate([[0], np.cumsum(data[at[0]: at[-1]], dtype=np.int64)])
    score = np.diff(total[at - at[0]]) - PHRED_OFFSET * length
    cells, n = np.unique(code[keep] << 8 | score[keep] // length[keep], return_counts=True)
    yield _cells(names, cells >> 8, "read", cells & 255, 0, n)


def _call_cells(names, code, seq):
    """Per sample: reads, called bases (A, C, G, T) and G or C bases of one batch."""
    bases, at = seq
    letter = bases[at[0]: at[-1]] & 0xDF  # upper case
    owner = np.repeat(code, np.diff(at))
    gc = np.isin(letter, (67, 71))
    called = gc | np.isin(letter, (65, 84))
    size = len(names)
    yield _cells(names, np.arange(size), "total", 0, 0, np.bincount(code, minlength=size))
    yield _cells(names, np.arange(size), "call", 0, 0, np.bincount(owner[called], minlength=size),
                 np.bincount(owner[gc], minlength=size))


def _adapter_cells(names, code, column, motifs):
    """Reads per sample, adapter and first position (0 for none) of one batch."""
    import pyarrow.compute as pc

    for i, motif in enumerate(motifs):
        start = pc.find_substring(column, motif).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        width = int(start.max(initial=0)) + 1
        cells, n = np.unique(code * width + start, return_counts=True)
        yield _cells(names, cells // width, "adapter", i, cells % width, n)


def read_cells(
    reads: DataFrame, kinds: Sequence[str] = ("base", "read", "call", "adapter"),
    motifs: Sequence[str] = (),
) -> DataFrame:
    """All counts a quality profile needs, from one pass over the reads.

    ``(sample_id, kind, a, b, n, m)``: ``base`` cells by position and score with
    the N bases in ``m``, ``read`` by mean score, ``total`` and ``call`` per sample
    with G or C bases in ``m``, ``adapter`` by adapter and first position. Bases are
    counted per Arrow batch, so a row per base never exists, and the shuffle
    carries counts only.
    """
    wanted, texts = set(kinds), list(motifs)

    def count(batches):
        for batch in (piece for whole in batches for piece in _pieces(whole, "qual")):
            sample = batch.column("sample_id").dictionary_encode()
            names = sample.dictionary
            code = sample.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            qual, seq = _bytes(batch.column("qual")), _bytes(batch.column("seq"))
            if "base" in wanted:
                yield from _base_cells(names, code, qual, seq)
            if "read" in wanted:
                yield from _score_cells(names, code, qual)
            if "call" in wanted:
                yield from _call_cells(names, code, seq)
            if "adapter" in wanted:
                yield from _adapter_cells(names, code, batch.column("seq").fill_null(""), texts)

    counted = reads.select(F.coalesce("sample_id", F.lit("unknown")).alias("sample_id"), "seq", "qual")
    return counted.mapInArrow(count, _CELLS).groupBy("sample_id", "kind", "a", "b").agg(
        F.sum("n").alias("n"), F.sum("m").alias("m"))


def _of(cells: DataFrame, kind: str) -> DataFrame:
    return cells.where(F.col("kind") == kind)


def base_cells(cells: DataFrame) -> DataFrame:
    return _of(cells, "base").select(
        "sample_id", F.col("a").alias("pos"), F.col("b").cast("int").alias("quality"), "n",
        F.col("m").alias("n_base"))


def score_cells(cells: DataFrame) -> DataFrame:
    return _of(cells, "read").select(
        "sample_id", F.col("a").cast("int").alias("quality"), F.col("n").alias("reads"))


def call_cells(cells: DataFrame) -> DataFrame:
    total = F.sum(F.when(F.col("kind") == "total", F.col("n")))
    called = F.sum(F.when(F.col("kind") == "call", F.col("n")))
    gc = F.sum(F.when(F.col("kind") == "call", F.col("m")))
    return cells.where(F.col("kind").isin("total", "call")).groupBy("sample_id").agg(
        total.alias("total_sequences"),
        F.floor(F.coalesce(F.try_divide(gc * 100, called), F.lit(0))).cast("bigint").alias("gc"))


def adapter_cells(cells: DataFrame) -> DataFrame:
    """``(sample_id, pos, adapter_pct)``: largest cumulative share over the adapters."""
    starts = _of(cells, "adapter").select("sample_id", F.col("a").alias("adapter"), F.col("b").alias("pos"), "n")
    total = F.sum("n").over(W.partitionBy("sample_id", "adapter"))
    found = F.when(F.col("pos") > 0, F.col("n")).otherwise(0)
    upto = F.sum(found).over(
        W.partitionBy("sample_id", "adapter").orderBy("pos")
        .rowsBetween(W.unboundedPreceding, W.currentRow))
    steps = starts.select("sample_id", "adapter", "pos", share(upto, total).alias("pct"))
    # cumulative shares never fall, so the maximum over adapters at a position
    # is the running maximum of the per-adapter steps
    running = F.max("pct").over(
        W.partitionBy("sample_id").orderBy("pos")
        .rangeBetween(W.unboundedPreceding, W.currentRow))
    return (
        steps.withColumn("adapter_pct", running).where("pos > 0")
        .groupBy("sample_id", "pos").agg(F.max("adapter_pct").alias("adapter_pct"))
    )


def base_histogram(reads: DataFrame) -> DataFrame:
    """``(sample_id, pos, quality, n, n_base)``: reads and N bases per position and score."""
    return base_cells(read_cells(reads, ["base"]))


def position_profile(histogram: DataFrame) -> DataFrame:
    """Mean and exact quantiles per position from the histogram, and the N share."""
    q, n = F.col("quality"), F.col("n")
    names = {"median": 0.5, "lower_quartile": 0.25, "upper_quartile": 0.75, "p10": 0.1, "p90": 0.9}
    per_position = histogram.groupBy("sample_id", "pos").agg(
        share(F.sum(q * n), F.sum(n), 1).alias("mean"),
        # one buffer of at most one entry per score serves all quantiles
        F.percentile(q, F.array(*[F.lit(p) for p in names.values()]), n).alias("quantiles"),
        share(F.sum("n_base"), F.sum(n)).alias("n_pct"),
    )
    return per_position.select(
        "sample_id", "pos", "mean",
        *[F.col("quantiles")[i].alias(name) for i, name in enumerate(names)], "n_pct")


def n_profile(histogram: DataFrame) -> DataFrame:
    """N share per position alone, without quantiles."""
    return histogram.groupBy("sample_id", "pos").agg(
        share(F.sum("n_base"), F.sum("n")).alias("n_pct"))


def read_quality_histogram(reads: DataFrame) -> DataFrame:
    """Reads per whole mean quality."""
    return score_cells(read_cells(reads, ["read"]))


def basic_statistics(reads: DataFrame) -> DataFrame:
    """Reads and whole %GC (of A, C, G and T) per sample."""
    return call_cells(read_cells(reads, ["call"]))


def adapter_content(reads: DataFrame, adapters: Sequence[str] | None = None) -> DataFrame:
    """Cumulative adapter share by position. A read counts from the first start of the adapter."""
    return adapter_cells(read_cells(reads, ["adapter"], adapters or [K.ADAPTER_SEARCH]))


def profile_rows(reads: DataFrame, adapters: Sequence[str] | None = None) -> DataFrame:
    """Quality profile as report rows, ready for the report checks.

    The reads are scanned once: their counts, a table of samples x positions x
    scores, are written to the shared folder and every module is made from
    them. Module verdicts are not computed, so every module is ``pass`` here.
    """
    cells = written(read_cells(reads, motifs=adapters or [K.ADAPTER_SEARCH]), "read-cells")

    def text(*cols: Column | str) -> Column:
        return F.array(*[F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
                         for c in cols])

    def rows(df: DataFrame, module: str, row_no: Column, cells: Column) -> DataFrame:
        return df.select("sample_id", F.lit(module).alias("module"), F.lit("pass").alias("status"),
                         row_no.cast("int").alias("row_no"), cells.alias("cells"))

    stats = call_cells(cells).select("sample_id", F.posexplode(F.array(
        text(F.lit("Total Sequences"), F.col("total_sequences")),
        text(F.lit("%GC"), F.col("gc")))).alias("i", "cells"))
    positions = position_profile(base_cells(cells))
    quality = score_cells(cells)
    adapter = adapter_cells(cells)
    parts = [
        rows(stats, "Basic Statistics", F.col("i"), F.col("cells")),
        rows(positions, "Per base sequence quality", F.col("pos"),
             text("pos", "mean", "median", "lower_quartile", "upper_quartile", "p10", "p90")),
        rows(positions, "Per base N content", F.col("pos"), text("pos", "n_pct")),
        rows(quality, "Per sequence quality scores", F.col("quality"), text("quality", "reads")),
        rows(adapter, "Adapter Content", F.col("pos"), text("pos", "adapter_pct")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- trimming ----------------------------------------------------------------------


def adapter_pattern(adapter: str, min_overlap: int = 3) -> str:
    """Regex for the whole adapter anywhere, or a prefix of it at the 3' end."""
    tail = ""
    for base in reversed(adapter[min_overlap:-1]):
        tail = f"(?:{base}{tail})?"
    return f"{adapter}|{adapter[:min_overlap]}{tail}$"


def _kept_lengths(qual, cutoff: int):
    """Kept length per value of an Arrow text array; see ``quality_cut``."""
    import pyarrow as pa

    data, at = _bytes(qual)
    length = np.diff(at)
    keep = np.zeros(len(length), np.int64)
    some = length > 0
    if some.any():
        size, first = length[some], (at[:-1] - at[0])[some]
        gain = cutoff + PHRED_OFFSET - data[at[0]: at[-1]].astype(np.int64)
        total = np.concatenate([[0], np.cumsum(gain)])
        pos = _positions(size)
        # sum of the gains from a position to the end of its read
        suffix = np.repeat(total[first + size], size) - total[:-1]
        stop = np.maximum.reduceat(np.where(suffix < 0, pos, -1), first)
        reached = np.where(pos > np.repeat(stop, size), suffix, 0)
        best = np.maximum.reduceat(reached, first)
        at_best = (reached == np.repeat(best, size)) & (reached > 0)
        cut = np.maximum.reduceat(np.where(at_best, pos, -1), first)
        keep[some] = np.where(cut >= 0, cut, size)
    return pa.array(keep, pa.int32())


def quality_cut(qual: Column, cutoff: int) -> Column:
    """Bases kept by 3' quality trimming.

    Running sums of ``cutoff - q`` from the 3' end; the cut is at the largest
    sum, and the walk stops where the sum falls below zero. All reads of an
    Arrow batch are cut at once: folding over an array per read in the JVM ran
    several times longer.
    """
    def cut(column):
        import pyarrow as pa

        return pa.concat_arrays([_kept_lengths(c, cutoff) for c in _pieces(column)] or [
            pa.array([], pa.int32())])

    return F.arrow_udf(cut, "int")(qual)


def trim_mate(
    seq: Column, qual: Column, adapter: str, cutoff: int = K.QUALITY_CUTOFF, min_overlap: int = 3
) -> Column:
    """``struct(seq, qual)`` after quality trimming and adapter removal."""
    kept = quality_cut(qual, cutoff)
    short = F.substr(seq, F.lit(1), kept)
    at = F.regexp_instr(short, F.lit(adapter_pattern(adapter, min_overlap)))
    final = F.when(at > 0, at - 1).otherwise(kept)
    return F.struct(F.substr(seq, F.lit(1), final).alias("seq"),
                    F.substr(qual, F.lit(1), final).alias("qual"))


def trim_pairs(
    pairs: DataFrame,
    adapter_r1: str = K.ADAPTER_R1,
    adapter_r2: str = K.ADAPTER_R2,
    quality: int = K.QUALITY_CUTOFF,
    min_length: int = K.MIN_READ_LENGTH,
) -> DataFrame:
    """Trims both mates and marks pairs where either is too short.

    ``pairs(sample_id, seq1, qual1, seq2, qual2)``; a NULL second mate is
    single-end. Filter on ``~too_short`` for the reads, use ``trim_counters``
    for the totals.
    """
    one = trim_mate(F.col("seq1"), F.col("qual1"), adapter_r1, quality)
    two = F.when(F.col("seq2").isNotNull(),
                 trim_mate(F.col("seq2"), F.col("qual2"), adapter_r2, quality))
    out = pairs.withColumn("m1", one).withColumn("m2", two)
    short = (F.length("m1.seq") < min_length) | F.coalesce(
        F.length("m2.seq") < min_length, F.lit(False))
    return out.withColumn("too_short", short)


def trim_counters(trimmed: DataFrame) -> DataFrame:
    """The totals a trimming log reports, per sample."""
    return trimmed.groupBy("sample_id").agg(
        F.count("*").alias("total_pairs"),
        F.count_if("too_short").alias("too_short"),
        F.count_if(~F.col("too_short")).alias("passed"),
        F.sum(F.length("seq1") + F.coalesce(F.length("seq2"), F.lit(0))).cast("bigint")
        .alias("total_bp"),
    )
