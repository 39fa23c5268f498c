"""FASTQ files as rows.

A record is four lines (six for wrapped reads), counted from the start of the
file, whatever the lines hold: damaged files give the same records however
they are cut. Plain files and block gzip files are cut into byte ranges. The
newlines of each range are counted first; their running sum says which line a
range begins with, and so where its first record starts. In a block gzip file a
range holds the members that start in it; what kind a gzip file is, the
tasks see. Other gzip files are one task each.

``spark.dataSource.register(FastqSlices)`` and ``format("fastq_slices")`` list
the ranges with their newlines; ``read_fastq`` builds the reads on it. Files
are opened through pyarrow's file systems, so the same path works on local
disks, HDFS and object stores.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from readloom.functions.shipping import ship
from readloom.functions.stores import store_of
from readloom.session import written
from readloom.sources.blocks import MemberStream, first_member, is_blocked, members

SLICE_SCHEMA = "file string, root string, path string, start bigint, stop bigint, text_bytes bigint, newlines bigint"
READ_SCHEMA = "file string, read_no bigint, header string, seq string, plus string, qual string"

ship(__name__)
ENDINGS = (".fastq.gz", ".fq.gz", ".fastq", ".fq")
BLOCK = 4 << 20
#: Ranges beyond this number share tasks, as far as a task gets no more than ``TASK_BYTES`` of the files.
TASKS = 512
TASK_BYTES = 128 << 20


def _raw(root: str, path: str) -> io.BufferedReader:
    store, _ = store_of(root)
    return io.BufferedReader(store.open_input_file(path), 1 << 18)


def _opened(root: str, path: str) -> io.BufferedReader:
    store, _ = store_of(root)
    if path.lower().endswith(".gz"):
        return io.BufferedReader(store.open_input_stream(path, compression="gzip"), 1 << 20)
    return io.BufferedReader(store.open_input_file(path), 1 << 20)


class Slice(InputPartition):
    def __init__(self, file: str, root: str, path: str, start: int, stop: int | None):
        self.file, self.root, self.path, self.start, self.stop = file, root, path, start, stop


class Slices(InputPartition):
    """Ranges that one task goes through."""

    def __init__(self, slices: list[Slice]):
        self.slices = slices


def tasks_of(ranges: int, split_bytes: int) -> int:
    """Tasks for so many ranges: one for each, or fewer where the ranges are small and many."""
    return min(ranges, max(TASKS, -(-ranges * split_bytes // TASK_BYTES))) if split_bytes else ranges


class FastqSlices(DataSource):
    """Byte ranges of FASTQ files. Options: ``path``, ``split_bytes`` (0: files stay whole),
    ``endings`` (of file names, joined by commas).

    ``newlines``: those that start a line within the range, the first line of a
    file not counted; 0 for files that are not cut, which are not opened here. Ranges
    of block gzip files begin at a member, and ``text_bytes`` is the size of their text; a line
    that starts right after it is theirs too.
    """

    @classmethod
    def name(cls) -> str:
        return "fastq_slices"

    def schema(self) -> str:
        return SLICE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return SliceReader(self.options)


class SliceReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.split_bytes = int(options.get("split_bytes", 128 << 20))
        self.endings = tuple(options.get("endings", ",".join(ENDINGS)).split(","))

    def partitions(self) -> list[Slice]:
        from pyarrow import fs

        store, base = store_of(self.root)
        info = store.get_file_info(base)
        if info.type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(base, recursive=True))
        else:
            found = [info]
        prefix = "file://" if isinstance(store, fs.LocalFileSystem) else self.root[: len(self.root) - len(base)]
        out = []
        for f in sorted(found, key=lambda f: f.path):
            if f.type != fs.FileType.File or not f.path.lower().endswith(self.endings):
                continue
            cuts = [0]
            if self.split_bytes:
                cuts = list(range(0, f.size, self.split_bytes)) or cuts
            out += [Slice(prefix + f.path, self.root, f.path, a, b) for a, b in zip(cuts, [*cuts[1:], None])]
        if not out:
            return [Slice("", "", "", 0, 0)]
        n = tasks_of(len(out), self.split_bytes)
        if n == len(out):
            return out
        return [Slices(out[len(out) * k // n:len(out) * (k + 1) // n]) for k in range(n)]

    def read(self, part: Slice | Slices) -> Iterator[tuple]:
        for each in part.slices if isinstance(part, Slices) else [part]:
            yield from self._newlines(each)

    def _newlines(self, part: Slice) -> Iterator[tuple]:
        if not part.file:
            return
        cut = part.start or part.stop is not None
        if cut and part.path.lower().endswith(".gz"):
            yield from self._members(part)
            return
        n = 0
        if cut:
            with _opened(part.root, part.path) as handle:
                # a newline at byte p starts a line at p + 1
                at = max(part.start - 1, 0)
                left = float("inf") if part.stop is None else part.stop - 1 - at
                handle.seek(at)
                while left > 0 and (block := handle.read(int(min(BLOCK, left)))):
                    n += block.count(b"\n")
                    left -= len(block)
        yield part.file, part.root, part.path, part.start, part.stop, None, n

    def _members(self, part: Slice) -> Iterator[tuple]:
        """The members that start in the range; for other gzip files the first range stands for the whole file."""
        with _raw(part.root, part.path) as handle:
            if not is_blocked(handle):
                if part.start == 0:
                    yield part.file, part.root, part.path, 0, None, None, 0
                return
            size = handle.seek(0, io.SEEK_END)
            stop = size if part.stop is None else part.stop
            first = first_member(handle, part.start, stop, size)
            if first is None:
                return
            n = text_bytes = 0
            for at, text in members(handle, first):
                if at >= stop:
                    break
                n += text.count(b"\n")
                text_bytes += len(text)
            yield part.file, part.root, part.path, first, stop, text_bytes, n


def _blocks(handle: io.BufferedReader, start: int, stop: int | None, first_line: int, lines: int) -> Iterator[tuple[int, bytes]]:
    """``(record number, bytes)`` of whole records whose first line starts in the range.

    ``first_line``: number of the first line that starts in the range.
    """
    at = start
    if start:
        handle.seek(start - 1)
        at += len(handle.readline()) - 1
    for _ in range(-first_line % lines):
        at += len(handle.readline())
    record = -(-first_line // lines)
    while stop is None or at < stop:
        block = handle.read(BLOCK if stop is None else min(BLOCK, stop - at))
        if not block:
            return
        if not block.endswith(b"\n"):
            block += handle.readline()
        n = block.count(b"\n") + (not block.endswith(b"\n"))
        block += b"".join(handle.readline() for _ in range(-n % lines))
        at += len(block)
        yield record, block
        record += -(-n // lines)


def _columns(block: bytes, lines: int) -> list:
    """Header, sequence, plus and quality of the records of a block; lines a cut-off file lacks are empty."""
    import pyarrow.compute as pc

    try:
        block.decode()
    except UnicodeDecodeError:
        block = block.decode("utf-8", "replace").encode()
    ends = np.flatnonzero(np.frombuffer(block, np.uint8) == 10) + 1
    if not len(ends) or ends[-1] < len(block):
        ends = np.append(ends, len(block))
    missing = -len(ends) % lines
    at = np.concatenate([[0], ends, np.full(missing, len(block))]).astype(np.int32)
    whole = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.tobytes()), pa.py_buffer(block))
    line = [pc.utf8_rtrim(whole.take(pa.array(np.arange(k, len(at) - 1, lines))), characters="\r\n") for k in range(lines)]
    if lines == 4:
        return line

    def joined(a, b):
        return pc.binary_join_element_wise(pc.utf8_trim_whitespace(a), pc.utf8_trim_whitespace(b), "")

    return [line[0], joined(line[1], line[2]), line[3], joined(line[4], line[5])]


def _reads(lines: int, first_reads: int | None):
    """Function for ``mapInArrow`` over slices that know their first line."""
    names = ["file", "read_no", "header", "seq", "plus", "qual"]

    def read(batches):
        for batch in batches:
            for s in batch.to_pylist():
                start, stop, n_text = s["start"], s["stop"], s["text_bytes"]
                if n_text is None:
                    handle = _opened(s["root"], s["path"])
                else:
                    # the text of the members, as a range that begins after its first byte, but for a file's first
                    handle = io.BufferedReader(MemberStream(_raw(s["root"], s["path"]), start), 1 << 20)
                    start, stop = min(start, 1), n_text + 1
                with handle:
                    for record, block in _blocks(handle, start, stop, s["first_line"], lines):
                        columns = _columns(block, lines)
                        n = len(columns[0])
                        if first_reads is not None:
                            n = min(n, max(first_reads - record, 0))
                        if n == 0:
                            break
                        numbers = np.arange(record, record + n, dtype=np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([s["file"]] * n, pa.string()), pa.array(numbers), *(c.slice(0, n) for c in columns)], names)

    return read


def read_fastq(
    spark: SparkSession, path: str, lines_per_record: int = 4, split_bytes: int = 128 << 20,
    first_reads: int | None = None, endings: Sequence[str] = ENDINGS,
) -> DataFrame:
    """``(file, read_no, header, seq, plus, qual)`` of every file under ``path`` whose name has one of ``endings``.

    ``read_no`` is 0-based within the file. Lines lose their line end only;
    bytes that are no UTF-8 become replacement marks; lines that a cut-off last
    record lacks are empty. The ranges are listed, and counted where a file has
    several, when this is called; the reads are never shuffled. Block gzip files are split like plain ones. With
    ``first_reads`` each file is read from its start and left after that many.
    """
    spark.dataSource.register(FastqSlices)
    found = spark.read.format("fastq_slices").option("endings", ",".join(endings)).option(
        "split_bytes", "0" if first_reads is not None else str(split_bytes)).load(path)
    slices = written(found, "fastq-slices")
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    # the first line of a range that is not the first: one more than the lines begun by newlines before it
    placed = slices.withColumn("first_line", F.when(F.col("start") == 0, F.lit(0)).otherwise(F.lit(1) + F.sum("newlines").over(before)).cast("bigint"))
    # a few hundred bytes for each slice are dealt out, the reads come after that
    n = slices.count()
    whole = 0 if first_reads is not None else split_bytes
    dealt = placed.drop("newlines").repartition(max(tasks_of(n, whole), 1))
    return dealt.mapInArrow(_reads(lines_per_record, first_reads), READ_SCHEMA)


def with_sample(reads: DataFrame) -> DataFrame:
    """Adds ``sample_id`` and ``mate`` from the file name."""
    from readloom.functions import text as T

    return reads.withColumn("sample_id", T.fastq_sample(F.col("file"))).withColumn(
        "mate", T.fastq_mate(F.col("file")))
