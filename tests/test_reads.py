"""FASTQ source, read checks, profile and trimming."""

import gzip
import io
import random
from unittest import mock

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from readloom.operators import artifacts as A
from readloom.operators import fastqc_checks as E
from readloom.operators import reads as R
from readloom.sources import fastq as Q
from readloom.sources.fastq import read_fastq, with_sample


def fastq(n, seed=1, length=40):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        size = rnd.randint(1, length)
        seq = "".join(rnd.choice("ACGTN") for _ in range(size))
        # '@' (score 31) is common, so quality lines start with it too
        qual = "".join(rnd.choice("@I+5!") for _ in range(size))
        out.append(f"@r{i}\n{seq}\n+\n{qual}\n")
    return "".join(out)


@pytest.mark.parametrize("split", [1777, 5000, 1 << 20])
def test_split_reads_lose_nothing(spark, tmp_path, split):
    text = fastq(700)
    (tmp_path / "a.fastq").write_text(text)
    got = read_fastq(spark, str(tmp_path), split_bytes=split).orderBy("read_no").collect()
    assert [r.read_no for r in got] == list(range(700))
    assert "".join(f"{r.header}\n{r.seq}\n{r.plus}\n{r.qual}\n" for r in got) == text


def test_broken_records_survive_splits(spark, tmp_path):
    records = [f"@r{i}\nACGT\n+\nIIII\n" if i % 3 else f"#r{i}\nACGT\n-\nIII\n" for i in range(300)]
    (tmp_path / "a.fastq").write_text("".join(records))
    got = read_fastq(spark, str(tmp_path), split_bytes=600)
    assert got.count() == 300
    assert got.where("header like '#%'").count() == 100
    bad = R.validate_reads(got).collect()
    assert [(r.error, r.n_reads, r.first_read, r.first_header) for r in bad] == [("header", 100, 0, "#r0")]


def straight(data, lines=4):
    """Records as one reader from the start of the file sees them."""
    out, at = [], io.BytesIO(data)
    while first := at.readline():
        rest = [at.readline() for _ in range(lines - 1)]
        out.append(tuple(x.decode("utf-8", "replace").rstrip("\r\n") for x in [first, *rest]))
    return out


DAMAGED = {
    "line lost": lambda x: x.replace(b"+\n", b"", 1),
    "blank line": lambda x: x[:200] + x[200:].replace(b"\n", b"\n\n", 1),
    "no plus": lambda x: x.replace(b"\n+\n", b"\n-\n", 3),
    "cut off": lambda x: x[:-9],
    "no end": lambda x: x[:-1],
    "carriage returns": lambda x: x.replace(b"\n", b"\r\n"),
    "bytes": lambda x: x.replace(b"@r3", b"@\xff\xe2\x82"),
    "blanks at the end": lambda x: x + b"\n\n",
    "whole": lambda x: x,
}


def test_records_do_not_depend_on_cuts(spark, tmp_path):
    folder = tmp_path / "a b%20#c"
    folder.mkdir()
    want = {}
    for kind, damage in DAMAGED.items():
        data = damage(fastq(60, 3).encode())
        want[f"{kind}.fastq"] = want[f"{kind}.fq.gz"] = straight(data)
        (folder / f"{kind}.fastq").write_bytes(data)
        with gzip.open(folder / f"{kind}.fq.gz", "wb") as f:
            f.write(data)
    for split in (400, 1 << 20):
        got = {}
        for r in read_fastq(spark, str(folder), split_bytes=split).orderBy("file", "read_no").collect():
            rows = got.setdefault(r.file.rsplit("/", 1)[1], [])
            assert r.read_no == len(rows)
            rows.append((r.header, r.seq, r.plus, r.qual))
        assert got == want
    first = read_fastq(spark, f"file:{folder}", first_reads=7)
    assert {r.file.rsplit("/", 1)[1]: r["max(read_no)"] for r in first.groupBy("file").agg({"read_no": "max"}).collect()} == dict.fromkeys(want, 6)


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=120).map(lambda b: bytes(b"\n@+A\r"[x % 5] for x in b)), st.integers(1, 40), st.sampled_from([4, 6]), st.integers(1, 50))
def test_slices_cover_any_file(tmp_path_factory, data, split, lines, block):
    path = str(tmp_path_factory.mktemp("s") / "x.fastq")
    with open(path, "wb") as f:
        f.write(data)
    reader = Q.SliceReader({"path": path, "split_bytes": str(split)})
    got, line = [], 0
    for n, part in enumerate(reader.partitions()):
        newlines = next(reader.read(part))[-1]
        with open(path, "rb") as f, mock.patch.object(Q, "BLOCK", block):
            for record, whole in Q._blocks(f, part.start, part.stop, line + 1 if n else 0, lines):
                assert record == len(got)
                columns = [c.to_pylist() for c in Q._columns(whole, lines)]
                got += list(zip(*columns))
        line += newlines
    want = straight(data, lines)
    if lines == 6:
        want = [(a, b.strip() + c.strip(), d, e.strip() + f.strip()) for a, b, c, d, e, f in want]
    assert got == want


def test_many_small_ranges_share_tasks(spark, tmp_path):
    path = tmp_path / "x.fastq"
    path.write_text(fastq(500))
    size = path.stat().st_size
    parts = Q.SliceReader({"path": str(path), "split_bytes": "10"}).partitions()
    assert len(parts) == Q.TASKS < size // 10
    whole = [row for part in parts for row in Q.SliceReader({"path": str(path)}).read(part)]
    assert len(whole) == -(-size // 10) and sum(row[-1] for row in whole) == 4 * 500 - (not fastq(500).endswith("\n"))
    got = read_fastq(spark, str(path), split_bytes=10)
    assert got.rdd.getNumPartitions() == Q.TASKS
    want = read_fastq(spark, str(path))
    assert got.count() == 500 and got.exceptAll(want).isEmpty()
    # ranges of a full task's size stay alone
    assert Q.tasks_of(2000, Q.TASK_BYTES) == 2000 and Q.tasks_of(2000, Q.TASK_BYTES // 2) == 1000 and Q.tasks_of(300, 1) == 300


def test_gzip_wrapped_and_empty(spark, tmp_path, rows):
    with gzip.open(tmp_path / "s_R1.fq.gz", "wt") as f:
        f.write(fastq(50))
    (tmp_path / "empty.fastq").write_text("")
    got = with_sample(read_fastq(spark, str(tmp_path)))
    assert got.count() == 50
    assert rows(got.select("sample_id", "mate").distinct()) == [("s", "R1")]
    wrapped = tmp_path / "w"
    wrapped.mkdir()
    (wrapped / "w.fastq").write_text("@a\nACG\nT\n+\nII\nII\n@b\nA\nC\n+\nI\nI\n")
    got = read_fastq(spark, str(wrapped), lines_per_record=6)
    assert rows(got, "header", "seq", "plus", "qual") == [("@a", "ACGT", "+", "IIII"), ("@b", "AC", "+", "II")]
    lines = spark.createDataFrame(
        [("w", i, x) for i, x in enumerate(["@a", "ACG", "T", "+", "II", "II"])], "file string, line_no int, line string")
    assert rows(R.repair_wrapped_lines(lines)) == [("w", 0, "@a", "ACGT", "+", "IIII")]


def test_validate_and_find(spark, rows):
    reads = spark.createDataFrame([
        ("f", 0, "@x:1", "ACGT", "+", "IIII"), ("f", 1, "x:2", "ACGT", "+", "IIII"),
        ("f", 2, "@x:3", "ACGT", "-", "IIII"), ("f", 3, "@x:4", "ACG", "+", "IIII"),
        ("f", 4, "@x:40", "AC", "+", "I")],
        "file string, read_no bigint, header string, seq string, plus string, qual string")
    assert rows(R.validate_reads(reads)) == [
        ("f", "header", 1, 1, "x:2"), ("f", "length", 2, 3, "@x:4"), ("f", "plus", 1, 2, "@x:3")]
    assert rows(R.find_reads(reads, ["x:4", "x:9"])) == [("x:4", "f", 3, "@x:4", 3, 4, True)]
    assert R.subset_reads(reads, 2).count() == 2


def slow_cut(quals, cutoff):
    total = best = 0
    keep = len(quals)
    for i in range(len(quals) - 1, -1, -1):
        total += cutoff - quals[i]
        if total < 0:
            break
        if total > best:
            best, keep = total, i
    return keep


def slow_trim(seq, quals, adapter, cutoff, overlap=3):
    keep = slow_cut(quals, cutoff)
    seq = seq[:keep]
    at = seq.find(adapter)
    cuts = [at] if at >= 0 else []
    for k in range(min(len(adapter) - 1, len(seq)), overlap - 1, -1):
        if seq.endswith(adapter[:k]):
            cuts.append(len(seq) - k)
            break
    return min(cuts, default=len(seq))


def test_trim_matches_brute_force(spark):
    rnd = random.Random(7)
    adapter = "ACGTT"
    data = []
    for i in range(400):
        size = rnd.randint(0, 30)
        seq = "".join(rnd.choice("ACGT") for _ in range(size))
        if i % 3 == 0:
            seq = seq[:20] + adapter[: rnd.randint(1, 5)]
        data.append((i, "s", seq, "".join(chr(33 + rnd.randint(0, 41)) for _ in seq)))
    df = spark.createDataFrame(data, "i int, sample_id string, seq1 string, qual1 string")
    df = df.withColumn("seq2", F.lit(None).cast("string")).withColumn("qual2", F.lit(None).cast("string"))
    got = {r.i: r.m1.seq for r in R.trim_pairs(df, adapter, adapter, 20, 5).collect()}
    for i, _, seq, qual in data:
        assert got[i] == seq[: slow_trim(seq, [ord(c) - 33 for c in qual], adapter, 20)], (seq, qual)
    total = R.trim_counters(R.trim_pairs(df, adapter, adapter, 20, 5)).first()
    assert total.total_pairs == 400 and total.too_short + total.passed == 400


def test_pair_is_dropped_when_one_mate_is_short(spark):
    df = spark.createDataFrame(
        [("s", "A" * 30, "I" * 30, "C" * 30, "I" * 30), ("s", "A" * 30, "I" * 30, "C" * 30, "!" * 30)],
        "sample_id string, seq1 string, qual1 string, seq2 string, qual2 string")
    total = R.trim_counters(R.trim_pairs(df)).first()
    assert (total.total_pairs, total.too_short, total.passed, total.total_bp) == (2, 1, 1, 120)


def test_histogram_matches_brute_force(spark, rows):
    rnd = random.Random(3)
    data = []
    for i in range(200):
        size = rnd.randint(0, 25)
        data.append((rnd.choice(["a", "b", None]), "".join(rnd.choice("ACGTNn") for _ in range(max(size - rnd.randint(0, 2), 0))),
                     "".join(chr(33 + rnd.randint(0, 60)) for _ in range(size))))
    want = {}
    for s, seq, qual in data:
        for p, c in enumerate(qual):
            key = (s or "unknown", p + 1, ord(c) - 33)
            n, m = want.get(key, (0, 0))
            want[key] = (n + 1, m + (p < len(seq) and seq[p] in "Nn"))
    df = spark.createDataFrame(data, "sample_id string, seq string, qual string")
    for parts in (1, 5):
        got = R.base_histogram(df.repartition(parts))
        assert rows(got) == sorted(((*k, *v) for k, v in want.items()), key=repr)
    stats = {r.sample_id: r.total_sequences for r in R.basic_statistics(df).collect()}
    assert sum(stats.values()) == 200


def test_long_reads_are_counted_in_pieces():
    import pyarrow as pa

    texts = ["I" * n for n in (3, 0, 10, 1, 25, 0)]
    parts = list(R._pieces(pa.array(texts), limit=10))
    assert [x for p in parts for x in p.to_pylist()] == texts
    assert all(sum(map(len, p.to_pylist())) <= 10 or len([x for x in p.to_pylist() if x]) == 1 for p in parts)
    whole = R._kept_lengths(pa.array(texts), 50)
    assert pa.concat_arrays([R._kept_lengths(p, 50) for p in parts]).equals(whole)


def test_profile_gives_the_verdict_of_a_report(spark):
    good = [("s", "ACGT" * 10, "I" * 40)] * 30 + [("t", "ACGN" * 10, "#" * 40)] * 30
    df = spark.createDataFrame(good, "sample_id string, seq string, qual string")
    rows = R.profile_rows(df)
    out = {r.sample_id: r.status for r in E.report_status(rows, df.select("sample_id").distinct(), min_total=10).collect()}
    assert out == {"s": "PASS", "t": "FAIL"}
    f = E.report_findings(rows, min_total=10).where("sample_id = 't'")
    assert {r.code for r in f.collect()} == {"base_quality", "n_content", "q30_pct"}


def test_adapter_content(spark, rows):
    df = spark.createDataFrame(
        [("s", "AAAGGG", "IIIIII"), ("s", "GGGAAA", "IIIIII"), ("s", "CCCCCC", "IIIIII"), ("s", "CTTTCC", "IIIIII")],
        "sample_id string, seq string, qual string")
    assert rows(R.adapter_content(df, ["AAA", "TTT"])) == [("s", 1, 25.0), ("s", 2, 25.0), ("s", 4, 50.0)]


NAMES = ["d/a_1.fastq.gz", "d/a_R2.fq", "d/b_R1_001.fastq.gz", "d/c-2.fq.gz", "d/single.fastq", "e/a_1.fastq.gz", "d/x.txt", "d/U_1.FASTQ.GZ"]


def test_pairing(spark, rows):
    df = spark.createDataFrame([(n, i + 1) for i, n in enumerate(NAMES)], "path string, size bigint")
    got = {r.sample_id: (r.r1, r.r2, r.n_conflicts) for r in A.pair_files(df).collect()}
    assert got == {
        "a": ("e/a_1.fastq.gz", "d/a_R2.fq", 1), "b": ("d/b_R1_001.fastq.gz", None, 0),
        "c": (None, "d/c-2.fq.gz", 0), "single": ("d/single.fastq", None, 0), "U": ("d/U_1.FASTQ.GZ", None, 0)}
    assert A.read_type(A.pair_files(df)).first().read_type == "paired-end"
    s = A.dataset_summary(df).first()
    assert (s.n_files, s.n_folders, s.n_samples, s.n_conflicts, s.read_type) == (7, 2, 5, 1, "paired-end")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 41), max_size=40), st.integers(0, 30))
def test_quality_cut_never_keeps_a_bad_tail(quals, cutoff):
    # the brute force itself: the base before the cut is good, or nothing is left
    keep = slow_cut(quals, cutoff)
    assert 0 <= keep <= len(quals)
    if 0 < keep < len(quals):
        assert quals[keep] <= cutoff
