"""Block gzip: any cut of a file gives the reads of the plain file."""

import gzip
import io
import random

import pytest

from readloom.sinks.block_gzip import write_block_gzip
from readloom.sources import blocks as B
from readloom.sources.fastq import read_fastq


def blocked(data, sizes, level=6):
    """The data in members of the given sizes, round and round."""
    out, at, n = b"", 0, 0
    while at < len(data):
        out += B.member_of(data[at:at + sizes[n % len(sizes)]], level)
        at += sizes[n % len(sizes)]
        n += 1
    return out + B.LAST


def fastq(n, seed=1):
    r = random.Random(seed)
    return "".join(f"@r{i}\n{(s := ''.join(r.choice('ACGTN') for _ in range(r.randint(1, 90))))}\n+\n{'I' * len(s)}\n" for i in range(n)).encode()


def records(spark, path, **options):
    got = {}
    for r in read_fastq(spark, str(path), **options).orderBy("file", "read_no").collect():
        rows = got.setdefault(r.file.rsplit("/", 1)[1], [])
        assert r.read_no == len(rows)
        rows.append((r.header, r.seq, r.plus, r.qual))
    return got


def straight(data):
    lines = [x.decode("utf-8", "replace").rstrip("\r") for x in data.split(b"\n")]
    lines = lines[:-1] if data.endswith(b"\n") else lines
    lines += [""] * (-len(lines) % 4)
    return [tuple(lines[k:k + 4]) for k in range(0, len(lines), 4)]


@pytest.mark.parametrize("split", [50, 333, 1500, 1 << 20])
def test_any_cut_gives_the_plain_reads(spark, tmp_path, split):
    data = {"even": fastq(300, 1), "cut off": fastq(120, 2)[:-9], "blank lines": fastq(120, 3).replace(b"\n@r7", b"\n\n@r7"),
            "one": b"@a\nC\n+\nI\n", "no lines": b"", "damaged": fastq(100, 4).replace(b"+\n", b"", 5)}
    for n, (name, text) in enumerate(data.items()):
        # members that end with, before and after line ends; some hold a few bytes, some many records
        (tmp_path / f"{name}.fq.gz").write_bytes(blocked(text, [[97], [1, 500, 33], [4096], [64], [10], [700, 2]][n]))
        assert gzip.decompress((tmp_path / f"{name}.fq.gz").read_bytes()) == text
    want = {f"{name}.fq.gz": straight(text) for name, text in data.items() if text}
    assert records(spark, tmp_path, split_bytes=split) == want


def test_plain_and_block_gzip_side_by_side(spark, tmp_path):
    text = fastq(400, 5)
    (tmp_path / "plain.fastq.gz").write_bytes(gzip.compress(text))
    (tmp_path / "several.fastq.gz").write_bytes(gzip.compress(text[:3001]) + gzip.compress(text[3001:]))
    (tmp_path / "blocked.fastq.gz").write_bytes(blocked(text, [1000]))
    (tmp_path / "text.fastq").write_bytes(text)
    got = records(spark, tmp_path, split_bytes=700)
    assert set(map(len, got.values())) == {400} and len(got) == 4
    assert all(rows == straight(text) for rows in got.values())
    first = records(spark, tmp_path, split_bytes=700, first_reads=3)
    assert all(rows == straight(text)[:3] for rows in first.values()) and len(first) == 4


def test_a_block_file_is_many_tasks(spark, tmp_path):
    (tmp_path / "a.fastq.gz").write_bytes(blocked(fastq(5000, 6), [2000]))
    df = read_fastq(spark, str(tmp_path), split_bytes=20_000)
    assert df.rdd.getNumPartitions() > 3 and df.count() == 5000


def test_headers_in_the_text_are_no_members():
    # stored, so that the text stands in the file as it is
    fake = b"text" + B.member_of(b"fake")[:18] + b"more text"
    data = blocked(fake * 60, [len(fake) * 2 + 1], level=0)
    whole = io.BytesIO(data)
    starts = [at for at, _ in B.members(whole, 0)]
    assert b"".join(text for _, text in B.members(whole, 0)) == fake * 60
    for a in range(0, len(data), 7):
        for stop in (a + 40, len(data)):
            real = next((s for s in starts if a <= s < stop), None)
            assert B.first_member(whole, a, stop, len(data)) == real


def test_sizes_and_broken_chains():
    assert B.member_size(B.LAST) == len(B.LAST) and B.member_size(b"") == B.member_size(gzip.compress(b"x")) == 0
    more = B.MAGIC + b"\0" * 6 + b"\x0c\0" + b"XY\x02\0zz" + b"BC\x02\0\x10\0"
    assert B.member_size(more) == 17
    with pytest.raises(ValueError, match="split_bytes=0"):
        list(B.members(io.BytesIO(B.member_of(b"a\n") + gzip.compress(b"b\n")), 0))


def test_written_files_are_valid_and_split(spark, tmp_path):
    r = random.Random(2)
    values = [None, "", "né\nü", "x" * 200_000, *("".join(r.choice("ab\n") for _ in range(50)) for _ in range(3000))]
    df = spark.createDataFrame([(v,) for v in values], "value string").repartition(3)
    target = tmp_path / "out"
    for _ in range(2):  # the second time replaces the first
        write_block_gzip(df, str(target), ".log.gz")
        files = sorted(target.iterdir())
        assert len(files) == 3 and all(f.name.startswith("part-") and f.name.endswith(".log.gz") for f in files)
        got = b"".join(gzip.decompress(f.read_bytes()) for f in files)
        assert sorted(got.split(b"\n")) == sorted("\n".join([*(v or "" for v in values), ""]).encode().split(b"\n"))
        assert all(len(text) <= B.MOST for f in files for _, text in B.members(open(f, "rb"), 0))
    with pytest.raises(Exception, match="one text column"):
        write_block_gzip(spark.range(3).selectExpr("id", "id b"), str(target))
