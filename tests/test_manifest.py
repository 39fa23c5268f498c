"""Digests kept over runs, and distinct counts kept as sketches."""

import hashlib
import os

from pyspark.sql import functions as F

from readloom.operators import sketches as K
from readloom.sources import files


def states(df):
    return {os.path.basename(r.path): (r.state, r.md5) for r in df.collect()}


def md5(data):
    return hashlib.md5(data).hexdigest()


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    data, at = tmp_path / "data", str(tmp_path / "manifest")
    (data / "deep").mkdir(parents=True)
    (data / "a.txt").write_bytes(b"aaa")
    (data / "deep" / "b.txt").write_bytes(b"bbb")
    (data / "c.txt").write_bytes(b"ccc")
    assert files.read_manifest(spark, at).count() == 0
    run = lambda: states(files.update_manifest(spark, str(data), at))
    assert run() == {"a.txt": ("new", md5(b"aaa")), "b.txt": ("new", md5(b"bbb")), "c.txt": ("new", md5(b"ccc"))}
    # other bytes under the same size and time are not seen: so an unchanged file is not read
    before = os.stat(data / "a.txt")
    (data / "a.txt").write_bytes(b"xxx")
    os.utime(data / "a.txt", ns=(before.st_atime_ns, before.st_mtime_ns))
    # the same size at another time is
    (data / "c.txt").write_bytes(b"yyy")
    os.utime(data / "c.txt", (before.st_atime, before.st_mtime + 5))
    os.remove(data / "deep" / "b.txt")
    (data / "d.txt").write_bytes(b"ddd")
    assert run() == {"a.txt": ("unchanged", md5(b"aaa")), "b.txt": ("gone", md5(b"bbb")), "c.txt": ("changed", md5(b"yyy")), "d.txt": ("new", md5(b"ddd"))}
    assert {k: v[0] for k, v in run().items()} == {"a.txt": "unchanged", "c.txt": "unchanged", "d.txt": "unchanged"}
    assert files.read_manifest(spark, at).count() == 3


def test_files_are_dealt_by_size(spark):
    sizes = [1000, 900, 800, 700, 10, 9, 8, 7, 6, 5, 4, 3]
    df = spark.createDataFrame([(f"f{i}", s) for i, s in enumerate(sizes)], "path string, size bigint")
    got = files.dealt_by_size(df, 4).withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.sum("size"), F.max("size")).collect()
    assert len(got) == 4 and sorted(r[2] for r in got) == [700, 800, 900, 1000]
    assert files.dealt_by_size(df.limit(0), 4).count() == 0


def test_merged_sketches_stay_within_their_bounds(spark):
    df = spark.range(200_000).select((F.col("id") % 7).alias("project"), (F.col("id") % 3).alias("batch"), (F.col("id") * 31 % 90_007).alias("sample"),
                                     F.when(F.col("id") % 2 == 0, F.col("id")).alias("gene"))
    names = ["sample", "gene"]
    stored = K.distinct_sketches(df, ["project", "batch"], names)
    assert stored.count() == 21
    for groups in (["project"], ["batch"], []):
        exact = {tuple(r[g] for g in groups): r for r in df.groupBy(*groups).agg(*[F.countDistinct(c).alias(c) for c in names]).collect()}
        got = K.estimates(K.merged(stored, groups, names), names).collect()
        assert len(got) == len(exact)
        for r in got:
            want = exact[tuple(r[g] for g in groups)]
            for c in names:
                assert abs(r[c] - want[c]) <= 0.02 * want[c]
                assert r[f"{c}_low"] <= want[c] <= r[f"{c}_high"]


def test_sketches_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), ("b", "x")], "g string, v string")
    got = K.estimates(K.distinct_sketches(df, ["g"], ["v"]), ["v"]).collect()
    assert sorted((r.g, r.v) for r in got) == [("a", 0), ("b", 1)]
    assert K.estimates(K.merged(K.distinct_sketches(df.limit(0), ["g"], ["v"]), ["g"], ["v"]), ["v"]).count() == 0
