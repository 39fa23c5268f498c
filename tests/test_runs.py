"""Logs, run state, artifacts, streams and sinks."""

import gzip
import json
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from readloom.operators import artifacts as A
from readloom.operators import runs as L
from readloom.sinks import writers as K
from readloom.streaming import progress as S

LOG = ["rule trim:", "3 of 10 steps (30%) done", "Finished job 4.", "localrule all:", "Finished job 5. Finished job 6.",
       "Error in rule x:", "5 of 10 steps (50%) done", "tail"]


def lines(spark, texts):
    data = [(f, i, x) for f, t in texts.items() for i, x in enumerate(t)]
    return spark.createDataFrame(data, "file string, pos int, line string")


def test_progress(spark, rows):
    df = lines(spark, {"a": LOG, "b": ["10 of 10 steps (100%) done"], "c": ["Exiting because a job execution failed."], "d": ["x"]})
    got = {r.file: r for r in L.workflow_progress(df).collect()}
    a = got["a"]
    assert (a.jobs_done, a.jobs_total, a.progress_pct, a.current_rule, a.finished_count, a.n_rule_errors) == (5, 10, 50.0, "all", 3, 1)
    assert got["b"].is_complete and got["c"].fatal_error and got["d"].progress_pct is None
    assert rows(L.rule_errors(df)) == [("a", 5, "x")]


def test_tail_and_errors(spark):
    df = lines(spark, {"a": [f"l{i}" for i in range(120)], "b": ["One ERROR here"]})
    tail = L.log_tail(df, 50).where("file = 'a'").orderBy("pos").collect()
    assert [r.line for r in tail] == [f"l{i}" for i in range(70, 120)]
    assert {r.file: (r.lines_total, r.has_error) for r in L.log_errors(df).collect()} == {"a": (120, False), "b": (1, True)}


@pytest.mark.parametrize("fatal,complete,pct,log,want", [
    (True, True, 100.0, True, "error"), (False, False, 99.5, True, "completed"), (False, False, 0.0, False, "not_started"),
    (False, False, 0.0, True, "running"), (None, None, 12.0, False, "running")])
def test_run_status(spark, fatal, complete, pct, log, want):
    df = spark.createDataFrame([(fatal, complete, pct, log)], "f boolean, c boolean, p double, l boolean")
    assert df.select(L.run_status(df.f, df.c, df.p, df.l)).first()[0] == want


def test_stages(spark, rows):
    samples = spark.createDataFrame([("r", 2)], "run string, n_samples bigint")
    done = spark.createDataFrame([("r", "cutadapt", 2), ("r", "fastqc_raw", 9), ("r", "star_align", 1)], "run string, rule string, n bigint")
    stages = L.stage_progress(done, samples)
    assert {r.rule: (r.done, r.expected) for r in stages.collect()} == {
        "cutadapt": (2, 2), "fastqc_raw": (4, 4), "star_align": (1, 2), "featurecounts_quant": (0, 1), "multiqc": (0, 1), "generate_manifest": (0, 2)}
    assert rows(L.run_progress(stages)) == [("r", 58.3)]
    assert rows(L.current_stage(done)) == [("r", "star_align")]
    runs = spark.createDataFrame([("r",), ("new",)], "run string")
    steps = spark.createDataFrame([("r", "fastq_detected"), ("r", "config_created"), ("r", "pipeline_done"), ("r", "other")], "run string, step string")
    assert rows(L.stage_checklist(steps, runs)) == [("new", 0, 8, "fastq_detected"), ("r", 3, 8, "sample_sheet_created")]
    assert L.step_rows(steps, runs).where("done").count() == 3


def test_audit(spark, rows):
    expected = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "artifact string, critical boolean")
    listing = spark.createDataFrame([("a", 5), ("a", 6)], "artifact string, size bigint")
    audited = A.artifact_audit(expected, listing, ["artifact"])
    assert rows(audited, "artifact", "state") == [("a", "present"), ("b", "critical_missing"), ("c", "optional_missing")]
    assert rows(A.audit_summary(audited)) == [(1, 1, 1, 3, 33)]
    assert A.audit_summary(audited.where("false")).first().success_rate is None


def events(spark):
    data = [(i, f"r{i % 3}", "error" if i % 11 == 0 else "step", f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", float(i), i) for i in range(300)]
    df = spark.createDataFrame(data, "event_id int, run string, rule string, t string, value double, k int")
    return df.withColumn("ts", F.to_timestamp("t")).drop("t")


def test_streams_equal_batch(spark, tmp_path, rows):
    batch = events(spark).withColumn("is_error", F.col("rule") == "error").withColumn("is_complete", F.lit(False))
    # two files in two batches
    batch.where("event_id < 150").coalesce(1).write.parquet(str(tmp_path / "in"))
    batch.where("event_id >= 150").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assert rows(S.drain(S.run_latest(stream))) == rows(S.run_latest(batch))
    assert rows(S.drain(S.stage_windows(stream, "1 hour"))) == rows(S.stage_windows(batch, "1 hour"))
    closed = S.drain(S.session_windows(stream, "5 minutes", "1 minute"), "append")
    every = rows(S.session_windows(batch, "5 minutes"))
    assert set(rows(closed)) <= set(every)


def test_closed_windows_are_emitted(spark, tmp_path, rows):
    batch = events(spark)
    batch.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    got = rows(S.drain(S.stage_windows(stream, "1 hour", watermark="1 minute"), "append"))
    # the last window stays open
    assert got == [r for r in rows(S.stage_windows(batch, "1 hour")) if r[0].hour < 4]


def test_late_rows_are_counted(spark, tmp_path, rows):
    batch = events(spark)
    # files are taken in order of their time; a row is late against the watermark of the batch before
    for part in ("event_id between 150 and 249", "event_id >= 250", "event_id < 60"):
        batch.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    late = []
    got = S.drain(S.stage_windows(stream, "1 hour", watermark="1 minute"), "append",
                  on_end=lambda q: late.append(S.late_rows(q)))
    # rows are combined per window and rule before they meet the state
    assert late[0] == 2
    assert min(r[0].hour for r in rows(got)) >= 2


def test_stream_log_errors(spark, tmp_path, rows):
    (tmp_path / "a.log").write_text("fine\nOOM killer\n")
    (tmp_path / "b.log").write_text("it failed\n")
    got = S.drain(S.error_lines(S.stream_lines(spark, str(tmp_path))), "append")
    assert sorted(r.line for r in got.collect()) == ["OOM killer", "it failed"]


def test_stalled(spark, tmp_path, rows):
    data = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:05:00"), ("a", "2024-01-01 02:00:00"),
            ("b", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:30:00"), ("z", "2024-01-01 05:00:00")]
    df = spark.createDataFrame(data, "run string, t string").select("run", F.to_timestamp("t").alias("ts"))
    assert [(r.run, r.gap_micros) for r in S.stalled_batch(df, 30).collect()] == [("a", 115 * 60 * 10**6)]
    df.where("ts < '2024-01-01 01:00:00'").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    df.where("ts >= '2024-01-01 01:00:00'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = S.drain(S.stalled_stream(stream, 30, "1 minute"), "append", "stalled")
    # both early runs fall silent for more than half an hour before the last event
    assert ("a", "b") == tuple(sorted({r.run for r in got.collect()}))[:2]


def test_sinks(spark, tmp_path, rows):
    counts = spark.createDataFrame([("g1", "a", 1), ("g2", "b", 2)], "gene_id string, sample_id string, count bigint")
    K.write_clean_matrix(counts, ["a", "b"], str(tmp_path / "m"), files=1)
    text = [p.read_text() for p in (tmp_path / "m").glob("*.csv")]
    assert sorted(text[0].split()) == ["Geneid,a,b", "g1,1,0", "g2,0,2"]
    reads = spark.createDataFrame([("@r", "AC", "+", "II")], "header string, seq string, plus string, qual string")
    K.write_fastq(reads, str(tmp_path / "f"))
    got = "".join(gzip.open(p, "rt").read() for p in (tmp_path / "f").glob("*.gz"))
    assert got == "@r\nAC\n+\nII\n"
    docs = spark.createDataFrame([("a", "PASS"), ("b", "FAIL")], "sample_id string, status string")
    K.write_documents(docs, str(tmp_path / "d"), ["sample_id"])
    got = [json.loads(p.read_text()) for p in (tmp_path / "d" / "sample_id=a").glob("*.json")]
    assert got == [{"status": "PASS"}]
    for kind in ("tsv", "csv", "json"):
        K.write_sheet(docs, str(tmp_path / kind), kind)
    assert rows(spark.read.option("sep", "\t").option("header", "true").csv(str(tmp_path / "tsv"))) == rows(docs)
    K.write_findings(docs, str(tmp_path / "p"), ["status"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def silences(data, timeout, mark):
    """Every time of a run with nothing in the timeout after it, as far as the mark tells."""
    out, runs = [], {}
    for run, t in data:
        runs.setdefault(run, set()).add(t)
    for run, times in runs.items():
        times = sorted(times)
        for a, b in zip(times, [*times[1:], None]):
            if a + timeout < mark and (b is None or b - a > timeout):
                out.append((run, a))
    return sorted(out)


@pytest.mark.parametrize("cuts", [[], [500], [100, 350, 351, 800]])
def test_stalled_stream_equals_batch_in_any_order(spark, tmp_path, cuts):
    rnd = random.Random(len(cuts))
    # seconds; within a go events come in any order, and overlap the next go by less than the watermark
    data = sorted({(f"r{rnd.randint(0, 9)}", rnd.choice([rnd.randint(0, 40_000), 1800 * rnd.randint(0, 20)])) for _ in range(1000)}, key=lambda x: x[1] + rnd.randint(0, 500))
    parts = [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)])]
    timed = spark.createDataFrame(data, "run string, t bigint").select("run", F.timestamp_seconds("t").alias("ts"))
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(timed.schema).parquet(str(tmp_path / "in"))
    for part in parts:
        rnd.shuffle(part)
        spark.createDataFrame(part, "run string, t bigint").select("run", F.timestamp_seconds("t").alias("ts")).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        # each go is a query started anew on the state of the last
        with S.rocks(spark):
            got = S.drain(S.stalled_stream(stream, 30, "10 minutes"), "append", folder=str(tmp_path / "at"))
    told = sorted((r.run, r.t) for r in got.select("run", F.unix_seconds("last_ts").alias("t")).collect())
    assert told == silences(data, 1800, max(t for _, t in data) - 600)
    # the batch form knows every silence that ended; the stream those that the watermark has passed
    closed = {(r.run, r.t) for r in S.stalled_batch(timed, 30).select("run", F.unix_seconds(F.col("last_ts").cast("timestamp")).alias("t")).collect()}
    assert {(r, t) for r, t in closed if t + 1800 < max(x for _, x in data) - 600} <= set(told) and all(t == max(x for r, x in data if r == run) for run, t in set(told) - closed)


def test_stalls_cost_a_few_calls_a_run():
    """However many slots a run has, a batch reads its state once, writes it once and sets one timer."""
    calls, timers = [], []

    class State:
        value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            calls.append("clear")
            self.value = None

    class Handle:
        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, ms):
            timers.append(ms)

    class Mark:
        def __init__(self, ms):
            self.ms = ms

        def getCurrentWatermarkInMs(self):
            return self.ms

    detector = S.StallDetector(30)
    detector.init(Handle())
    at = [3600 * n for n in range(500)]
    frames = (pd.DataFrame({"ts": pd.to_datetime(part, unit="s")}) for part in (at[::2], at[1::2]))
    assert list(detector.handleInputRows(("r",), frames, None)) == []
    assert (calls, timers) == (["get", "update"], [1800_001])
    found = pd.concat(detector.handleExpiredTimer(("r",), Mark(3600_000 * 300), None))
    # events half an hour and more before the mark are told, and the timer goes on with the next
    assert [t.timestamp() for t in found["last_ts"]] == at[:300] and set(found["run"]) == {"r"}
    assert (len(calls), timers[1:]) == (4, [3600_000 * 300 + 1800_001])
    found = pd.concat(detector.handleExpiredTimer(("r",), Mark(3600_000 * 600), None))
    assert [t.timestamp() for t in found["last_ts"]] == at[300:] and calls[-1] == "clear"


def test_stalled_stream_with_missing_times(spark, tmp_path):
    """A run's events without a time are told once, without one."""
    data = [("a", 10), ("a", None), ("a", None), ("a", 3610), ("b", None), ("z", 90_000)]
    spark.createDataFrame(data, "run string, t bigint").select("run", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "in"))
    with S.rocks(spark):
        got = S.drain(S.stalled_stream(spark.readStream.schema("run string, ts timestamp").parquet(str(tmp_path / "in")), 30), "append", "stalled")
    assert sorted(((r.run, r.t) for r in got.select("run", F.unix_seconds("last_ts").alias("t")).collect()), key=repr) == [
        ("a", 10), ("a", 3610), ("a", None), ("b", None)]


def test_late_rows_as_data_over_restarts(spark, tmp_path):
    folder = str(tmp_path / "at")
    goes = [[100, 200, 3700.0015], [3000, 2999, 3099, 3100.001, 5000], [], [4399, 4400, 4401, 4400.0, 9999], [9399.5]]
    schema = spark.createDataFrame([], "ts timestamp, rule string").schema
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    for go in goes:
        spark.createDataFrame([(t,) for t in map(float, go)], "t double").select(
            F.timestamp_micros((F.col("t") * 1_000_000).cast("bigint")).alias("ts"), F.lit("x").alias("rule")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = S.count_late(stream, folder, "10 minutes")
    rows = [(r.n, r.n_late) for r in got.orderBy("batch").collect() if r.n]
    # marks: none, 3700.001 - 600 = 3100.001, 5000 - 600 = 4400, 9999 - 600 = 9399
    assert rows == [(3, 0), (5, 4), (5, 3), (1, 0)]
    # a batch that is run again replaces its row
    before = sorted(map(tuple, got.collect()), key=repr)
    assert sorted(map(tuple, S.count_late(stream, folder, "10 minutes").collect()), key=repr) == before


def test_late_rows_follow_sparks_own_rule(spark, tmp_path):
    batch = events(spark).withColumn("rule", F.concat("rule", F.col("event_id").cast("string")))  # nothing is combined before the state
    for part in ("event_id between 150 and 249", "event_id >= 250", "event_id < 60"):
        batch.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
        own = []
        S.drain(S.stage_windows(stream, "1 hour", watermark="1 minute"), "append", folder=str(tmp_path / "own"), on_end=lambda q: own.append(S.late_rows(q)))
        got = S.count_late(stream, str(tmp_path / "late"), "1 minute", "1 hour").orderBy("batch").collect()[-1]
        assert got.n_late == own[0]
    assert got.n_late == 60
