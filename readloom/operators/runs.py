"""Run logs and run state, from lines and artifact counts.

``lines(file, pos, line)``: a log file may be most of the data, so everything
per file is an aggregate that is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom import constants as K
from readloom.functions.ranking import first_rows
from readloom.functions.stats import share


def has_keyword(line: Column, keywords: Sequence[str] = tuple(K.ERROR_WORDS)) -> Column:
    folded, out = F.lower(line), F.lit(False)
    for word in keywords:
        out = out | folded.contains(word.lower())
    return out


def log_errors(lines: DataFrame, keywords: Sequence[str] = tuple(K.ERROR_WORDS)) -> DataFrame:
    """Per file: line count and whether any line holds a keyword."""
    return lines.groupBy("file").agg(
        F.count("*").alias("lines_total"),
        F.bool_or(has_keyword(F.col("line"), keywords)).alias("has_error"))


def log_tail(lines: DataFrame, n: int = 50) -> DataFrame:
    """The last ``n`` lines of every file; ``rank`` 1 is the last line."""
    return first_rows(lines, ["file"], [F.desc("pos")], n)


# Line shapes of the workflow log.
STEPS = r"(\d+) of (\d+) steps \([\d.]+%\) done"
ALL_STEPS = r"\d+ of \d+ steps \(100%\) done"
RULE = r"^(?:local)?rule (\w+):$"
FINISHED = r"Finished job \d+\."
RULE_ERROR = r"Error in rule (\w+):"
FATAL = "Exiting because a job execution failed"
COMPLETE = "Complete log:"


def workflow_progress(lines: DataFrame) -> DataFrame:
    """Per log: last progress, last rule, finished jobs, failed rules, end flags."""
    line, pos = F.col("line"), F.col("pos")
    done = F.element_at(F.regexp_extract_all(line, F.lit(STEPS), F.lit(1)), -1).cast("bigint")
    total = F.element_at(F.regexp_extract_all(line, F.lit(STEPS), F.lit(2)), -1).cast("bigint")
    # most lines are none of these: plain searches keep them from the patterns
    has_steps = line.contains(" steps (") & line.rlike(STEPS)
    is_rule = line.contains("rule ") & line.rlike(RULE)

    def occurrences(text: str, pattern: str) -> Column:
        return F.sum(F.when(line.contains(text), F.regexp_count(line, F.lit(pattern))).otherwise(0)).cast("bigint")

    step = F.when(has_steps, F.struct(done.alias("done"), total.alias("total")))
    out = lines.groupBy("file").agg(
        F.max_by(step, F.when(has_steps, pos)).alias("s"),
        F.max_by(F.when(is_rule, F.regexp_extract(line, RULE, 1)), F.when(is_rule, pos))
        .alias("current_rule"),
        occurrences("Finished job ", FINISHED).alias("finished_count"),
        occurrences("Error in rule ", RULE_ERROR).alias("n_rule_errors"),
        F.bool_or(line.contains(FATAL)).alias("fatal_error"),
        F.bool_or(line.contains(COMPLETE) | (line.contains("(100%)") & line.rlike(ALL_STEPS)))
        .alias("is_complete"),
    )
    pct = F.when(F.col("s").isNotNull(), F.round(share(F.col("s.done"), F.col("s.total")), 1))
    return out.select(
        "file", F.col("s.done").alias("jobs_done"), F.col("s.total").alias("jobs_total"),
        pct.alias("progress_pct"), "current_rule", "finished_count", "n_rule_errors",
        "fatal_error", "is_complete")


def rule_errors(lines: DataFrame) -> DataFrame:
    """``(file, pos, rule)`` of every failed rule."""
    found = F.explode(F.regexp_extract_all("line", F.lit(RULE_ERROR), F.lit(1))).alias("rule")
    return lines.where(F.col("line").contains("Error in rule ")).select("file", "pos", found)


# How many outputs a rule makes per sample; None is one per run.
EXPECTED_PER_SAMPLE = {
    "cutadapt": 1, "fastqc_raw": 2, "star_align": 1, "featurecounts_quant": None,
    "multiqc": None, "generate_manifest": 1,
}


def stage_progress(
    done: DataFrame, samples: DataFrame,
    expected: Mapping[str, int | None] | None = None,
) -> DataFrame:
    """``(run, rule, done, expected)``, done capped at expected.

    ``done(run, rule, n)`` counts artifacts, ``samples(run, n_samples)``.
    """
    expected = expected or EXPECTED_PER_SAMPLE
    n = F.col("n_samples")
    stages = F.array(*[
        F.struct(F.lit(rule).alias("rule"),
                 (F.lit(1) if per is None else n * per).cast("bigint").alias("expected"))
        for rule, per in expected.items()])
    wanted = samples.select("run", F.explode(stages).alias("s")).select("run", "s.*")
    counted = done.groupBy("run", "rule").agg(F.sum("n").cast("bigint").alias("n"))
    return wanted.join(counted, ["run", "rule"], "left").select(
        "run", "rule", F.least(F.coalesce("n", F.lit(0)), "expected").alias("done"), "expected")


def run_progress(stages: DataFrame, logs: DataFrame | None = None) -> DataFrame:
    """Percent done per run; a percentage from the log wins over counted files."""
    out = stages.groupBy("run").agg(
        F.round(share(F.sum("done"), F.sum("expected")), 1).alias("counted_pct"))
    if logs is None:
        return out.withColumnRenamed("counted_pct", "progress_pct")
    log = logs.select(F.col("file").alias("run"), F.col("progress_pct").alias("log_pct"))
    return out.join(log, "run", "left").select(
        "run", F.coalesce("log_pct", "counted_pct").alias("progress_pct"))


def current_stage(
    done: DataFrame, order: Sequence[str] = tuple(K.RUN_STAGES), last: str | None = "multiqc",
    logs: DataFrame | None = None,
) -> DataFrame:
    """Furthest rule with output per run; the last rule means ``completed``.

    ``logs`` (of ``workflow_progress``): their rule stands in where a run has no
    output, a finished log means ``completed``, and runs that have only a log are listed too.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in order]), F.col("rule"))
    reached = F.when((F.col("n") > 0) & (rank > 0), rank)
    best = done.groupBy("run").agg(F.max(reached).cast("int").alias("rank"))
    name = F.when(F.col("rank").isNull(), "not_started").otherwise(
        F.element_at(F.array(*[F.lit(r) for r in order]), F.col("rank")))
    if last:
        name = F.when(name == last, "completed").otherwise(name)
    if logs is None:
        return best.select("run", name.alias("current_stage"))
    log = logs.select(F.col("file").alias("run"), "current_rule", "is_complete")
    stage = F.when(F.coalesce("is_complete", F.lit(False)), "completed").when(
        F.col("rank").isNull(), F.coalesce("current_rule", F.lit("not_started"))).otherwise(name)
    return best.join(log, "run", "full").select("run", stage.alias("current_stage"))


def de_run_status(
    fatal: Column, n_rule_errors: Column, complete: Column, running: Column
) -> Column:
    """Status of a differential-expression run: failed, completed, running.

    Any failed rule is ``failed``, and so is a run that neither ended nor goes on.
    """
    no = F.lit(False)
    return (
        F.when(F.coalesce(fatal, no) | (F.coalesce(n_rule_errors, F.lit(0)) > 0), "failed")
        .when(F.coalesce(complete, no), "completed")
        .when(F.coalesce(running, no), "running")
        .otherwise("failed")
    )


def run_status(
    fatal: Column, complete: Column, progress_pct: Column, has_log: Column, stage: Column | None = None
) -> Column:
    """error, completed (from 99.5 percent, or at stage ``completed``), not_started, running."""
    # Fixed value: 99.5.
    ended = F.lit(False) if stage is None else stage == "completed"
    return (
        F.when(F.coalesce(fatal, F.lit(False)), "error")
        .when(F.coalesce(complete, F.lit(False)) | (progress_pct >= 99.5) | F.coalesce(ended, F.lit(False)), "completed")
        .when((progress_pct == 0) & ~has_log, "not_started")
        .otherwise("running")
    )


def stage_checklist(
    artifacts: DataFrame, runs: DataFrame, steps: Sequence[str] = tuple(K.SETUP_STEPS)
) -> DataFrame:
    """Per run: steps done, the next step and the bar. ``artifacts(run, step)``."""
    # one flag per step: the state of a run is one row, whatever the file count
    flags = [f"_step_{n}" for n in range(len(steps))]
    seen = artifacts.groupBy("run").agg(
        *[F.bool_or(F.col("step") == s).alias(flag) for s, flag in zip(steps, flags)])
    joined = runs.select("run").join(seen, "run", "left").na.fill(False, flags)
    open_steps = F.array_compact(F.array(*[F.when(~F.col(flag), F.lit(s)) for s, flag in zip(steps, flags)]))
    n_done = F.lit(len(steps)) - F.size(open_steps)
    return joined.select(
        "run", n_done.cast("int").alias("n_done"), F.lit(len(steps)).alias("n_total"),
        F.get(open_steps, F.lit(0)).alias("next_step"))


def step_rows(
    artifacts: DataFrame, runs: DataFrame, steps: Sequence[str] = tuple(K.SETUP_STEPS)
) -> DataFrame:
    """``(run, ordinal, step, done)`` for every step of every run."""
    seen = artifacts.select("run", "step").distinct().withColumn("done", F.lit(True))
    names = F.posexplode(F.array(*[F.lit(s) for s in steps])).alias("ordinal", "step")
    return runs.select("run", names).join(seen, ["run", "step"], "left").withColumn(
        "done", F.coalesce("done", F.lit(False))).select("run", "ordinal", "step", "done")
