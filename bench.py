"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and ``$BENCH_RUNS`` (3) times; the median counts.
The whole result is computed and thrown away by the noop sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 16g pyspark-shell")

from readloom import plans  # noqa: E402
from readloom.session import build_session  # noqa: E402

HEADLINE = [
    "compare_conditions", "compare_all_axes", "filter_samples", "sample_qc_status", "tool_verdict",
    "rule_findings_long", "report_status", "assignment_breakdown", "sample_expression",
    "highly_expressed", "top_variable_genes", "zero_genes", "number_replicates",
    "significant_counts", "top_genes", "readiness_findings", "match_names",
    "count_features", "count_features_summary", "strandedness", "read_distribution",
    "base_histogram", "position_profile", "read_quality_histogram", "validate_reads", "trim_reads",
    "checksum_audit", "artifact_audit", "log_errors", "log_tail", "workflow_progress",
    "stage_windows", "session_windows", "stream_run_latest",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.queries()
    seconds = {}
    for name in names:
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            queries[name](spark, sf).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
