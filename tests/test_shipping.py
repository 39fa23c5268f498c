"""Task functions must not need the package on the executors."""

import os
import subprocess
import sys

CODE = """
import sys
sys.path.insert(0, {root!r})
from readloom.session import build_session
from readloom.operators import reads as R
from readloom.sources.fastq import read_fastq
spark = build_session(master="local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
records = read_fastq(spark, {data!r}, split_bytes=40)
rows = records.selectExpr("'s' as sample_id", "seq", "qual", "seq as seq1", "qual as qual1",
                          "cast(null as string) as seq2", "cast(null as string) as qual2")
print("RESULT", records.count(), R.base_histogram(rows).count(), R.trim_counters(R.trim_pairs(rows)).first().total_pairs)
"""


def test_from_another_folder(tmp_path):
    (tmp_path / "a.fastq").write_text("@a\nACG\n+\nIII\n" * 20)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=root, data=str(tmp_path))],
                         cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "RESULT 20 3 20" in out.stdout, out.stderr[-2000:]
