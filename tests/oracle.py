"""Compare registered queries with their SQL twins."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        if isinstance(v, float) and math.isnan(v):
            return (2, "nan")
        return (2, repr(float(f"{float(v):.12g}")))
    return (3, str(v))


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(r[i]) for i in order) for r in data)


def exact(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr)


def compare(spark, con, name, fn, text, sf):
    """None when equal, else what differs."""
    df = fn(spark, sf)
    got, cols = [tuple(r) for r in df.collect()], df.columns
    if text is None:
        return None if got else "no rows"
    rel = con.execute(text)
    want_cols, want = [d[0] for d in rel.description], rel.fetchall()
    if sorted(cols) != sorted(want_cols):
        return f"columns {sorted(cols)} vs {sorted(want_cols)}"
    a, b = rows(cols, got), rows(want_cols, want)
    if len(a) != len(b):
        return f"{len(a)} rows vs {len(b)}: {[x for x in a if x not in set(b)][:3]} | {[x for x in b if x not in set(a)][:3]}"
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(diff)} rows differ: {diff[:2]}"
    if not a:
        return "both empty"
    ta = {c: type(v).__name__ for r in got for c, v in zip(cols, r) if v is not None}
    tb = {c: type(v).__name__ for r in want for c, v in zip(want_cols, r) if v is not None}
    if ta != tb:
        return f"types {[(c, ta.get(c), tb.get(c)) for c in tb if ta.get(c) != tb.get(c)]}"
    if exact(cols, got) != exact(want_cols, want):
        return "equal to 12 digits only"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from readloom.session import build_session

    settings = {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    # more settings, for example ORACLE_CONF="spark.sql.autoBroadcastJoinThreshold=-1"
    settings.update(kv.split("=", 1) for kv in os.environ.get("ORACLE_CONF", "").split(",") if kv)
    spark = build_session(master="local[8]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    sf = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
    con = connect(sf)
    names, oracle, bad = entry.queries(), entry.oracle_sql(), 0
    for name, fn in names.items():
        if len(sys.argv) > 1 and not any(a in name for a in sys.argv[1:]):
            continue
        t = time.time()
        try:
            err = compare(spark, con, name, fn, oracle.get(name), sf)
        except Exception as e:  # report and go on
            err = f"{type(e).__name__}: {str(e)[:600]}"
        bad += err is not None
        print(f"{'ok  ' if err is None else 'BAD '} {name:34s} {time.time() - t:6.2f}s "
              f"{'' if name in oracle else '(no sql)'} {err or ''}", flush=True)
    print("bad", bad, "of", len(names))
