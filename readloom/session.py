"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "readloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on (UTC, AQE).

    Shuffle partitions are left to the cluster's own setting; AQE coalesces
    them. Pass ``**{"spark.sql.shuffle.partitions": "8"}`` for local runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/readloom/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The table written under the shared folder and read back.

    Cuts the lineage of a small result that several steps read, so the scan
    behind it runs once and a lost executor does not repeat it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """The table, marked to be shuffled and sorted where it is joined, whatever size Spark takes it for.

    For a table that grows with the texts: a broadcast is planned before anything is measured, by the compressed
    bytes of stored columns, and rows made by an explode are not counted; the driver then builds the whole table.
    """
    return df.hint("merge")


def broadcast_if_small(df: DataFrame, label: str, max_bytes: int = 64 << 20) -> DataFrame:
    """The table stored, and marked for broadcast when its rows' bytes (as text) are within the bound.

    Beyond it the table is joined like any other.
    """
    stored = written(df, label)
    size = stored.agg(F.sum(F.octet_length(F.to_json(F.struct(*stored.columns))))).first()[0] or 0
    return F.broadcast(stored) if size <= max_bytes else stored
