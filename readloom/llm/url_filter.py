"""Allow and block rules for URLs by a sorted sweep over nested intervals.

A rule names a host and the start of a path and holds for that host and all its
subdomains. With the host's labels in reverse (``com.example.``) a rule's host
is a prefix of all hosts it holds for, so in sorted order it is an interval, and
two intervals nest or lie apart. One sweep over the sorted hosts of rules and
URLs, with a stack of the intervals that are open, gives each URL the rule
hosts above it; a second one over (rule host, path) gives the longest path
prefix at each of these hosts. The longest rule wins.

The sweep runs in ranges of the order at once: the number of open intervals at
the start of a range is the sum of what the ranges before it opened and closed,
and the stack there is the last interval opened at each level. The stack is one
column per level; how many there are is read from the rules (nested hosts, or
nested paths of one host). The range key ends with a hash of the row, so a URL
or host that holds a third of all rows is spread over ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from readloom.session import written

CLOSE, OPEN, POINT = 0, 1, 2


def host_of(url: str) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z in lower case ("" without ``://``)."""
    rest = _rest(url)
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))


def reversed_host(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def _sweep(points: DataFrame, prefixes: DataFrame, scope: str, key: str, levels: int, ranges: int) -> DataFrame:
    """The points' columns and ``stack``: the prefixes of the point's key in the same scope, outermost first.

    ``points`` and ``prefixes`` have the string columns ``scope`` and ``key``;
    prefixes are distinct. A prefix opens at its own bytes and closes at these
    followed by a byte above all others.
    """
    if levels == 0:
        return points.withColumn("stack", F.array().cast("array<string>"))
    own = [c for c in points.columns if c not in (scope, key)]
    at = F.col(key).cast("binary")
    opens = prefixes.select(scope, at.alias("at"), F.lit(OPEN).alias("kind"), F.col(key).alias("prefix"))
    closes = prefixes.select(scope, F.concat(at, F.lit(b"\xff")).alias("at"), F.lit(CLOSE).alias("kind"),
                             F.lit(None).cast("string").alias("prefix"))
    rows = points.select(scope, at.alias("at"), F.lit(POINT).alias("kind"), F.lit(None).cast("string").alias("prefix"),
                         F.xxhash64(*own).alias("spread"), F.struct(*own).alias("row"), F.col(key).alias("key"))
    order = [scope, "at", "kind", "spread"]
    events = written(
        rows.unionByName(opens.unionByName(closes), allowMissingColumns=True)
        .withColumn("spread", F.coalesce("spread", F.lit(0)))
        .repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        .withColumn("range_no", F.spark_partition_id()).withColumn("range_row", F.monotonically_increasing_id()), "sweep")
    change = F.when(F.col("kind") == OPEN, 1).when(F.col("kind") == CLOSE, -1).otherwise(0)
    earlier = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    depths = events.groupBy("range_no").agg(F.sum(change).alias("net")).select(
        "range_no", F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("depth_before"))
    inside = Window.partitionBy("range_no").orderBy("range_row").rowsBetween(Window.unboundedPreceding, 0)
    deep = events.join(F.broadcast(depths), "range_no").withColumn(
        "depth", F.col("depth_before") + F.sum(change).over(inside))

    def opened(level: int) -> Column:
        return F.when((F.col("kind") == OPEN) & (F.col("depth") == level), F.col("prefix"))

    lasts = deep.where(F.col("kind") == OPEN).groupBy("range_no").agg(
        *[F.max_by("prefix", F.when(F.col("depth") == n, F.col("range_row"))).alias(f"end_{n}") for n in range(1, levels + 1)])
    before = depths.join(lasts, "range_no", "left").select("range_no", *[
        F.last(f"end_{n}", ignorenulls=True).over(earlier).alias(f"from_{n}") for n in range(1, levels + 1)])
    stacked = deep.join(F.broadcast(before), "range_no")
    for n in range(1, levels + 1):
        stacked = stacked.withColumn(f"level_{n}", F.when(F.col("depth") >= n, F.coalesce(
            F.last(opened(n), ignorenulls=True).over(inside), F.col(f"from_{n}"))))
    stack = F.array_compact(F.array(*[F.col(f"level_{n}") for n in range(1, levels + 1)]))
    return stacked.where(F.col("kind") == POINT).select(scope, F.col("key").alias(key), "row.*", stack.alias("stack"))


def _nested(prefixes: DataFrame, scope: str, key: str) -> int:
    """How many prefixes of one scope are open at once at most: the greatest running sum, range by range."""
    at = F.col(key).cast("binary")
    marks = prefixes.select(scope, at.alias("at"), F.lit(1).alias("change")).unionByName(
        prefixes.select(scope, F.concat(at, F.lit(b"\xff")).alias("at"), F.lit(-1).alias("change")))
    marks = written(marks.repartitionByRange(scope, "at").sortWithinPartitions(scope, "at")
                    .withColumn("range_no", F.spark_partition_id())
                    .withColumn("range_row", F.monotonically_increasing_id()), "marks")
    inside = Window.partitionBy("range_no").orderBy("range_row").rowsBetween(Window.unboundedPreceding, 0)
    peaks = marks.withColumn("depth", F.sum("change").over(inside)).groupBy("range_no").agg(
        F.max("depth").alias("peak"), F.sum("change").alias("net"))
    earlier = Window.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    top = peaks.select((F.col("peak") + F.coalesce(F.sum("net").over(earlier), F.lit(0))).alias("peak")).agg(F.max("peak"))
    return top.first()[0] or 0


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", row_id: str = "page_id", default: str = "allow",
               ranges: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    ``rules``: ``host, path, verdict``. Host names compare in lower case; rules
    repeated for a host and path count once (``block`` before ``allow``). The
    longest fitting rule (host and path together, then the host) wins; without
    one, ``rule`` is null and the verdict ``default``. A null URL or one without
    ``://`` has an empty host and path. Rows may repeat: each is judged.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rules = (rules.select(F.lower("host").alias("host"), "path", "verdict").dropna()
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .withColumn("rule_host", reversed_host(F.col("host"))))
    rules = written(rules, "rules")
    pages = df.select(F.col(row_id).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    pages = pages.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    hosts = rules.select(F.lit("").alias("scope"), F.col("rule_host").alias("key")).distinct()
    keyed = pages.withColumn("scope", F.lit("")).withColumn("key", reversed_host(F.col("host")))
    above = _sweep(keyed, hosts, "scope", "key", _nested(hosts, "scope", "key"), ranges)
    above = written(above.select(F.monotonically_increasing_id().alias("row_no"), "page_id", "host", "path", "stack"), "hosts")
    paths = rules.select(F.col("rule_host").alias("scope"), F.col("path").alias("key")).distinct()
    tries = above.select("row_no", F.explode("stack").alias("scope"), F.col("path").alias("key"))
    found = _sweep(tries, paths, "scope", "key", _nested(paths, "scope", "key"), ranges)
    rank = F.struct(F.length("scope") - 1 + F.length("fits"), F.length("scope"))
    best = (found.where(F.size("stack") > 0).withColumn("fits", F.try_element_at(F.col("stack"), F.lit(-1)))
            .groupBy("row_no").agg(F.max_by(F.struct("scope", "fits"), rank).alias("best"))
            .select("row_no", F.col("best.scope").alias("rule_host"), F.col("best.fits").alias("rule_path")))
    named = rules.select("rule_host", F.col("path").alias("rule_path"), F.concat("host", "path").alias("rule"), "verdict")
    best = best.join(named, ["rule_host", "rule_path"])
    return (above.join(best, "row_no", "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
