"""Distinct counts kept as sketches that can be put together later.

An exact ``count(distinct)`` shuffles every id each time it is asked. Here ids are
reduced once, per group and before any shuffle, to a HyperLogLog sketch of fixed size. Stored
sketches of projects, batches or days are merged for any union of groups,
without the ids. The exact form stands beside it in each operator that counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2 ** 14 registers: a standard error of 0.8 %; three of them are the bounds given.
REGISTERS = 14
ERRORS = 3


def relative_error(registers: int = REGISTERS) -> float:
    """One standard error of an estimate, as a share of it."""
    return 1.04 / (1 << registers) ** 0.5


def distinct_sketches(df: DataFrame, groups: Sequence[str], columns: Sequence[str], registers: int = REGISTERS) -> DataFrame:
    """One row per group: a sketch of the distinct values of each column, under its name. Nulls do not count."""
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), registers).alias(c) for c in columns]
    return df.groupBy(*groups).agg(*sketches)


def merged(sketches: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sketches of the unions of groups; with no groups of everything."""
    unions = [F.hll_union_agg(c, F.lit(False)).alias(c) for c in columns]
    return sketches.groupBy(*groups).agg(*unions)


def estimates(sketches: DataFrame, columns: Sequence[str], registers: int = REGISTERS) -> DataFrame:
    """The other columns, and for each sketch its estimate under its name, with ``_low`` and ``_high``: ``ERRORS`` standard errors off."""
    others = [c for c in sketches.columns if c not in columns]
    share = ERRORS * relative_error(registers)

    def three(c: str) -> list[Column]:
        n = F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).cast("bigint")
        return [n.alias(c), F.floor(n * (1 - share)).cast("bigint").alias(f"{c}_low"), F.ceil(n * (1 + share)).cast("bigint").alias(f"{c}_high")]

    return sketches.select(*others, *[x for c in columns for x in three(c)])
