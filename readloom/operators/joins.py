"""Joins and set differences between sample tables, and name matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from readloom.functions.text import digits_of, letters_of


def with_metrics(samples: DataFrame, metrics: DataFrame) -> DataFrame:
    """Equi join by sample; samples without metrics stay."""
    return samples.join(metrics, "sample_id", "left")


def differences(metadata: DataFrame, counts: DataFrame) -> DataFrame:
    """Samples on one side only: ``(sample_id, level, side)``.

    Missing counts are an error, missing metadata a warning. One pass over both
    sides; ids are reduced to distinct before the shuffle.
    """
    both = (
        metadata.select("sample_id", F.lit(1).alias("m"), F.lit(0).alias("c"))
        .unionByName(counts.select("sample_id", F.lit(0).alias("m"), F.lit(1).alias("c")))
        .groupBy("sample_id")
        .agg(F.max("m").alias("m"), F.max("c").alias("c"))
    )
    return both.where("m + c = 1").select(
        "sample_id",
        F.when(F.col("m") == 1, "error").otherwise("warning").alias("level"),
        F.when(F.col("m") == 1, "metadata").otherwise("counts").alias("side"),
    )


def exclude(df: DataFrame, excluded: DataFrame, on: str = "sample_id") -> DataFrame:
    return df.join(excluded.select(on).distinct(), on, "left_anti")


def intersect_all(parts: Sequence[DataFrame], on: str = "sample_id") -> DataFrame:
    """Ids present in every part."""
    out = parts[0].select(on).distinct()
    for part in parts[1:]:
        out = out.join(part.select(on).distinct(), on, "left_semi")
    return out


def match_names(names: DataFrame, known: DataFrame, column: str = "name") -> DataFrame:
    """Best known spelling of each name, or NULL.

    Order: same text, same without case, then digits and letters swapped
    (``1D`` and ``D1``). Every way of matching is a key, so this is one equi
    join; among equal ways the smallest known name is taken.
    """
    name = F.col(column)
    digits, letters = digits_of(name), letters_of(name)
    swap = (digits != "") & (letters != "")
    keys = F.array(
        F.struct(F.lit(0).alias("way"), name.alias("key"), F.lit(False).alias("folded")),
        F.struct(F.lit(1).alias("way"), F.lower(name).alias("key"), F.lit(True).alias("folded")),
        F.struct(F.lit(2).alias("way"),
                 F.when(swap, F.lower(F.concat(letters, digits))).alias("key"),
                 F.lit(True).alias("folded")),
        F.struct(F.lit(3).alias("way"),
                 F.when(swap, F.lower(F.concat(digits, letters))).alias("key"),
                 F.lit(True).alias("folded")),
    )
    wanted = names.select(name.alias("name")).distinct()
    wanted = wanted.select("name", F.explode(_keys_for(keys)).alias("k")).select("name", "k.*")
    spelled = known.select(F.col(column).alias("known")).distinct()
    spelled = spelled.select("known", F.explode(F.array(
        F.struct(F.col("known").alias("key"), F.lit(False).alias("folded")),
        F.struct(F.lower("known").alias("key"), F.lit(True).alias("folded")),
    )).alias("k")).select("known", "k.*")
    # the smallest spelling per key keeps the join at one partner per key
    spelled = spelled.groupBy("key", "folded").agg(F.min("known").alias("known"))
    return (
        wanted.join(spelled, ["key", "folded"], "left")
        .groupBy("name")
        .agg(
            F.min_by("known", F.when(F.col("known").isNotNull(), F.col("way"))).alias("match"),
            F.min(F.when(F.col("known").isNotNull(), F.col("way"))).alias("way"),
        )
    )


def _keys_for(keys):
    return F.filter(keys, lambda k: k["key"].isNotNull())


def id_variants(ids: DataFrame, column: str = "project_id") -> DataFrame:
    """The id itself, with ``-`` for ``_`` and with ``_`` for ``-``, in that order."""
    name = F.col(column)
    variants = F.array(name, F.replace(name, F.lit("-"), F.lit("_")),
                       F.replace(name, F.lit("_"), F.lit("-")))
    return ids.select(column, F.posexplode(variants).alias("way", "variant"))


def match_variants(ids: DataFrame, listing: DataFrame, column: str = "project_id") -> DataFrame:
    """First variant of each id that exists in ``listing(name)``."""
    names = listing.select(F.col("name").alias("variant")).distinct()
    return (
        id_variants(ids, column).join(names, "variant", "left_semi")
        .groupBy(column).agg(F.min_by("variant", "way").alias("found"))
    )
