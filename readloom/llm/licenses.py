"""License notices in texts, by MinHash bands and exact shingle containment.

A text's words (lower case, letters and digits only) are taken in overlapping
windows, one width for each size of template (``s`` words, a power of two): a
window of ``2 s`` words starts every ``s`` words, so a notice lies in one window
whole. Windows and templates are sketched by MinHash over their five-word
shingles; equal values in one of the bands retrieve a template, and the share
of the template's shingles that the window holds verifies it (0.8 or more).

A window that holds 0.8 of a template resembles it by at least
``0.8 t / (W + 0.2 t)`` for ``t`` and ``W`` shingles. There are so many bands of
one value each that such a pair goes unseen with probability ``MISS`` at most.

Anchor words are chosen from each template so that less than 0.8 of its
shingles go without one; a window without an anchor cannot match and is left
out before it is sketched. That changes no result.

Templates are a list in code, so their bands are a broadcast of known size; no
text is shuffled, and documents with a frequent notice meet in no group but
their own. Rows with the same id and text count as one text. Null and empty
texts have no notices.

A template of fewer than five words is one shingle, its whole sequence of words;
a text holds it where these follow one another.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from readloom.llm.quality import once

SHINGLE = 5
LEAST = 0.8
MISS = 1e-9

# Opening notices of widely used licenses (name, text).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
                "option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]

#: With notices shorter than a shingle, which the query's SQL cannot express.
NOTICES = [*TEMPLATES, ("All-rights-reserved", "All rights reserved.")]


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def shingle_words(words: list[str]) -> list[tuple[str, ...]]:
    return list(dict.fromkeys(tuple(words[i:i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)))


def width(words: list[str]) -> int:
    """The template's size class: the next power of two, eight at least."""
    return max(8, 1 << (len(words) - 1).bit_length())


def n_bands(template: list[str], miss: float = MISS, least: float = LEAST) -> int:
    t, w = len(shingle_words(template)), 2 * width(template) - SHINGLE + 1
    alike = math.ceil(least * t) / (w + t - math.ceil(least * t))
    return 1 if alike >= 1 else math.ceil(math.log(miss) / math.log(1 - alike))


def anchors(template: list[str], least: float = LEAST) -> list[str]:
    """The longest words, as many as it takes for less than ``least`` of the shingles to be without one."""
    shingles, chosen = shingle_words(template), []
    for word in sorted(set(template), key=lambda w: (-len(w), w)):
        if sum(not set(s) & set(chosen) for s in shingles) < least * len(shingles):
            break
        chosen.append(word)
    return chosen


def shingles(words: Column) -> Column:
    """The distinct five-word shingles of an array of words, as hashes; none of a shorter one."""
    return F.when(F.size(words) < SHINGLE, F.array().cast("array<bigint>")).otherwise(F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.size(words) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)]))))


def bands(hashes: Column, n: Column) -> Column:
    """The least value of each of ``n`` hash functions over the shingles."""
    return F.transform(F.sequence(F.lit(1), n), lambda j: F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, j))))


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``template_id, license, width, n_bands, template_shingles`` of the templates that are not shorter than a shingle."""
    rows = []
    for n, (name, text) in enumerate(templates):
        words = words_of(text)
        if len(words) < SHINGLE:
            continue
        rows.append(F.struct(F.lit(n).alias("template_id"), F.lit(name).alias("license"),
                             F.lit(width(words)).alias("width"), F.lit(n_bands(words)).alias("n_bands"),
                             F.array(*map(F.lit, words)).alias("words")))
    return spark.range(1).select(F.inline(F.array(*rows))).select(
        "template_id", "license", "width", "n_bands", shingles(F.col("words")).alias("template_shingles"))


def find_notices(df: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, row_id: str = "doc_id",
                 text: str = "text", least: float = LEAST) -> DataFrame:
    """``doc_id, text_hash, template_id, license, window_no, contained`` for every notice and window that holds it.

    A notice shorter than a shingle has one row, for the window in which it first begins.
    """
    short = [(n, name, words_of(t)) for n, (name, t) in enumerate(templates) if len(words_of(t)) < SHINGLE]
    if any(not words for _, _, words in short):
        raise ValueError("a template has no words")
    if len(short) == len(templates):
        return find_short(df, short, row_id, text)
    found = find_long(df, templates, row_id, text, least)
    return found.unionByName(find_short(df, short, row_id, text)) if short else found


def find_short(df: DataFrame, short: Sequence[tuple[int, str, list[str]]], row_id: str, text: str) -> DataFrame:
    """The rows of ``find_notices`` for templates ``(template_id, license, words)`` shorter than a shingle."""
    low = F.lower(F.col(text))
    first = [words[0] for _, _, words in short]
    spaced = F.concat(F.lit(" "), F.array_join(F.filter(F.split(low, "[^a-z0-9]+", -1), lambda w: w != ""), " "), F.lit(" "))

    def hit(n: int, name: str, words: list[str], t: Column) -> Column:
        at = F.instr(t, " " + " ".join(words) + " ")
        before = F.substring(t, F.lit(1), at - 1)
        word_no = F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))
        return F.struct(F.lit(n).alias("template_id"), F.lit(name).alias("license"), at.alias("at"),
                        F.floor(word_no / width(words)).alias("window_no"))

    return (df.where(F.col(text).isNotNull() & once(low, lambda t: F.exists(F.array(*map(F.lit, first)), lambda a: F.contains(t, a))))
            .select(F.col(row_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                    F.inline(once(spaced, lambda t: F.filter(F.array(*[hit(*x, t) for x in short]), lambda x: x["at"] > 0))))
            .select("doc_id", "text_hash", "template_id", "license", "window_no", F.lit(1.0).alias("contained")).distinct())


def find_long(df: DataFrame, templates: Sequence[tuple[str, str]], row_id: str, text: str, least: float) -> DataFrame:
    """The rows of ``find_notices`` for templates that are not shorter than a shingle."""
    spark = df.sparkSession
    table = template_table(spark, templates)
    by_width: dict[int, list[list[str]]] = {}
    for _, t in templates:
        if len(words_of(t)) < SHINGLE:
            continue
        by_width.setdefault(width(words_of(t)), []).append(words_of(t))
    most = {w: max(map(n_bands, ts)) for w, ts in by_width.items()}
    marks = {w: sorted({a for t in ts for a in anchors(t)}) for w, ts in by_width.items()}
    every = sorted({a for m in marks.values() for a in m})

    low = F.lower(F.col(text))
    may = once(low, lambda t: F.exists(F.array(*map(F.lit, every)), lambda a: F.contains(t, a)))
    kinds = F.array(*[F.struct(F.lit(w).alias("width"), F.lit(most[w]).alias("bands"),
                               F.array(*map(F.lit, marks[w])).alias("marks")) for w in sorted(by_width)])
    windows = (
        df.where(F.col(text).isNotNull() & may)
        .select(F.col(row_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                once(F.filter(F.split(low, "[^a-z0-9]+", -1), lambda w: w != ""), lambda words: F.flatten(F.transform(
                    kinds, lambda k: F.filter(F.transform(
                        F.sequence(F.lit(0), F.floor((F.greatest(F.size(words), F.lit(1)) - 1) / k["width"])),
                        lambda n: F.struct(k["width"].alias("width"), k["bands"].alias("bands"), n.alias("window_no"),
                                           F.slice(words, (n * k["width"] + 1).cast("int"), k["width"] * 2).alias("words"))),
                        lambda x: F.arrays_overlap(x["words"], k["marks"]))))).alias("windows"))
        .select("doc_id", "text_hash", F.inline("windows"))
        .select("doc_id", "text_hash", "width", "bands", "window_no", shingles(F.col("words")).alias("hashes"))
        .where(F.size("hashes") > 0))
    sketched = windows.select("*", F.posexplode(bands(F.col("hashes"), F.col("bands"))).alias("band", "value"))
    known = table.select("*", F.posexplode(bands(F.col("template_shingles"), F.col("n_bands"))).alias("band", "value"))
    share = F.size(F.array_intersect("hashes", "template_shingles")) / F.size("template_shingles")
    # as many rows as templates have bands
    return (sketched.join(F.broadcast(known.drop("n_bands")), ["width", "band", "value"])
            .withColumn("contained", share).where(F.col("contained") >= least)
            .select("doc_id", "text_hash", "template_id", "license", "window_no", "contained").distinct())


def scan_licenses(df: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, row_id: str = "doc_id",
                  text: str = "text", least: float = LEAST) -> DataFrame:
    """``doc_id, n_notices, n_licenses, licenses`` (names in order, joined by commas; "" for none) for every row."""
    found = find_notices(df, templates, row_id, text, least).groupBy("doc_id", "text_hash").agg(
        F.countDistinct("template_id").alias("n_notices"), F.array_sort(F.collect_set("license")).alias("names"))
    found = found.select(F.col("doc_id").alias("of_doc"), F.col("text_hash").alias("of_text"), "n_notices", "names")
    rows = df.select(F.col(row_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("text_hash") == F.col("of_text")), "left")
            .select("doc_id", F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"),
                    F.coalesce(F.size("names"), F.lit(0)).cast("long").alias("n_licenses"),
                    F.coalesce(F.array_join("names", ","), F.lit("")).alias("licenses")))
