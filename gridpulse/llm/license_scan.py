"""License scans with DataFrame functions alone.

Texts and templates become five-word shingles of lower-cased words. A template
of t shingles belongs to the class of size s, the power of two with s/2 < t <= s.
Windows of a class are 3s/2 shingles long and start every s/2, so a run of s
shingles lies wholly in one of them (for s = 1 a window is a shingle). A window
holding four fifths of the template has Jaccard similarity J >= 0.25 with it;
24 one-row MinHash bands then collide with probability 1 - 0.75**24 = 0.999, and
for s = 1 always. Windows that share no band are never compared. Retrieved
windows are checked by exact shingle containment.

A band can only collide where its shingle occurs, so texts and windows without
any band shingle of any template skip the minima: the outcome is the same.

Defined cases: null text is empty; a text under five words has one shingle of
all its words; a template likewise; repeated rows repeat their matches, rows with a null
``doc_id`` have theirs under it; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS

CONTAINMENT, BANDS = 0.8, 24
#: The most templates and template shingles that are sent to every executor at once; more are scanned for in parts.
MOST_TEMPLATES, MOST_SHINGLES = 10_000, 2_000_000

# The notices by which texts name a licence, as their publishers word them.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(TEMPLATES)], "template_id long, license string, template string")


def lower_words(text: Column) -> Column:
    """Lower-cased words."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), WS), lambda x: x != "")


def hashes(words: str) -> Column:
    """Hashes of the five-word shingles of a column of words."""
    n = F.size(words)
    at = lambda i, j: F.get(words, i + j)
    many = F.transform(F.sequence(F.lit(0), n - 5), lambda i: F.xxhash64(*(at(i, j) for j in range(5))))
    return F.when(n >= 5, many).when(n > 0, F.array(F.xxhash64(F.concat_ws(" ", words)))).otherwise(F.array().cast("array<bigint>"))


def minima(h: Column, bands: int) -> Column:
    """One key for each band: the shingle whose hash, seeded anew for the band, is least."""

    def least(band: int) -> Column:
        return F.array_min(F.transform(h, lambda x: F.struct(F.xxhash64(x, F.lit(band)).alias("hash"), x.alias("key"))))["key"]

    return F.array(*map(least, range(bands)))


def holding(h: str, size: int, keys: list[int]) -> Column:
    """Windows ``s, at, g`` of the class that hold a shingle of the keys."""
    step, width = max(1, size // 2), max(1, 3 * size // 2)
    starts = F.sequence(F.lit(0), F.greatest(F.size(h) - 1, F.lit(0)), F.lit(step))
    every = F.transform(starts, lambda i: F.struct(F.lit(size).alias("s"), i.alias("at"), F.slice(h, i + 1, width).alias("g")))
    return F.filter(every, lambda x: F.exists(x["g"], lambda y: y.isin(*keys)))


def scan(docs: DataFrame, known: DataFrame, containment: float = CONTAINMENT, bands: int = BANDS, most: int = MOST_TEMPLATES, depth: int = 0) -> DataFrame:
    """``doc_id, template_id, license, first_word, containment``: each template at its best place in each document.

    More than ``most`` templates are halved by hash, and every part is scanned for.
    """
    held = known.withColumn("w", lower_words(F.col("template"))).withColumn("h", hashes("w")).where(F.size("h") > 0)
    held = held.select("template_id", "license", F.array_distinct("h").alias("h"), F.pow(F.lit(2.0), F.ceil(F.log2(F.size("h").cast("double")))).cast("int").alias("s"))
    total = held.agg(F.count("*"), F.coalesce(F.sum(F.size("h")), F.lit(0))).first()
    if total[0] > 1 and (total[0] > most or total[1] > MOST_SHINGLES):
        halves = (known.where(F.pmod(F.xxhash64("template_id", F.lit(depth)), F.lit(2)) == k) for k in (0, 1))
        one, two = (scan(docs, x, containment, bands, most, depth + 1) for x in halves)
        return one.union(two)
    banded = held.withColumn("key", F.explode(F.array_distinct(F.when(F.col("s") == 1, F.col("h")).otherwise(minima(F.col("h"), bands)))))
    listed = banded.select("s", "key").distinct().collect()
    by_size: dict[int, list[int]] = {}
    for r in listed:
        by_size.setdefault(r["s"], []).append(r["key"])
    every = sorted({k for v in by_size.values() for k in v})
    d = docs.select(F.col("doc_id").alias("doc_id"), F.monotonically_increasing_id().alias("row"), lower_words(F.col("text")).alias("w"))
    d = d.select("doc_id", "row", hashes("w").alias("h")).where(F.exists("h", lambda x: x.isin(*every)) if every else F.lit(False))
    if not by_size:
        return d.select("doc_id", F.lit(0).cast("long").alias("template_id"), F.lit("").alias("license"), F.lit(0).alias("first_word"), F.lit(0.0).alias("containment")).where("false")
    # All classes come from one pass over the texts; the join on size and key keeps each class's own bands.
    every_class = F.concat(*(holding("h", s, keys) for s, keys in sorted(by_size.items())))
    one = d.select("doc_id", "row", F.explode(every_class).alias("x")).select("doc_id", "row", "x.s", "x.at", "x.g")
    own = F.when(F.col("s") == 1, F.col("g")).otherwise(minima(F.col("g"), bands))
    met = one.select("doc_id", "row", "s", "at", "g", F.explode(F.array_distinct(own)).alias("key")).where(F.col("key").isin(*every))
    pairs = met.join(F.broadcast(banded.withColumnRenamed("h", "th")), ["s", "key"])
    share = F.size(F.array_intersect("th", "g")) / F.size("th")
    place = F.col("at") + F.array_position(F.transform("g", lambda x: F.array_contains("th", x)), True).cast("int") - 1
    good = pairs.select("doc_id", "row", "template_id", "license", share.alias("containment"), place.alias("first_word")).where(F.col("containment") >= containment)
    best = good.groupBy("doc_id", "row", "template_id", "license").agg(F.max(F.struct("containment", (-F.col("first_word")).alias("back"))).alias("b"))
    return best.select("doc_id", "template_id", "license", (-F.col("b.back")).alias("first_word"), F.col("b.containment").alias("containment"))
