"""License scans with DataFrame operations only: MinHash bands over text windows, then exact containment.

Templates and texts are five-word shingles. A template of n shingles is in a text if some stretch of 2n
shingles, wherever it begins, holds the share CONTAINED of the template's distinct ones. Such a stretch can
begin at a template's shingle, so windows of 2.5n, one every n / 2 where a template's shingle is among the
first n / 2, hold it whole. Windows only find candidates: by an equi-join on (n, band, MinHash), where a
window's MinHashes are those of its shingles that are in templates of n. Their Jaccard similarity is at least 0.8 / 2.7 =
0.29 even if all else in the window is from other templates; BANDS single MinHashes then miss it with a probability
below 0.71 ^ 32, two in a hundred thousand. A candidate counts by the best of its stretches of 2n (matches, the best of
each template). Occurrences, all of a template's in a text, are runs of its shingles in its own order with no gap of
2n, that hold the share; text that was moved about within a notice makes a match without an occurrence.

Only texts that hold an anchor (a word of each template shingle, or where it has only short ones the shingle
itself) are cut into words: others contain nothing of any template, so nothing can be lost. Their shingles meet
the templates' by an equi-join, with the template table broadcast where it is small enough; from there on only
shingles of templates go on, dealt by row and window.

Edges: null, empty and shorter texts have no licenses; repeated rows each get their result; texts may
hold any number of licenses; an empty table gives an empty result; a very long text is cut into words in one
task, and its hits are dealt by windows. Of docs only the key is returned, whatever its other columns are named.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulith.llm.common import bounded_broadcast, discard, stored

WIDTH, BANDS, CONTAINED = 5, 32, 0.8
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Notices as their licenses or common usage word them.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    ),
    (
        "MIT",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE '
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    (
        "BSD-2-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "LGPL-3.0",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
]


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(str.maketrans(UPPER, LOWER)))


def anchor_words(templates: list[tuple[str, str]]) -> tuple[list[str], list[tuple[str, ...]]]:
    """Of each template shingle a word of five letters or more (in turn the one that is in most of the shingles left; among equals the longest); and the shingles that have only shorter ones."""
    runs = [tuple(w[i : i + WIDTH]) for _, t in templates for w in [words_of(t)] for i in range(len(w) - WIDTH + 1)]
    left = {r for r in runs if any(len(w) >= WIDTH for w in r)}
    whole = sorted(set(runs) - left)
    chosen = []
    while left:
        counts = Counter(w for r in left for w in set(r) if len(w) >= WIDTH)
        best = max(counts, key=lambda w: (counts[w], len(w), w))
        chosen.append(best)
        left = {r for r in left if best not in r}
    return sorted(chosen), whole


def anchors(templates: list[tuple[str, str]]) -> str:
    """A pattern that is in every text with a template shingle: one of the anchor words, or all words of a shingle without one."""
    chosen, whole = anchor_words(templates)
    inside = WORD.removesuffix("+")
    outside = inside.replace("[^", "[", 1) + "+"
    return f"(?<!{inside})(?:{'|'.join([*chosen, *(outside.join(r) for r in whole)])})(?!{inside})"


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(f"({WORD})"))


def shingle_array(words: Column) -> Column:
    n = F.size(words) - (WIDTH - 1)
    return F.when(n < 1, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(words, i, WIDTH), " "))))


def min_hashes(shingles: Column) -> Column:
    def least(j: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(j))))

    return F.array(*[least(j) for j in range(BANDS)])


def template_table(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """license, template (number), _all (shingles in order), _own (distinct ones) and _n."""
    rows = spark.createDataFrame([(name, i, text) for i, (name, text) in enumerate(templates)], "license string, template int, text string")
    made = rows.withColumn("_words", word_array(F.col("text"))).withColumn("_all", shingle_array(F.col("_words")))
    short = made.filter(F.size("_all") < 1).count()
    if short:
        raise ValueError(f"a template needs {WIDTH} words")
    return made.select("license", "template", "_all", F.array_distinct("_all").alias("_own"), F.size("_all").alias("_n"))


def gate_of(text: Column, templates: list[tuple[str, str]]) -> Column:
    """Whether a text may hold a template: plain searches for the anchors' words first (all of them, of a shingle that has only short ones), then the pattern."""
    chosen, whole = anchor_words(templates)

    def any_anchor(low: Column) -> Column:
        has = lambda w: F.contains(low, F.lit(w))
        return reduce(lambda a, b: a | b, [*map(has, chosen), *(reduce(lambda a, b: a & b, map(has, sorted(set(r), key=len, reverse=True))) for r in whole)], F.lit(False))

    # by way of an array, so that a text is lower-cased once and not for each word
    found = F.element_at(F.transform(F.array(F.lower(text)), any_anchor), 1)
    return F.when(found, F.translate(text, UPPER, LOWER).rlike(anchors(templates))).otherwise(F.lit(False))


def best_stretch() -> Column:
    """_share and _from of the stretch of 2 * _n shingles with the most of _own, of those that begin at one of _hits before _step; the first of equals. Null if there is none."""
    reach = 2 * F.col("_n")

    def stretch(h: Column) -> Column:
        held = F.filter("_hits", lambda x: (x["i"] >= h["i"]) & (x["i"] < h["i"] + reach))
        return F.struct((F.size(F.array_distinct(F.transform(held, lambda x: x["x"]))) / F.size("_own")).alias("_share"), (-h["i"]).alias("_back"))

    starts = F.filter("_hits", lambda h: h["i"] < F.col("_step"))
    # where one stretch holds all hits, no other holds more
    one = F.element_at("_hits", -1)["i"] - F.element_at("_hits", 1)["i"] < reach
    best = F.array_max(F.transform(F.when(one, F.slice(starts, 1, 1)).otherwise(starts), stretch))
    return F.struct(best["_share"].alias("_share"), (-best["_back"]).alias("_from"))


def occurrences(hits: DataFrame, known: DataFrame) -> DataFrame:
    """_row and its occurrences: runs of a template's shingles that go up in the template's order, with no gap of 2 * _n, and hold the share CONTAINED."""
    # where a shingle recurs in its template its place says nothing
    places = known.select("license", "template", "_n", F.size("_own").alias("_distinct"), F.posexplode("_all").alias("_place", "x"))
    places = places.groupBy("license", "template", "_n", "_distinct", "x").agg(F.when(F.count(F.lit(1)) == 1, F.min("_place")).alias("_place"))
    met = hits.select("_row", "i", "x").distinct().join(bounded_broadcast(places), "x")
    of, order = ["_row", "template"], Window.partitionBy("_row", "template").orderBy("i")
    new = F.col("_before").isNull() | (F.col("i") - F.col("_before") >= 2 * F.col("_n")) | (F.col("_place") <= F.col("_last"))
    met = met.withColumns({"_before": F.lag("i").over(order), "_last": F.last("_place", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))})
    runs = met.withColumn("_run", F.sum(F.when(F.coalesce(new, F.lit(False)), 1).otherwise(0)).over(order))
    held = runs.groupBy(*of, "_run", "license").agg(F.min("i").alias("first_word"), (F.max("i") + WIDTH - 1).alias("last_word"), (F.count_distinct("x") / F.first("_distinct")).alias("share"))
    return held.filter(F.col("share") >= CONTAINED).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("template", "license", "first_word", "last_word", F.round("share", 6).alias("share")))).alias("occurrences"))


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of docs: key, licenses (names, sorted), matches (template, first word, share contained; best stretch of each template) and occurrences (template, license, first and last word, share)."""
    spark = docs.sparkSession
    known = stored(template_table(spark, templates), "license-templates")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(docs.select(F.col(key).alias("_key"), F.when(gate_of(F.col(text), templates), F.col(text)).alias("_text")).withColumn("_row", F.monotonically_increasing_id()), "license-rows")
    # stored, so that the words are cut once a text, not once a shingle; dealt, since few of the rows that were read together may be left
    cut = stored(rows.filter(F.col("_text").isNotNull()).repartition(parts, "_row").select("_row", word_array(F.col("_text")).alias("_words")), "license-words")
    shingles = cut.select("_row", F.posexplode(shingle_array(F.col("_words"))).alias("i", "x"))
    sizes = known.select("_n", F.explode("_own").alias("x")).distinct()
    hits = stored(shingles.join(bounded_broadcast(sizes), "x").select("_row", "i", "x", "_n"), "license-hits")
    discard(cut)
    stepped = hits.withColumn("_step", F.greatest(F.lit(1), F.floor(F.col("_n") / 2).cast("int")))
    first = F.greatest(F.lit(0), F.floor((F.col("i") - 2 * F.col("_n")) / F.col("_step")).cast("int"))
    windows = (
        stepped.withColumn("_window", F.explode(F.sequence(first, F.floor(F.col("i") / F.col("_step")).cast("int"))))
        .withColumn("_at", F.col("_window") * F.col("_step"))
        .groupBy("_row", "_n", "_step", "_at")
        .agg(F.array_sort(F.collect_list(F.struct((F.col("i") - F.col("_at")).alias("i"), "x"))).alias("_held"))
        .filter(F.element_at("_held", 1)["i"] < F.col("_step"))
    )
    band = lambda held: F.posexplode(min_hashes(held)).alias("_band", "_min")
    candidates = (
        windows.select("_row", "_n", "_step", "_at", "_held", band(F.transform("_held", lambda h: h["x"])))
        .join(bounded_broadcast(known.select("license", "template", "_own", "_n", band(F.col("_own")))), ["_n", "_band", "_min"])
        .withColumn("_hits", F.filter("_held", lambda h: F.array_contains("_own", h["x"])))
        .filter(F.size(F.array_distinct(F.transform("_hits", lambda h: h["x"]))) / F.size("_own") >= CONTAINED)
        .withColumn("_stretch", best_stretch())
        .select("_row", "license", "template", F.col("_stretch._share").alias("_share"), (F.col("_at") + F.col("_stretch._from")).alias("_at"))
        .filter(F.col("_share") >= CONTAINED)
    )
    best = candidates.groupBy("_row", "template").agg(F.max(F.struct("_share", (-F.col("_at")).alias("_back"), F.col("license"))).alias("_best"))
    found = best.groupBy("_row").agg(
        F.array_sort(F.collect_set("_best.license")).alias("licenses"),
        F.array_sort(F.collect_list(F.struct("template", (-F.col("_best._back")).alias("first_word"), F.round("_best._share", 6).alias("share")))).alias("matches"),
    )
    every = occurrences(hits, known)
    out = rows.select("_row", "_key").join(found, "_row", "left").join(every, "_row", "left")
    none = F.array().cast("array<string>")
    return out.select(
        F.col("_key").alias(key),
        F.coalesce("licenses", none).alias("licenses"),
        F.coalesce("matches", F.array().cast(found.schema["matches"].dataType)).alias("matches"),
        F.coalesce("occurrences", F.array().cast(every.schema["occurrences"].dataType)).alias("occurrences"),
    )
