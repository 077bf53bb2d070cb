"""License notices in texts.  Built-in functions only.

Templates and overlapping windows of texts are sets of 5-word shingles.  A window is as
long as a template, and windows begin every quarter of that.  Sixteen MinHash bands of one
row retrieve templates: at a Jaccard similarity of 0.4, which a window at the worst place
still has, some band agrees with probability 1 - 0.6**16 = 0.9997.  Candidates are kept if
at least 0.75 of the template's shingles are contained in the stretch around the window.

The band join is pushed down: a window can agree with a template in a band only if it
holds the template's smallest shingle of that band.  Those shingles are looked up in all
texts, and only windows that hold one are signed.

A notice of fewer than five words is one shingle of its own length.  Texts are cut into
shingles of each such length that occurs, and the join on the shingle is the exact answer.

Texts are told apart by their hashes and not by doc_id: equal texts are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerweave.llm.common import body, join_hot, once, shingles_of, word_count, word_shingles, words
from offerweave.plans.scratch import broadcast_if_small, materialize

BANDS = 16
LIMIT = 0.75
WORDS = 5
BROADCAST_ROWS = 200_000

#: Well-known notices; a longer list can be given as a table.
TEMPLATES = {
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT-line": "Released under the MIT License.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Rights-line": "All rights reserved.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "GPL-2.0-or-later-line": "either version 2 of the License, or (at your option) any later version",
    "GPL-line": "See the GNU General Public License for more details.",
    "LGPL-line": "See the GNU Lesser General Public License for more details.",
    "AGPL-line": "See the GNU Affero General Public License for more details.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at https://www.boost.org/LICENSE_1_0.txt)",
    "BSD-3-Clause": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "CC0-1.0": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide.",
    "CC-BY-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-SA-4.0-line": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "OFL-1.1": "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "GFDL": "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License",
}


def templates(spark: SparkSession) -> DataFrame:
    """``(license, text)`` of the built-in notices."""
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in TEMPLATES.items()])
    return spark.range(1).select(F.explode(rows).alias("t")).select("t.license", "t.text")


def _low(shingles: Column, k: int) -> Column:
    """The smallest hash of a set under the k-th hash function."""
    return F.array_min(F.transform(shingles, lambda x: F.xxhash64(x, F.lit(k))))


def _lowest_shingle(shingles: Column, k: int) -> Column:
    """The shingle that has it."""
    return F.array_min(F.transform(shingles, lambda x: F.struct(F.xxhash64(x, F.lit(k)).alias("h"), x.alias("x"))))["x"]


def _cut(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """``(b1, b2, words, all, seeds)``: five-word shingles, and behind them those of the short ``sizes``."""
    none = F.array().cast("array<bigint>")
    short = lambda w: [F.when(F.size(w) >= k, shingles_of(w, k)).otherwise(none) for k in sizes]
    cut = once(words(F.col("text")), lambda w: F.struct(F.size(w).alias("words"), shingles_of(w, WORDS).alias("all"), F.concat(none, *short(w)).alias("short")))
    rows = docs.filter("text is not null").select(*body(), cut.alias("c")).filter("c.words > 0")
    return rows.select("b1", "b2", "c.words", "c.all", F.concat("c.all", "c.short").alias("seeds"))


def _windows(docs: DataFrame, seeds: DataFrame, sizes: list[int]) -> DataFrame:
    """``(b1, b2, n, license, start, window, around)`` of the windows that hold a seed, and the places of short notices.

    ``seeds(seed, n, short, license)``: a shingle of notices of ``n`` shingles, or a short notice of
    ``short`` words, whose license it is then.  Where the seeds are too many to broadcast, places
    alone are shuffled and the windows are cut from the texts afterwards.
    """
    small = seeds.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    texts = _cut(docs, sizes)
    carried = ["b1", "b2", "words", *(["all"] if small else [])]
    hits = join_hot(texts.select(*carried, F.posexplode("seeds").alias("pos", "seed")), seeds, ["seed"], ["b1", "pos"], BROADCAST_ROWS)
    size = F.greatest(F.lit(1), F.col("words") - WORDS + 1)
    # the one shingle of a short text may equal that of a short notice
    hits = hits.filter(F.col("short").isNull() == (F.col("pos") < size))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 4).cast("int"))
    last = F.greatest(F.lit(0), size - F.col("n"))
    from_, to = F.ceil((F.greatest(F.lit(0), F.col("pos") - F.col("n") + 1)) / step).cast("int"), F.floor(F.least(F.col("pos"), last) / step).cast("int")
    grid = F.when(from_ <= to, F.transform(F.sequence(from_, to), lambda i: i * step)).otherwise(F.array().cast("array<int>"))
    # the last window of a text need not be on the grid
    starts = F.array_distinct(F.when(F.col("pos") >= last, F.concat(grid, F.array(last))).otherwise(grid))
    before = size  # shingles ahead of those of a short size
    place = F.col("pos") - before
    for k, longer in zip(sizes, sizes[1:], strict=False):
        before = before + F.greatest(F.lit(0), F.col("words") - k + 1)
        place = F.when(F.col("short") >= longer, F.col("pos") - before).otherwise(place)
    at = hits.select(*carried, "n", "license", F.explode(F.when(F.col("short").isNull(), starts).otherwise(F.array(place))).alias("start"))
    around = F.greatest(F.lit(0), F.col("start") - F.floor(F.col("n") / 2).cast("int"))
    cut = {"window": F.slice("all", F.col("start") + 1, F.col("n")), "around": F.slice("all", around + 1, F.col("n") * 2)}
    cut = {c: F.when(F.col("license").isNull(), x).alias(c) for c, x in cut.items()}
    key = ["b1", "b2", "n", "license", "start"]
    if small:
        out = at.select(*key, *cut.values()).groupBy(*key).agg(*[F.first(c).alias(c) for c in cut])
    else:
        own = at.select(*key).distinct().groupBy("b1", "b2").agg(F.collect_list(F.struct("n", "license", "start")).alias("own"))
        each = texts.select("b1", "b2", "all").dropDuplicates(["b1", "b2"]).join(own, ["b1", "b2"]).select("b1", "b2", "all", F.inline("own"))
        out = each.select(*key, *cut.values())
    return materialize(out, "notice-windows")


def scan_licenses(docs: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """``(doc_id, license, containment, start_shingle)`` for each document and notice that it holds.

    ``notices(license, text)`` default to the built-in ones; a notice without words matches
    nothing, several texts of one license are several notices.  The best window counts, the
    earliest of equals.  A notice of fewer than five words is held wherever all its words follow
    each other.  Null, empty and blank texts match nothing, a text shorter than a notice is one
    window.  Repeated rows count once; of several texts with one doc_id the best window counts; a
    null doc_id is left out; extra columns are ignored; no rows give no rows.
    """
    notices = templates(docs.sparkSession) if notices is None else notices
    counted = notices.filter("license is not null").withColumn("words", word_count(F.col("text")))
    brief = counted.filter((F.col("words") > 0) & (F.col("words") < WORDS))
    sizes = sorted(r.words for r in brief.select("words").distinct().collect())  # at most four
    known = counted.filter(F.col("words") >= WORDS).select(F.monotonically_increasing_id().alias("notice"), "license", F.array_distinct(word_shingles(F.col("text"))).alias("shingles")).withColumn("n", F.size("shingles"))
    known = materialize(known.withColumn("lows", F.array(*[_low(F.col("shingles"), k) for k in range(BANDS)])), "notices")
    smallest = F.array(*[_lowest_shingle(F.col("shingles"), k) for k in range(BANDS)])
    seeds = known.select(F.explode(F.array_distinct(smallest)).alias("seed"), "n", F.lit(None).cast("int").alias("short"), F.lit(None).cast("string").alias("license")).distinct()
    for k in sizes:
        own = brief.filter(F.col("words") == k).select(F.get(word_shingles(F.col("text"), k), F.lit(0)).alias("seed"), F.lit(0).alias("n"), F.lit(k).alias("short"), "license")
        seeds = seeds.unionByName(own.distinct())
    windows = _windows(docs, materialize(seeds, "notice-seeds"), sizes)
    bands = F.array(*[F.struct(F.lit(k).alias("band"), _low(F.col("window"), k).alias("low")) for k in range(BANDS)])
    probes = windows.filter("license is null").select("b1", "b2", "start", "around", F.explode(bands).alias("b")).select("b1", "b2", "start", "around", "b.band", "b.low")
    index = materialize(known.select("notice", F.posexplode("lows").alias("band", "low")), "notice-bands")
    near = join_hot(probes, index, ["band", "low"], ["b1", "start"], BROADCAST_ROWS).groupBy("b1", "b2", "notice", "start").agg(F.first("around").alias("around"))
    share = F.size(F.array_intersect("shingles", "around")) / F.col("n")
    rated = join_hot(near, known.select("notice", "license", "shingles", "n"), ["notice"], ["b1", "start"], BROADCAST_ROWS // 10).withColumn("containment", share)
    held = rated.filter(F.col("containment") >= LIMIT).select("b1", "b2", "license", "containment", "start")
    held = held.unionByName(windows.filter("license is not null").select("b1", "b2", "license", F.lit(1.0).alias("containment"), "start"))
    best = F.max(F.struct("containment", (-F.col("start")).alias("s"))).alias("x")
    of_text = materialize(held.groupBy("b1", "b2", "license").agg(best).select("b1", "b2", "license", "x"), "held-notices")
    rows = docs.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), *body())
    out = join_hot(rows, of_text, ["b1", "b2"], ["doc_id"], BROADCAST_ROWS).groupBy("doc_id", "license").agg(F.max("x").alias("x"))
    return out.select("doc_id", "license", F.col("x.containment").alias("containment"), (-F.col("x.s")).cast("bigint").alias("start_shingle"))
