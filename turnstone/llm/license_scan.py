"""License notices by MinHash bands over text windows (operator 4).

Texts and templates become shingles of five normalised words.  At every shingle
that some template has, windows as long as each such template start: another
window holds no more of it.  Bands of two MinHash values retrieve templates,
and the exact containment of the template's shingles in the window decides.

A window that holds at least 80 % of a template, starting at the first shingle
present, has a Jaccard similarity of 0.66 or more with it; BANDS bands of ROWS
values then share one with a probability above 0.99999.

Templates of fewer than five words are one shingle each, compared exactly.

Only DataFrame functions run here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

SHINGLE = 5
ROWS = 2
BANDS = 24
CONTAINED_PERCENT = 80

_CC = ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")
_CC_NAMES = ("Attribution", "Attribution-ShareAlike", "Attribution-NonCommercial", "Attribution-NoDerivatives", "Attribution-NonCommercial-ShareAlike", "Attribution-NonCommercial-NoDerivatives")
_SPDX = ("Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "MPL-2.0", "EPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0")

_WARRANTY = (
    "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. "
    "See the GNU {0} for more details. You should have received a copy of the GNU {0} along with this {1}. If not, see https://www.gnu.org/licenses/."
)
_NO_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.'


def _gnu(name: str, version: str, work: str = "program") -> str:
    """The notice that the GNU project recommends for a license and version."""
    head = f"This {work} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, "
    return head + f"either version {version} of the License, or (at your option) any later version. This {work} " + _WARRANTY.format(name, work)


#: Notices in common use, by the SPDX id of their license.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    (
        "MIT",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to '
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("MIT", _NO_WARRANTY + " IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 '
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    *((f"GPL-{v}.0", _gnu("General Public License", v)) for v in "23"),
    *((f"LGPL-{v}", _gnu("Lesser General Public License", v, "library")) for v in ("2.1", "3")),
    ("AGPL-3.0", _gnu("Affero General Public License", "3")),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    *((f"CC-{kind}-{v}", f"This work is licensed under a Creative Commons {name} {v} {place} License.") for kind, name in zip(_CC, _CC_NAMES, strict=True) for v, place in (("3.0", "Unported"), ("4.0", "International"))),
    *((f"CC-{kind}-{v}", f"Licensed under CC {kind} {v}.") for kind in _CC for v in ("3.0", "4.0")),
    *((name, f"SPDX-License-Identifier: {name}") for name in (*_SPDX, *(f"CC-{kind}-4.0" for kind in _CC))),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("LGPL", "GNU Lesser General Public License as published by the Free Software Foundation"),
    ("LGPL-2.1", "GNU Lesser General Public License, version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License, version 3"),
    ("AGPL-3.0", "GNU Affero General Public License as published by the Free Software Foundation"),
    ("AGPL-3.0", "GNU Affero General Public License, version 3"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)

#: Notices of fewer than five words; the last is no license but the lack of one.
SHORT_TEMPLATES = (
    *((f"CC-{kind}-{v}", f"CC {kind} {v}") for kind in _CC for v in ("3.0", "4.0") if kind.count("-") < 2),
    ("CC0-1.0", "CC0 1.0"),
    *((name, f"SPDX-License-Identifier: {name}") for name in ("MIT", "ISC", "Unlicense", "Zlib")),
    ("All-rights-reserved", "All rights reserved."),
)


def _tokens(text: Column) -> Column:
    words = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}.\s]+|\.(?![0-9])", " "), r"\s+")
    return F.filter(words, lambda w: w != "")


def _shingles(tokens: str) -> Column:
    n = F.size(tokens)
    every = F.transform(F.slice(F.col(tokens), F.lit(1), F.greatest(n - (SHINGLE - 1), F.lit(0))), lambda w, i: F.xxhash64(w, *(F.get(F.col(tokens), i + j) for j in range(1, SHINGLE))))
    return F.when(n >= SHINGLE, every)


def _band_keys(shingles: Column) -> Column:
    """BANDS keys; each MinHash value is the least of the shingles' hashes under a seed of its own."""
    under = lambda seed: F.array_min(F.transform(shingles, lambda x: F.xxhash64(F.lit(seed), x)))
    least = [under(seed) for seed in range(BANDS * ROWS)]
    return F.array(*(F.xxhash64(F.lit(b), *least[b * ROWS : (b + 1) * ROWS]) for b in range(BANDS)))


def _join_counted(big: DataFrame, small: DataFrame, on: list[str], how: str, limit: int) -> DataFrame:
    return big.join(F.broadcast(small) if small.count() <= limit else small, on, how)


def license_matches(
    docs: DataFrame,
    templates: DataFrame | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = CONTAINED_PERCENT,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """One row per document and template found: the best window.

    Columns: ``doc_id``, ``template_id``, ``license``, ``n_shared`` of the
    template's ``n_shingles``, and ``first_word``, the first matching word's
    place among the normalised words.  *templates* has ``license`` and
    ``text``; the default is TEMPLATES.

    Where matches overlap, each word belongs to the one with the largest share
    of its template, then the longest, the first, the least id; a match that
    owns less than half of its words is left out.  So a notice isn't also
    reported as its neighbour by another version number.

    Null and empty texts and templates match nothing.  A template of fewer than
    five words is one shingle and must stand word for word.  Rows with a null id are left out; rows sharing an id count
    as one document.  Between equal windows the first wins.  Empty tables give
    an empty result; other columns are ignored.  Template tables and candidate
    ids are broadcast up to *broadcast_rows* rows and shuffled beyond.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    if templates is None:
        templates = spark.createDataFrame(list(TEMPLATES), "license string, text string")
    listed = templates.select(F.xxhash64("license", "text").alias("template_id"), "license", _tokens(F.col("text")).alias("tokens"))
    listed = listed.withColumn("length", F.size("tokens")).where("length > 0").dropDuplicates(["template_id"])
    short = scratch.keep(listed.where(F.col("length") < SHINGLE), "short")
    listed = listed.where(F.col("length") >= SHINGLE).select("template_id", "license", "length", F.array_distinct(_shingles("tokens")).alias("shingles"))
    listed = scratch.keep(listed, "templates")
    known = scratch.keep(listed.select("length", F.explode_outer("shingles").alias("hash")).groupBy("hash").agg(F.collect_set("length").alias("lengths")), "known")

    # The same document may come in several rows, so places are kept apart by the text's hash.
    body = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(body).alias("part"), body.alias("body")).where("doc_id is not null")
    hashed = lambda df: df.select("doc_id", "part", _tokens(F.col("body")).alias("tokens")).select("doc_id", "part", _shingles("tokens").alias("hashes"))
    exploded = hashed(texts).select("doc_id", "part", F.posexplode_outer("hashes").alias("pos", "hash"))
    anchors = _join_counted(exploded, known, ["hash"], "inner", broadcast_rows).groupBy("doc_id", "part").agg(F.collect_set(F.struct("pos", "lengths")).alias("anchors"))
    anchors = scratch.keep(anchors, "anchors")
    chosen = hashed(_join_counted(texts, anchors.select("doc_id", "part"), ["doc_id", "part"], "left_semi", broadcast_rows)).join(anchors, ["doc_id", "part"])

    # One row an anchor and length, so that no row grows with a text's matches.
    windows = chosen.select("doc_id", "part", "hashes", F.explode_outer("anchors").alias("a")).select("doc_id", "part", "hashes", F.col("a.pos").alias("pos"), F.explode_outer("a.lengths").alias("length"))
    windows = windows.select("doc_id", "part", "pos", "length", F.slice("hashes", F.col("pos") + 1, F.greatest(F.col("length") - (SHINGLE - 1), F.lit(0))).alias("own"))
    keyed = windows.select("doc_id", "part", "pos", "length", "own", F.explode_outer(_band_keys(F.col("own"))).alias("key"))
    bands = listed.select("template_id", "length", F.explode_outer(_band_keys(F.col("shingles"))).alias("key"))
    bands = scratch.keep(bands.where("key is not null").distinct(), "bands")
    found = _join_counted(keyed, bands, ["length", "key"], "inner", broadcast_rows).groupBy("doc_id", "part", "pos", "template_id").agg(F.first("own").alias("own"))
    judged = _join_counted(found, listed, ["template_id"], "inner", broadcast_rows)
    judged = judged.withColumn("n_shared", F.size(F.array_intersect("own", "shingles"))).withColumn("n_shingles", F.size("shingles")).where(F.col("n_shared") * 100 >= F.col("n_shingles") * percent)
    places = F.filter(F.transform("own", lambda h, i: F.when(F.array_contains(F.col("shingles"), h), i)), lambda i: i.isNotNull())
    judged = judged.withColumn("places", places).select("doc_id", "part", "template_id", "license", "n_shared", "n_shingles", (F.col("pos") + F.array_min("places")).alias("low"), (F.col("pos") + F.array_max("places") + SHINGLE).alias("high"))
    return _owners(judged.unionByName(_short_matches(texts, short, broadcast_rows)).distinct(), scratch)


def _owners(matches: DataFrame, scratch: Scratch) -> DataFrame:
    """The matches that own at least half of their words, the best of each document and template."""
    rank = [F.floor(F.col("n_shared") * 1000 / F.col("n_shingles")).alias("share"), (F.col("high") - F.col("low")).alias("length"), (-F.col("low")).alias("back"), (-F.col("template_id")).alias("id")]
    matches = scratch.keep(matches.withColumn("rank", F.struct(*rank)), "matches")
    words = matches.select("doc_id", "part", "template_id", "low", "rank", F.explode(F.sequence("low", F.col("high") - 1)).alias("word"))
    owners = words.groupBy("doc_id", "part", "word").agg(F.max("rank").alias("rank")).groupBy("doc_id", "part", "rank").agg(F.count("*").alias("owned"))
    standing = matches.join(owners, ["doc_id", "part", "rank"]).where(F.col("owned") * 2 >= F.col("high") - F.col("low"))
    best = standing.groupBy("doc_id", "template_id", "license").agg(F.max(F.struct("n_shared", (-F.col("low")).alias("back"), "n_shingles")).alias("b"))
    return best.select("doc_id", "template_id", "license", F.col("b.n_shared").cast("long").alias("n_shared"), F.col("b.n_shingles").cast("long").alias("n_shingles"), (-F.col("b.back")).cast("long").alias("first_word"))


#: Most different words by which texts are passed over before short templates are sought.
GATE_WORDS = 64


def _short_matches(texts: DataFrame, short: DataFrame, broadcast_rows: int) -> DataFrame:
    """Matches of templates of fewer than five words; a text must hold some template's longest word."""
    sizes = sorted(r.length for r in short.select("length").distinct().collect()) or [SHINGLE - 1]
    longest = F.element_at(F.array_sort(F.transform("tokens", lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), 1)["w"]
    gates = [r.w for r in short.select(longest.alias("w")).distinct().limit(GATE_WORDS + 1).collect()]
    if len(gates) <= GATE_WORDS:
        low = F.lower("body")
        texts = texts.where(reduce(lambda a, b: a | b, (F.contains(low, F.lit(w)) for w in gates), F.lit(False)))
    whole = lambda tokens, i, n: F.xxhash64(F.lit(n), *(F.get(tokens, i + j) for j in range(n))).alias(f"h{n}")
    at = lambda tokens, i: F.struct(*(whole(tokens, i, n) for n in sizes))
    known = short.select("template_id", "license", "length", at(F.col("tokens"), F.lit(0)).alias("t")).select("template_id", "license", "length", "t.*")
    first = f"h{sizes[0]}"
    known = known.select("template_id", "license", "length", first, *(F.when(F.col("length") == n, F.col(f"h{n}")).alias(f"t{n}") for n in sizes))
    words = texts.select("doc_id", "part", _tokens(F.col("body")).alias("tokens"))
    words = words.select("doc_id", "part", F.posexplode_outer(F.transform("tokens", lambda w, i: at(F.col("tokens"), i))).alias("pos", "h")).select("doc_id", "part", "pos", "h.*")
    known = known.where(f"{first} is not null")
    found = words.join(F.broadcast(known) if short.count() <= broadcast_rows else known, first).where(" or ".join(f"h{n} = t{n}" for n in sizes))
    return found.select("doc_id", "part", "template_id", "license", F.lit(1).alias("n_shared"), F.lit(1).alias("n_shingles"), F.col("pos").alias("low"), (F.col("pos") + F.col("length")).alias("high"))
