"""License notices: which one it is, by plain containment, and the bands' miss rate."""

import random
import re

from pyspark.sql import functions as F

from turnstone.llm import license_scan, queries


def tokens(t):
    return [w for w in re.split(r"\s+", re.sub(r"[^\w.\s]+|_|\.(?![0-9])", " ", (t or "").lower())) if w]


def shingles(w):
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def matches(spark, rows, **options):
    every = spark.createDataFrame([*license_scan.TEMPLATES, *license_scan.SHORT_TEMPLATES], "license string, text string")
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    return {(r.doc_id, r.license) for r in license_scan.license_matches(docs, every, **options).collect()}


def test_one_license_a_passage(spark, empty):
    words = " ".join(f"q{i}" for i in range(30))
    gpl = "This work is licensed under the GNU General Public License, version {}."
    rows = [(1, f"{words}\nLicensed under the Apache License, Version 2.0.\n{words}"), (2, words), (3, None), (4, "Released under the MIT License."), (5, "under the MIT"), (None, "Released under the MIT License."), (6, f"{words} {gpl.format(3)} {words}"), (7, ""), (8, gpl.format(2) + " " + gpl.format(3)), (9, gpl.format(2))]
    rows += [rows[0], (1, "Released under the MIT License.")]
    for limit in (500_000, -1):
        assert matches(spark, rows, broadcast_rows=limit) == {(1, "Apache-2.0"), (1, "MIT"), (4, "MIT"), (6, "GPL-3.0"), (8, "GPL-2.0"), (8, "GPL-3.0"), (9, "GPL-2.0")}
    assert license_scan.license_matches(empty).count() == 0
    assert matches(spark, [(1, "all rights reserved. " * 3000 + "Licensed under the Apache License, Version 2.0. " * 3000)]) == {(1, "Apache-2.0"), (1, "All-rights-reserved")}


def test_every_template_is_itself(spark):
    """Each notice alone, with one word in twenty changed, is reported as its own license only."""
    r = random.Random(2)
    rows, want = [], set()
    for i, (name, text) in enumerate([*license_scan.TEMPLATES, *license_scan.SHORT_TEMPLATES]):
        rows.append((i, text))
        want.add((i, name))
        w = text.split()
        if len(w) > 40:
            w[r.randrange(20, len(w) - 10)] = "changedword"
            rows.append((1000 + i, "x y z " + " ".join(w)))
            want.add((1000 + i, name))
    got = matches(spark, rows)
    assert want <= got
    same = {"GPL-2.0": {"GPL"}, "GPL-3.0": {"GPL"}, "GPL": {"GPL-2.0", "GPL-3.0"}, "LGPL": {"LGPL-2.1", "LGPL-3", "LGPL-3.0"}, "LGPL-3": {"LGPL", "LGPL-3.0"}, "LGPL-2.1": {"LGPL"}}
    names = {i: n for i, n in want}
    assert not {(i, n) for i, n in got - want if n not in same.get(names[i], ()) and not n.startswith("SPDX")}


def test_matches_plain_containment(spark):
    """Every template against every window of its length, by sets; the best of those that overlap."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = set()
    for r in docs.collect():
        w, hits = tokens(r.text), []
        for k, (name, text) in enumerate(license_scan.TEMPLATES):
            t = shingles(tokens(text))
            n = len(tokens(text))
            for i in range(max(1, len(w) - n + 1)):
                own = [j for j in range(i, min(i + n, len(w)) - 4) if tuple(w[j : j + 5]) in t]
                shared = len({tuple(w[j : j + 5]) for j in own})
                if shared * 100 >= 80 * len(t):
                    hits.append((shared * 1000 // len(t), own[-1] + 5 - own[0], -own[0], k, name))
        owner = {}
        for h in sorted(hits):
            owner.update(dict.fromkeys(range(-h[2], -h[2] + h[1]), h))
        want |= {(r.doc_id, h[4]) for h in hits if sum(o == h for o in owner.values()) * 2 >= h[1]}
    assert {(r.doc_id, r.license) for r in license_scan.license_matches(docs).collect()} == want and want


def test_notices_of_the_data(spark):
    """Every notice that stands in the documents, by plain search, and no other license; and short forms."""
    kinds = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3."}
    kinds |= {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "All-rights-reserved": "All rights reserved."}
    texts = {r.doc_id: " ".join((r.text or "").split()) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    want = {(d, k) for d, t in texts.items() for k, notice in kinds.items() if notice in t}
    found = {(r.doc_id, r.license) for r in queries.op4_license_scan(spark, "/root/testdata/sf0.01").collect()}
    assert {k for _, k in want} == set(kinds) and found == want
    rows = [(1, "SPDX-License-Identifier: MIT"), (2, "all rights\nreserved"), (3, "all rights"), (4, "x SPDX-License-Identifier: LGPL-3.0-only"), (5, "under CC BY-SA 4.0, see"), (6, "CC BY"), (7, None), (8, "CC0 1.0")]
    rows += [(9, "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"), (10, "rights reserved all")]
    assert matches(spark, rows) == {(1, "MIT"), (2, "All-rights-reserved"), (4, "LGPL-3.0"), (5, "CC-BY-SA-4.0"), (8, "CC0-1.0"), (9, "AGPL-3.0")}


def test_bands_miss_less_than_one_in_ten_thousand(spark):
    """Pairs of shingle sets at the least similarity that a match has: two thirds."""
    for n in (6, 10, 15):
        both = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.xxhash64("id", i))
        apart = lambda side: F.transform(F.sequence(F.lit(1), F.lit(n // 5)), lambda i: F.xxhash64(F.lit(side), "id", i))
        a, b = F.concat(F.slice(both, n // 5 + 1, n), apart("a")), F.concat(F.slice(both, n // 5 + 1, n), apart("b"))
        missed = spark.range(20_000).where(~F.arrays_overlap(license_scan._band_keys(a), license_scan._band_keys(b))).count()
        assert missed <= 2
