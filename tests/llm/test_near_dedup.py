import random

import numpy as np

from turnstone.llm.common import text_words
from turnstone.llm.near_dedup import SKETCH_BITS, bands_needed, near_duplicates, parity_bitmap, sketch_limit


def groups(rows, percent):
    sets = {}
    for i, text in rows:
        w = text_words((text or "").encode())
        sets.setdefault(i, set()).update(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else sets.setdefault(i, set()).update([tuple(w)] if w else [])
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                    low = min(group[a], group[b])
                    group[a] = group[b] = low
                    changed = True
    return sets, group


def test_matches_brute_force(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    for percent in (80, 85):
        sets, group = groups(rows, percent)
        got = near_duplicates(docs, percent=percent).collect()
        assert len(got) == len(rows) + 1
        for r in got:
            if r.doc_id is None:
                assert r.component_id is None and r.kept
            else:
                assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), group[r.doc_id], group[r.doc_id] == r.doc_id)


def test_hot_near_copies_need_strays(spark):
    """A chain in which few texts link with the least one."""
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklm") for _ in range(6))
    base, texts = [word() for _ in range(100)], []
    for _ in range(60):
        w = list(base)
        for _ in range(r.randint(0, 4)):
            w[r.randrange(100)] = word()
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    _, group = groups(rows, 85)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=85).collect()
    assert {x.doc_id: x.component_id for x in got} == group


def test_empty(empty):
    assert near_duplicates(empty).count() == 0


def test_bitmap_never_flips_more_bits_than_elements_differ():
    r = np.random.default_rng(0)
    for n in (5, 200, 900):
        a = r.integers(0, 1 << 63, n, dtype=np.uint64)
        b = np.concatenate([a[: n // 2], r.integers(0, 1 << 63, 20, dtype=np.uint64)])
        apart = len(np.setxor1d(a, b))
        flipped = sum(bin(int(x) & (2**64 - 1)).count("1") for x in parity_bitmap(a) ^ parity_bitmap(b))
        assert flipped <= apart


def test_sampled_bitmaps_stay_under_the_limit():
    r = np.random.default_rng(3)
    most = 0
    for _ in range(300):
        n = 5000
        apart = int(n * 2 * 0.15 / 1.85 / 2)
        shared = r.integers(0, 1 << 63, n - apart, dtype=np.uint64) * np.uint64(2)
        sides = [np.concatenate([shared, r.integers(0, 1 << 63, apart, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]) for _ in range(2)]
        x = parity_bitmap(sides[0]) ^ parity_bitmap(sides[1])
        most = max(most, int(np.unpackbits(x.view(np.uint8)).sum()))
    assert most <= sketch_limit(85) < SKETCH_BITS // 2


def test_band_guarantee():
    for percent in (80, 85, 90):
        assert (1 - (percent / 100) ** 5) ** bands_needed(percent) <= 1e-6
