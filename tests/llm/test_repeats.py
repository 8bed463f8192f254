"""Repeated lines and passages against plain versions."""

import collections
import re

import pytest

from turnstone.llm import substring_dedup

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, _spans string, part long"


def spans_of(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted((r.doc_id, r.start, r.stop, r.n_words, r.passage, r.first_doc_id) for r in substring_dedup.repeated_spans(frame, **options).collect())


def words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


@pytest.mark.parametrize("limit", [500_000, -1])
def test_lines_passages_nulls_and_cut(spark, docs, empty, limit):
    passage, line = words("w", 60), words("l", 10)
    rows = [(5, f"Start of five {passage} end."), (2, passage), (9, f"x\n{passage.upper()}\ny"), (10, None), (11, ""), (12, f"one\n{line}"), (13, f"{line} \n two"), (14, "short line"), (15, "short line"), (None, passage), (16, " \n\t ")]
    want = [(5, 14, 14 + len(passage), 60, True, 2), (9, 2, 2 + len(passage), 60, True, 2), (13, 0, len(line), 10, False, 12)]
    assert spans_of(spark, rows, broadcast_rows=limit) == want
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    cut = substring_dedup.remove_repeats(frame, broadcast_rows=limit)
    assert cut.columns == frame.columns and cut.count() == len(rows)
    text = {r.doc_id: r.text for r in cut.collect()}
    assert text[2] == passage and text[5] == "Start of five  end." and text[9] == "x\n\ny" and text[10] is None and text[11] == "" and text[13] == " \n two" and text[15] == "short line"
    assert substring_dedup.repeated_spans(empty).count() == 0
    assert substring_dedup.repeated_spans(docs).where("doc_id = 7").count() == 1


def test_repeated_rows(spark):
    """Equal rows are one document; rows that share an id but not the text have spans of their own."""
    passage = words("w", 60)
    once = spans_of(spark, [(1, passage), (2, f"a {passage} b")])
    assert once == [(2, 2, 2 + len(passage), 60, True, 1)] and spans_of(spark, [(1, passage), (2, f"a {passage} b"), (2, f"a {passage} b"), (1, passage)]) == once
    rows = [(1, f"zero one\n{passage}"), (1, f"three {passage}")]
    got = spans_of(spark, rows)
    assert len(got) == 1 and got[0][3] == 60
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert sorted(len(r.text.split()) for r in substring_dedup.remove_repeats(frame).collect()) in ([1, 62], [2, 61])


def test_texts_that_repeat_themselves(spark):
    block = words("k", 70)
    rows = [(1, "foo " * 3000), (2, "foo " * 500), (3, f"{block} {words('m', 5)} {block}"), (4, "\n".join([words("n", 6)] * 4))]
    got = spans_of(spark, rows)
    assert sum(s[3] for s in got if s[0] == 1) == 2999 and sum(s[3] for s in got if s[0] == 2) == 500
    assert [s[3] for s in got if s[0] == 3] == [70] and sum(s[3] for s in got if s[0] == 4) == 18


def test_lines_and_long_passages_of_the_data(spark):
    """Every line of five words or more, and each word of 51 in a row, that an earlier place has."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = words("r", 51)
    rows = [(10**6, f"zero one {extra} two"), (10**6 + 1, f"three {extra} four"), (10**6 + 2, f"{extra}"), (10**6 + 3, " ".join(extra.split()[20:46]))]
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    seen, long, lines = set(), {}, {}
    for r in docs.orderBy("doc_id").collect():
        at = [m.span() for m in SPLIT.finditer(r.text or "")]
        w = [r.text[a:b].lower() for a, b in at]
        inside, own = set(), set()
        for i in range(len(w) - 50):
            key = hash(tuple(w[i : i + 51]))
            if key in seen:
                inside.update(range(i, i + 51))
            seen.add(key)
        first = 0
        for i in range(1, len(w) + 1):
            if i == len(w) or "\n" in r.text[at[i - 1][1] : at[i][0]]:
                key = ("line", *w[first:i])
                if i - first >= 5 and key in seen:
                    own.update(range(first, i))
                seen.add(key)
                first = i
        long[r.doc_id], lines[r.doc_id] = {at[i] for i in inside}, {at[i] for i in own}
    spans = collections.defaultdict(list)
    for r in substring_dedup.repeated_spans(docs).collect():
        spans[r.doc_id].append((r.start, r.stop))
    covered = lambda d, word: any(s <= word[0] and word[1] <= e for s, e in spans[d])
    assert sum(map(len, long.values())) > 5000 and sum(map(len, lines.values())) > 1000
    assert not [d for d, x in lines.items() if not all(covered(d, w) for w in x)]
    missed = sum(not covered(d, w) for d, x in long.items() for w in x)
    assert missed * 100 <= sum(map(len, long.values()))
    # Nothing else is covered but repeats that run on beyond 51 words.
    text = {r.doc_id: r.text for r in docs.collect()}
    extra_words = sum(not (m.span() in long[d] or m.span() in lines[d]) for d, x in spans.items() for m in SPLIT.finditer(text[d]) if any(s <= m.start() and m.end() <= e for s, e in x))
    assert extra_words * 100 <= sum(map(len, long.values()))
    assert all(a[1] < b[0] for x in spans.values() for a, b in zip(sorted(x), sorted(x)[1:], strict=False))
