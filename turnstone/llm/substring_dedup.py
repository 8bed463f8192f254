"""Repeated lines and passages by hashing units (operator 10).

Lines are normalised (A-Z in lower case, white space as one space) and their
digests grouped over all documents; the earliest ranked occurrence stays and
every other one is removed, with its original offsets.  Lines of fewer than
``line_words`` words, which repeat by chance, stay.

Passages that are spliced into other lines have no lines of their own, so
windows of words are units too.  Of every ``gram`` windows of ``gram`` words
in a row the one with the least hash is chosen: texts that share a passage of
``2 * gram - 1`` words share a chosen window.  A text's first occurrence of a
window is aligned with the first one of the earliest text that has it, each
further one with the one before it in its own text, and extended over equal words to both
sides; what then has at least ``2 * gram - 1`` words is removed.  The windows' hash is
built from MD5 so that SQL can choose the same windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Scratch, free_name, mix, slices
from .wordarrays import Md5Words, Sums, Texts, sliding

LINE_WORDS = 5
GRAM = 26
#: Words of the shortest passage that is removed outside whole lines.
PASSAGE = 2 * GRAM - 1
_BATCH = 256
#: Kinds of units; for a run of windows that its own text has already, ``words``
#: is the last one's first word and ``start`` its distance from the one before.
WINDOW, LINE, AGAIN = 0, 1, 2
_UNITS = "doc bigint, part bigint, digest bigint, kind int, word int, words int, start int, stop int"
_EDGES = "doc bigint, part bigint, word int, side int, near array<int>, offsets array<int>"


def chosen_windows(h: np.ndarray, text: np.ndarray, gram: int) -> np.ndarray:
    """Places of windows that are the least of some *gram* windows in a row of one text."""
    n = len(h) - (2 * gram - 2)
    if n <= 0:
        return np.zeros(0, np.int64)
    sums = Sums(h)
    grams = sums.of(slice(0, len(h) - gram + 1), slice(gram, len(h) + 1))
    least = sliding(np.minimum, grams, gram)
    least[text[:n] != text[2 * gram - 2 :]] = 0
    edge = np.zeros(gram - 1, np.uint64)
    return np.flatnonzero((sliding(np.maximum, np.concatenate([edge, least, edge]), gram) == grams) & (grams > 0))


def _unit_rows(line_words: int, gram: int):
    def rows(docs: np.ndarray, parts: np.ndarray, texts: Texts, md5: Md5Words) -> pa.RecordBatch:
        sums = Sums(texts.key)
        turn = np.ones(len(texts), bool)
        turn[1:] = (texts.line[1:] != texts.line[:-1]) | (texts.text[1:] != texts.text[:-1])
        first = np.flatnonzero(turn)
        last = np.append(first[1:], len(texts)).astype(np.int64)[: len(first)]
        long = last - first >= line_words
        first, last = first[long], last[long]
        windows = chosen_windows(md5.of(texts), texts.text, gram)
        value = mix(sums.of(windows, windows + gram) + np.uint64(2 * gram))
        # Occurrences of a window in a text, each after the one before it.
        order = np.lexsort((windows, value, texts.text[windows]))
        at = windows[order]
        twice = np.flatnonzero((value[order][1:] == value[order][:-1]) & (texts.text[at[1:]] == texts.text[at[:-1]])) + 1
        single = np.ones(len(windows), bool)
        single[order[twice]] = False
        own, back = at[twice], at[twice] - at[twice - 1]
        order = np.lexsort((own, back, texts.text[own]))
        own, back = own[order], back[order]
        begins = np.ones(len(own), bool)
        begins[1:] = (np.diff(own) > gram) | (back[1:] != back[:-1]) | (texts.text[own[1:]] != texts.text[own[:-1]])
        low = np.flatnonzero(begins)
        high = np.append(low[1:], len(own)).astype(np.int64)[: len(low)] - 1

        singles = windows[single]
        start = np.concatenate([singles, first, own[low]])
        kind = np.repeat([WINDOW, LINE, AGAIN], [len(singles), len(first), len(low)])
        lines = mix(sums.of(first, last) + (last - first).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        digest = np.concatenate([value[single], lines, np.zeros(len(low), np.uint64)])
        text = texts.text[start]
        none = np.zeros(len(singles), np.int64)
        words = np.concatenate([none + gram, last - first, own[high] - texts.first[texts.text[own[high]]]])
        # Offsets of windows come with their edges later.
        begin, stop = np.concatenate([none, texts.begin[first], -back[low]]), np.concatenate([none, texts.stop[last - 1], np.zeros(len(low), np.int64)])
        numbers = [kind, start - texts.first[text], words, begin, stop]
        return pa.RecordBatch.from_arrays([pa.array(docs[text]), pa.array(parts[text]), pa.array(digest.view(np.int64)), *(pa.array(x.astype(np.int32)) for x in numbers)], names=[x.split()[0] for x in _UNITS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        md5 = Md5Words()
        with np.errstate(over="ignore"):
            for batch in batches:
                for a, b in slices(batch.num_rows, _BATCH):
                    piece = batch.slice(a, b - a)
                    texts = Texts(piece.column(2))
                    if len(texts):
                        yield rows(*(piece.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)), texts, md5)

    return run


def _lists(values: np.ndarray, valid: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(valid.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[valid].astype(np.int32)))


def _edge_rows(gram: int):
    """Words beside windows, nearest first: side 0 before the first word, 1 after the last.

    ``offsets`` has the edge's code point without, with one, with two ... of them.
    """

    def rows(docs: np.ndarray, parts: np.ndarray, texts: Texts, wanted: list[list[int]]) -> pa.RecordBatch:
        own = np.repeat(np.arange(len(docs)), [len(x) for x in wanted])
        marks = np.array([m for x in wanted for m in x], np.int64)
        word, side = marks >> 1, marks & 1
        at = word + texts.first[own] + np.where(side == 1, gram - 1, 0)
        ok = at < texts.first[own + 1]
        own, word, side, at = own[ok], word[ok], side[ok], at[ok]
        step = np.where(side == 1, 1, -1)[:, None] * np.arange(gram)[None, :]
        index = at[:, None] + step
        valid = (index >= texts.first[own][:, None]) & (index < texts.first[own + 1][:, None])
        index = np.where(valid, index, 0)
        near = (texts.key[index] >> np.uint64(32)).astype(np.uint32).view(np.int32)
        offsets = np.where(side[:, None] == 1, texts.stop[index], texts.begin[index])
        arrays = [pa.array(docs[own]), pa.array(parts[own]), pa.array(word.astype(np.int32)), pa.array(side.astype(np.int32)), _lists(near[:, 1:], valid[:, 1:]), _lists(offsets, valid)]
        return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in _EDGES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for a, b in slices(batch.num_rows, _BATCH):
                    piece = batch.slice(a, b - a)
                    texts = Texts(piece.column(2))
                    if len(texts):
                        yield rows(*(piece.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)), texts, piece.column(3).to_pylist())

    return run


def _same(near: Column, other: Column) -> Column:
    """How many leading elements of two arrays are equal."""
    equal = F.zip_with(near, other, lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(equal, F.lit(False))
    return F.when(at > 0, at - 1).otherwise(F.size(equal)).cast("int")


def _merged(spans: DataFrame) -> DataFrame:
    """Spans of a text that overlap or touch, as one."""
    order = Window.partitionBy("doc", "part").orderBy("word", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("begins", F.when(F.col("word") <= reach, 0).otherwise(1)).withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return spans.groupBy("doc", "part", "run").agg(*(f(c).alias(c) for f, c in ((F.min, "word"), (F.max, "end"), (F.min, "start"), (F.max, "stop"), (F.min, "first_doc")))).drop("run")


def _spans(source: DataFrame, line_words: int, gram: int, broadcast_rows: int, scratch: Scratch) -> DataFrame:
    """doc, part, word, end, start, stop, first_doc of what is removed; *source* has doc, part and body."""
    every = scratch.keep(source.mapInArrow(_unit_rows(line_words, gram), _UNITS), "units")
    place = F.struct("doc", "part", "word")
    grouped = every.where(F.col("kind") != AGAIN)
    known = grouped.groupBy("digest").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last")
    known = scratch.keep(known.select("digest", F.col("first.doc").alias("first_doc"), F.col("first.part").alias("first_part"), F.col("first.word").alias("first_word")), "known")
    again = grouped.join(known, "digest").where("doc > first_doc or (doc = first_doc and (part > first_part or (part = first_part and word > first_word)))")
    again = scratch.keep(again.drop("digest"), "again")
    lines = again.where(F.col("kind") == LINE).select("doc", "part", "word", (F.col("word") + F.col("words")).alias("end"), "start", "stop", "first_doc")

    # Windows whose alignment stays the same and that leave no gap are one run.
    aligned = ["doc", "part", "first_doc", "first_part", "shift"]
    windows = again.where(F.col("kind") == WINDOW).withColumn("shift", F.col("first_word") - F.col("word"))
    by_word = Window.partitionBy(*aligned).orderBy("word")
    begins = F.when(F.col("word") - F.lag("word").over(by_word) <= gram, 0).otherwise(1)
    runs = windows.withColumn("begins", begins).withColumn("run", F.sum("begins").over(by_word))
    runs = runs.groupBy(*aligned, "run").agg(F.min("word").alias("low"), F.max("word").alias("high"))
    own = every.where(F.col("kind") == AGAIN).select("doc", "part", F.col("doc").alias("first_doc"), F.col("part").alias("first_part"), F.col("start").alias("shift"), (-F.col("word") - 1).cast("long").alias("run"), F.col("word").alias("low"), F.col("words").alias("high"))
    runs = scratch.keep(runs.withColumn("run", F.col("run").cast("long")).unionByName(own), "runs")

    sides = F.explode(F.array(*(F.struct(F.lit(side).alias("side"), F.col(c).alias("word")) for side, c in ((0, "low"), (1, "high")))))
    edges = runs.select(*aligned, "run", sides.alias("e")).select(*aligned, "run", "e.side", "e.word", (F.col("e.word") + F.col("shift")).alias("first_word"))
    wanted = edges.select("doc", "part", "word", "side").unionByName(edges.select(F.col("first_doc").alias("doc"), F.col("first_part").alias("part"), F.col("first_word").alias("word"), "side")).distinct()
    wanted = scratch.keep(wanted.groupBy("doc", "part").agg(F.collect_list(F.col("word") * 2 + F.col("side")).alias("wanted")), "wanted")
    beside = source.join(F.broadcast(wanted.select("doc", "part")) if wanted.count() <= broadcast_rows else wanted.select("doc", "part"), ["doc", "part"], "left_semi")
    beside = scratch.keep(beside.join(wanted, ["doc", "part"]).select("doc", "part", "body", "wanted").mapInArrow(_edge_rows(gram), _EDGES), "beside")
    first = beside.select(F.col("doc").alias("first_doc"), F.col("part").alias("first_part"), F.col("word").alias("first_word"), "side", F.col("near").alias("other"))
    reached = edges.join(beside, ["doc", "part", "word", "side"]).join(first, ["first_doc", "first_part", "first_word", "side"])
    reached = reached.withColumn("reach", _same(F.col("near"), F.col("other"))).withColumn("edge", F.get("offsets", F.col("reach")))
    left, right = F.col("side") == 0, F.col("side") == 1
    passages = reached.groupBy(*aligned, "run").agg(
        F.min(F.when(left, F.col("word") - F.col("reach"))).alias("word"), F.max(F.when(right, F.col("word") + gram + F.col("reach"))).alias("end"), F.min(F.when(left, F.col("edge"))).alias("start"), F.max(F.when(right, F.col("edge"))).alias("stop")
    )
    passages = _merged(passages.select("doc", "part", "word", "end", "start", "stop", "first_doc")).where(F.col("end") - F.col("word") >= 2 * gram - 1)
    return _merged(lines.unionByName(passages))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    body = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(body).alias("part"), body.alias("body")).where("doc is not null")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, line_words: int = LINE_WORDS, gram: int = GRAM, broadcast_rows: int = 500_000) -> DataFrame:
    """One row per removed span: *id_col*, ``start``, ``stop``, ``n_words``, ``passage``, ``first_doc_id``.

    Offsets are code points of the original text, end exclusive.  Occurrences
    are ranked by document id, then by the text's hash where rows share an id,
    then by place; the first of each unit stays.  Removed lines and passages
    that overlap or touch are one span.  ``passage`` says that it has
    ``2 * gram - 1`` words or more, and ``first_doc_id`` is the least id that
    keeps a unit of the span, which may be the document itself.

    Null, empty and blank texts have no units.  Equal rows (id and text) are
    one document, whose spans are given once; rows that share an id but not the
    text are ranked apart, each with spans of its own.  Rows with a null id are
    ignored.  An empty table gives an empty result; other columns don't matter.

    Digests have 64 bits; a passage of wrongly equal digests is not extended
    and so falls short of its least length.  A digest's rows are combined
    before the shuffle, and the joins are ones that adaptive execution splits
    where a unit is very common.  The ids of documents that are read again for
    their passages' edges are broadcast up to *broadcast_rows*, shuffled beyond.
    """
    scratch = Scratch(docs.sparkSession, "repeats")
    spans = _spans(_source(docs, id_col, text_col), line_words, gram, broadcast_rows, scratch)
    n_words = (F.col("end") - F.col("word")).cast("long")
    return spans.select(F.col("doc").alias(id_col), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), n_words.alias("n_words"), (n_words >= 2 * gram - 1).alias("passage"), F.col("first_doc").alias("first_doc_id"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, line_words: int = LINE_WORDS, gram: int = GRAM, broadcast_rows: int = 500_000) -> DataFrame:
    """*docs* with the spans of ``repeated_spans`` cut from the text; every row and column stays."""
    scratch = Scratch(docs.sparkSession, "cut")
    cut, own, part = (free_name(docs, n) for n in ("_spans", "_doc", "_part"))
    spans = _spans(_source(docs, id_col, text_col), line_words, gram, broadcast_rows, scratch)
    spans = scratch.keep(spans.groupBy(F.col("doc").alias(own), F.col("part").alias(part)).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias(cut)), "spans")
    text = F.col(text_col).cast("string")
    joined = docs.withColumns({own: F.col(id_col).cast("long"), part: F.xxhash64(text)}).join(spans, [own, part], "left")
    ends = F.concat(F.array(F.lit(0)), F.transform(cut, lambda s: s["stop"]))
    starts = F.concat(F.transform(cut, lambda s: s["start"]), F.array(F.length(text)))
    kept = F.array_join(F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a)), "")
    return joined.withColumn(text_col, F.when(F.col(cut).isNull(), text).otherwise(kept)).select(*docs.columns)
