"""Enrichment: embeddings, theme documents and labels, freshness, search hits."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnstone.functions.columns import joined_ordered, squeeze

#: A batch of texts to a batch of vectors; any provider fits this shape.
Embedder = Callable[[Sequence[str]], Sequence[Sequence[float]]]
BATCH = 96
DOC_CHARS = 1500
#: The search service's bounds.
MOST_HITS, MOST_FETCHED = 50, 200


def hashing_embedder(width: int = 64) -> Embedder:
    """A deterministic bag of words, for tests and for use without a model."""

    def embed(texts: Sequence[str]) -> list[list[float]]:
        out = np.zeros((len(texts), width))
        for i, text in enumerate(texts):
            for token in text.lower().split():
                out[i, int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % width] += 1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return (out / np.where(norm == 0, 1, norm)).tolist()

    return embed


def embed_texts(texts: DataFrame, embedder: Embedder, id_col: str, text_col: str, batch: int = BATCH) -> DataFrame:
    """(*id_col*, dim, embedding) of rows whose text isn't blank, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, batch):
                piece = b.slice(start, batch)
                vectors = embedder(piece.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([len(v) for v in vectors], pa.int32()), pa.array(vectors, pa.list_(pa.float32()))], names=["id", "dim", "embedding"])

    some = texts.where(squeeze(F.col(text_col)) != "").select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("t"))
    return some.mapInArrow(run, "id string, dim int, embedding array<float>").withColumnRenamed("id", id_col)


def theme_documents(texts: DataFrame, subject: str, name: str, order: str, text_col: str, chars: int = DOC_CHARS) -> DataFrame:
    """One document per subject: its name, a line end, and the start of its texts in order."""
    docs = texts.groupBy(subject, name).agg(joined_ordered(F.when(squeeze(F.col(text_col)) != "", F.col(text_col)), F.col(order), " ").alias("_body"))
    doc = F.concat(F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit("\n"), F.substring("_body", 1, chars))
    return docs.where(F.col("_body").isNotNull()).select(subject, doc.alias("document"))


def answered_themes(answers: DataFrame, id_col: str, answer_col: str, theme_ids: Sequence[str], top: int = 3) -> DataFrame:
    """Known ids in a model's answers: longest first in matching, ranked by first occurrence."""
    import re

    pattern = "|".join(re.escape(t) for t in sorted(theme_ids, key=lambda t: (-len(t), t)))
    found = F.slice(F.array_distinct(F.regexp_extract_all(F.col(answer_col), F.lit(pattern), 0)), 1, top)
    return answers.select(id_col, F.posexplode(found).alias("i", "theme_id")).select(id_col, "theme_id", (F.col("i") + 1).alias("rank"), F.lit(None).cast("float").alias("score"))


def signatures(texts: DataFrame, partitions: list[str], id_col: str, text_col: str) -> DataFrame:
    """A content signature per partition, whatever the order of its rows.

    Each row's id and text give one hash; two sums over its halves and the
    count of rows are combined before the shuffle, so that a partition of any
    size costs one row a task.
    """
    each = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("\x00"), F.md5(F.coalesce(text_col, F.lit("")))))
    half = lambda start: F.sum(F.conv(F.substring("_row", start, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    return texts.withColumn("_row", each).groupBy(*partitions).agg(F.concat_ws("-", half(1), half(16), F.count("*").cast("string")).alias("signature"))


def stale(now: DataFrame, stored: DataFrame, partitions: list[str]) -> DataFrame:
    """Partitions that are new or whose content changed."""
    return now.join(stored.select(*partitions, "signature"), [*partitions, "signature"], "left_anti")


def orphans(derived: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of *derived* whose keys the source no longer has: what a prune deletes."""
    return derived.join(source.select(*keys).distinct(), keys, "left_anti")


def speaker_tier(kind: Column, speaker: Column) -> Column:
    """0: a named speaker's speech, question or answer; 1: any speaker; 2: the rest."""
    return F.when(speaker.isNotNull() & kind.isin("speech", "question", "answer"), 0).when(speaker.isNotNull(), 1).otherwise(2)


def fetch_size(k: int) -> int:
    """Hits to fetch before re-ranking."""
    return min(MOST_FETCHED, max(4 * min(k, MOST_HITS), 40))


def hydrate(hits: DataFrame, texts: DataFrame, subjects: DataFrame, talkers: DataFrame) -> DataFrame:
    """Metadata of hits (text_id, score), best first; hits whose text is gone vanish, and no prose is returned.

    The best MOST_FETCHED hits, which are all that a search fetches, are broadcast.
    """
    hits = hits.orderBy(F.col("score").desc(), "text_id").limit(MOST_FETCHED)
    where = texts.select("text_id", "subject_id", "talker_id", "jurisdiction", "date", "house", "page_no")
    named = where.join(F.broadcast(hits), "text_id").join(subjects.select("subject_id", F.col("name").alias("subject")), "subject_id", "left")
    return named.join(talkers.select("talker_id", F.col("name").alias("speaker"), F.col("kind").alias("talker_kind")), "talker_id", "left").orderBy(F.col("score").desc(), "text_id")
