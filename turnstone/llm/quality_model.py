"""Quality classifier from weak labels (operator 2).

Overlapping heuristic labellers vote good, bad or abstain on every document.
Expectation-maximisation over the counts of vote patterns estimates how often
each labeller is right on good and on bad documents.  The patterns' posterior
probabilities label a bounded sample, on which a logistic scorer over hashed
features is trained; it then scores every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, sample_rows, slices
from .wordarrays import LOWER, Sums, Texts

#: Labellers, in the order of a pattern's base-3 digits (0 abstain, 1 bad, 2 good).
LABELLERS = ("symbols", "capitals", "repeats", "stutters", "lines", "word_length", "prose", "sentences", "variety")
#: Bound of the sample that the scorer is trained on, in documents.
SAMPLE_DOCS = 6000
BINS = 1 << 16
STEPS = 100

_PLAIN = re.compile(r"[\"'(]?[^\W\d_]+(?:['’-][^\W\d_]+)*[\"')]?[,.;:!?]?[\"')]?")
_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[list(b"#*$%&|<>")] = True
#: Texts that are worked on at once.
_TEXTS = 256


def pattern_of(votes: np.ndarray) -> np.ndarray:
    """Rows of votes (0 abstain, 1 bad, 2 good) as one number each."""
    return votes @ 3 ** np.arange(len(LABELLERS) - 1, -1, -1)


def digits(patterns: np.ndarray) -> np.ndarray:
    k = len(LABELLERS)
    return patterns[:, None] // 3 ** np.arange(k - 1, -1, -1)[None, :] % 3


def fit_labellers(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, float, np.ndarray]:
    """(share[class, labeller, vote], share of good, posterior of good per pattern) by EM.

    Most labellers can only find fault, so an abstention is a vote like the
    others.  A text that any of them faults starts as probably bad, which
    tells the two classes apart.
    """
    seen = digits(patterns)
    posterior = np.where((seen == 1).any(axis=1), 0.1, 0.95)
    one_hot = seen[:, :, None] == np.arange(3)
    share, prior = np.full((2, len(LABELLERS), 3), 1 / 3), 0.5
    for _ in range(rounds):
        weight = np.stack([1 - posterior, posterior]) * counts
        prior = float((weight[1].sum() + 1) / (weight.sum() + 2))
        share = np.einsum("cp,plv->clv", weight, one_hot) + 1
        share /= share.sum(axis=2, keepdims=True)
        log = np.log([[1 - prior], [prior]]) + np.einsum("clv,plv->cp", np.log(share), one_hot)
        posterior = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
    return share, prior, posterior


def _bin(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) % (BINS - 8) + 8


def shape_of(word: str) -> tuple[int, int]:
    """The hashed shape of a word, and whether it is plain.

    A shape has A, a and 9 for runs of letters and digits.  A plain word has
    letters in no shouting case and at most one mark after them.
    """
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"\d", "9", re.sub(r"[^\W\d_]", lambda m: "A" if m[0].isupper() else "a", word)))
    return _bin("s" + shape), int(bool(_PLAIN.fullmatch(word)) and not (len(word) > 2 and word.isupper()))


_MARKS = ".,;:!?"
#: Bins of the shapes that most words have: in lower case or title case, without a mark or with one.
_SIMPLE = np.array([[_bin("s" + case + mark) for mark in ("", *_MARKS)] for case in ("a", "Aa")])
_MARK_NUMBER = np.zeros(256, np.int64)
_MARK_NUMBER[list(_MARKS.encode())] = np.arange(1, len(_MARKS) + 1)


class Shapes(dict):
    """``shape_of`` by the key of a word, remembered up to a bounded number of words."""

    LIMIT = 300_000

    def of(self, texts: Texts) -> np.ndarray:
        """A row per word: bins of its shape, length, first and last three bytes and itself, its length and whether it is plain."""
        keys, at, back = np.unique(texts.key, return_index=True, return_inverse=True)
        if len(self) > self.LIMIT:
            self.clear()
        start, end, raw = texts.start[at], texts.end[at], texts.bytes
        upto = lambda mask: np.concatenate([[0], np.cumsum(mask)])
        lower, points = upto((raw >= 97) & (raw <= 122)), upto((raw & 0xC0) != 0x80)
        mark = _MARK_NUMBER[raw[end - 1]] if len(raw) else np.zeros(0, np.int64)
        core = end - (mark > 0)
        small, size = lower[core] - lower[start], core - start
        title = (size > 1) & (small == size - 1) & (raw[start] >= 65) & (raw[start] <= 90) if len(raw) else np.zeros(0, bool)
        simple = (size > 0) & (small == size)
        shape, plain = np.where(title, _SIMPLE[1][mark], _SIMPLE[0][mark]), np.ones(len(at), np.int64)
        for i in np.flatnonzero(~(simple | title)).tolist():
            key = int(keys[i])
            found = self.get(key)
            if found is None:
                found = self[key] = shape_of(texts.word(at[i]).decode())
            shape[i], plain[i] = found
        length = points[end] - points[start]
        ends = np.zeros((2, len(at)), np.uint64)
        for j in range(3):
            inside = end - start > j
            for side, place in enumerate((start + j, end - 1 - j)):
                byte = LOWER[raw[np.where(inside, place, start)]] if len(raw) else np.zeros(0, np.uint8)
                ends[side] = ends[side] * np.uint64(256) + np.where(inside, byte, 0).astype(np.uint64)
        number = lambda x, salt: (mix(x + np.uint64(salt)) % np.uint64(BINS - 8)).astype(np.int64) + 8
        bins = [shape, number((length // 3).astype(np.uint64), 1 << 40), number(ends[0], 2 << 40), number(ends[1], 3 << 40), number(keys, 4 << 40)]
        return np.stack([*bins, length, plain], axis=1)[back]


#: Shared by the tasks of a worker: later ones find the words that the first ones saw.
_words = Shapes()


class Measured:
    """Votes and features of a column of texts."""

    def __init__(self, column: pa.Array):
        with np.errstate(over="ignore"):
            self._measure(Texts(column, fold=False))

    def _measure(self, texts: Texts) -> None:
        n, count = texts.counts, len(texts.counts)
        of = texts.text
        some = np.maximum(n, 1)
        per_text = lambda x: np.bincount(of, x, count)
        words = _words.of(texts)

        def distinct(value: np.ndarray, owner: np.ndarray) -> np.ndarray:
            """Different values of each text."""
            order = np.lexsort((value, owner))
            value, owner = value[order], owner[order]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
            return np.bincount(owner[new], minlength=count)

        sums = Sums(texts.key)

        def windows(size: int) -> np.ndarray:
            """The share of a text's windows of *size* words that it has already."""
            at = np.arange(max(len(of) - size + 1, 0))
            at = at[of[at] == of[at + size - 1]]
            total = np.maximum(n - size + 1, 0)
            return np.where(total > 0, 1 - distinct(sums.of(at, at + size), of[at]) / np.maximum(total, 1), 0.0)

        again = np.zeros(len(of), bool)
        again[1:] = (texts.key[1:] == texts.key[:-1]) & (of[1:] == of[:-1])
        stutters = per_text(again) / some
        turn = np.ones(len(of), bool)
        turn[1:] = (texts.line[1:] != texts.line[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(turn)
        lines = sums.of(first, np.append(first[1:], len(of)).astype(np.int64)[: len(first)])
        doubled = 1 - distinct(lines, of[first]) / np.maximum(np.bincount(of[first], minlength=count), 1)
        byte_sums = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[texts.offsets])
        symbols = byte_sums(_SYMBOL_BYTES[texts.bytes]) / some
        capitals = byte_sums((texts.bytes >= 65) & (texts.bytes <= 90)) / np.maximum(byte_sums((texts.bytes & 0xC0) != 0x80), 1)
        stops = byte_sums(texts.bytes == 46) / some
        length, plain, variety = per_text(words[:, 5]) / some, per_text(words[:, 6]) / some, distinct(texts.key, of) / some
        vote = lambda bad: bad.astype(np.int64)
        votes = np.stack([
            vote(symbols > 0.1), vote((capitals > 0.4) & (n >= 5)), vote(windows(5) > 0.25), vote(stutters > 0.2), vote(doubled > 0.45), vote((length < 2.5) | (length > 9)),
            np.where(plain > 0.9, 2, vote(plain < 0.5)), np.where((stops >= 1 / 60) & (stops <= 1 / 3), 2, 0), np.where(n >= 30, np.where(variety > 0.3, 2, vote(variety < 0.15)), 0),
        ], axis=1)
        votes[n == 0] = 1
        self.n_words, self.votes, self.pattern = n, votes, pattern_of(votes)
        # Square roots of the shares of a text's features; bins below 8 hold the constant and two shares of repeats.
        pairs = (of[:, None] * BINS + words[:, :5]).ravel()
        cells, times = np.unique(pairs, return_counts=True)
        owner = cells // BINS
        every = np.arange(count)
        self.owner = np.concatenate([every, every, every, owner])
        self.bins = np.concatenate([np.full(count, 1), np.full(count, 2), np.full(count, 3), cells % BINS])
        self.values = np.sqrt(np.concatenate([np.ones(count), stutters, windows(3), times / some[owner]]))

    def rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(bins, values) of each text."""
        order = np.argsort(self.owner, kind="stable")
        ends = np.searchsorted(self.owner[order], np.arange(len(self.n_words) + 1))
        return [(self.bins[order[a:b]], self.values[order[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, steps: int = STEPS, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Weights of a logistic model on soft labels, by full gradient steps from zero."""
    weights = np.zeros(BINS)
    if not rows:
        return weights
    bins, values = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r[0]) for r in rows])
    speed = np.full(BINS, 1e-8)
    for _ in range(steps):
        score = 1 / (1 + np.exp(-np.bincount(owner, weights[bins] * values, len(rows))))
        gradient = np.bincount(bins, (score - labels)[owner] * values, BINS) / len(rows) + decay * weights
        speed += gradient**2
        weights -= rate * 0.1 * gradient / np.sqrt(speed)
    return weights


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.num_rows, _TEXTS):
            yield pa.RecordBatch.from_arrays([pa.array(Measured(batch.column(1).slice(a, b - a)).pattern.astype(np.int32))], names=["pattern"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.num_rows, _TEXTS):
            found = Measured(batch.column(1).slice(a, b - a))
            cells = [(bins.astype("<i4").tobytes(), values.astype("<f4").tobytes()) for bins, values in found.rows()]
            yield pa.RecordBatch.from_arrays([pa.array(found.pattern.astype(np.int32)), *(pa.array(x, pa.binary()) for x in zip(*cells, strict=True))], names=["pattern", "bins", "values"])


def classify_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample_docs: int = SAMPLE_DOCS, threshold: float = 0.5, seed: int = 2) -> DataFrame:
    """One row per document: the id, ``n_words``, ``score``, ``kept``.

    ``score`` is the trained scorer's probability that the text is good,
    rounded to six places, and ``kept`` says that it reaches *threshold*.  Counts of patterns cover all documents; there
    are at most 3 ** 9 of them.  The scorer learns from at most *sample_docs*
    documents, the first by a seeded hash of id and text.

    Null and empty texts have no words and score zero.  Null
    ids stay null; repeated rows are scored alike; an empty table gives an
    empty result; other columns are ignored.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    counted = source.mapInArrow(_patterns, "pattern int").groupBy("pattern").count().collect()
    patterns, counts = np.array([r["pattern"] for r in counted], np.int64), np.array([r["count"] for r in counted], np.float64)
    order = np.argsort(patterns)
    patterns, counts = patterns[order], counts[order]
    posterior = dict(zip(patterns.tolist(), fit_labellers(patterns, counts)[2].tolist() if len(patterns) else [], strict=True))
    sample = sample_rows(source, sample_docs, seed, int(counts.sum())).mapInArrow(_sampled, "pattern int, bins binary, values binary").collect()
    weights = fit_scorer([(np.frombuffer(r.bins, "<i4"), np.frombuffer(r["values"], "<f4")) for r in sample], np.array([posterior[r.pattern] for r in sample]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.num_rows, _TEXTS):
                piece = batch.slice(a, b - a)
                found = Measured(piece.column(1))
                s = np.bincount(found.owner, weights[found.bins] * found.values, len(found.n_words))
                s = np.where(found.n_words > 0, np.round(1 / (1 + np.exp(-s)), 6), 0.0)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(found.n_words.astype(np.int64)), pa.array(s), pa.array(s >= threshold)], names=["doc", "n_words", "score", "kept"])

    return source.mapInArrow(score, "doc bigint, n_words bigint, score double, kept boolean").withColumnRenamed("doc", id_col)
