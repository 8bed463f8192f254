"""MinHash near-duplicate groups with odd sketches (operator 9).

Every text becomes the set of its distinct word shingles.  Banded MinHash
keys find candidates, a parity bitmap folded from the set's MinHash sample
rejects most of the wrong ones, and full sets confirm each link.

* Equal sets form one class first, so thousands of exact copies weigh as one.
* Within a bucket every class is compared with the bucket's least class only,
  a star, and not with every other.  Classes that do not join that class's
  component ("strays") are then compared with the other members of their
  bucket, so no link between two components is lost.  Only pairs that pass
  the bitmap test leave that join, once each, in their first shared band.
  Two rounds confirm each stray's best pair, the last all that remain between
  components.
* The number of bands makes a pair at the threshold miss every band with a
  probability of at most ``miss``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordHashes, lean, mix, seeded, shingle_hashes, slices, text_words
from .components import connected_components

#: Bits of a parity bitmap and the size of the bottom-k MinHash sample folded
#: into it; a set of at most so many shingles is its own sample.
SKETCH_BITS = 1024
SAMPLE = 1024
ROWS = 5
#: Classes of a bucket that are compared with one another in one group of a join.
BLOCK = 1024


def bands_needed(percent: int, rows: int = ROWS, miss: float = 1e-6) -> int:
    """Bands so that a pair at *percent* similarity shares none with probability <= miss."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


def sketch_limit(percent: int) -> int:
    """Most differing bits that two samples of full size may have at *percent*.

    The samples' symmetric difference is about 2k(1-J)/(1+J); the limit lies
    seven deviations above the bits which that many elements are expected to
    flip.  Smaller sets have an exact limit instead (see ``_may_link``).
    """
    j = percent / 100
    differ = 2 * SAMPLE * (1 - j) / (1 + j)
    flipped = SKETCH_BITS / 2 * (1 - math.exp(-2 * differ / SKETCH_BITS))
    return math.ceil(flipped + 7 * math.sqrt(1.5 * flipped))


def parity_bitmap(values: np.ndarray) -> np.ndarray:
    """Fold the bottom-k MinHash sample of a set into SKETCH_BITS parities."""
    if len(values) > SAMPLE:
        values = np.partition(values, SAMPLE - 1)[:SAMPLE]
    odd = np.bincount((values & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


class Signer:
    """Set size, fingerprint, band keys and parity bitmap of texts."""

    def __init__(self, shingle: int, bands: int, rows: int, seed: int):
        self.shingle, self.bands, self.rows = shingle, bands, rows
        self.factor = seeded(seed, bands * rows)[:, None]
        self.offset = seeded(seed + 1, bands * rows)[:, None]
        self.band = seeded(seed + 2, bands)
        self.words = WordHashes()

    def minima(self, values: np.ndarray) -> np.ndarray:
        best = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, np.uint64)
        for start, end in slices(len(values), 4096):
            np.minimum(best, (values[None, start:end] * self.factor + self.offset).min(axis=1), out=best)
        return best

    def keys(self, values: np.ndarray) -> np.ndarray:
        grid = self.minima(values).reshape(self.bands, self.rows)
        out = self.band.copy()
        for j in range(self.rows):
            out = mix(out ^ grid[:, j])
        return out.view(np.int64)

    def sign(self, text: bytes | None) -> tuple:
        values = np.unique(shingle_hashes(self.words.of(text_words(text)), self.shingle))
        if not len(values):
            return 0, 0, 0, None, None
        first, second = np.bitwise_xor.reduce(mix(values + np.uint64(1))), np.add.reduce(mix(values ^ np.uint64(0x5BD1E995)))
        return len(values), int(first.view(np.int64)), int(second.view(np.int64)), self.keys(values), parity_bitmap(values)


_SIGNED = "doc bigint, n bigint, print1 bigint, print2 bigint, band_keys array<bigint>, bits array<bigint>"


def _signer(shingle: int, bands: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(shingle, bands, rows, seed)
        with np.errstate(over="ignore"):
            for batch in batches:
                for start, end in slices(batch.num_rows, 512):
                    part = batch.slice(start, end - start)
                    signed = [signer.sign(t) for t in part.column(1).to_pylist()]
                    n, a, b, keys, bits = zip(*signed, strict=True) if signed else ((),) * 5
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))],
                        names=["doc", "n", "print1", "print2", "band_keys", "bits"],
                    )

    return run


def _verifier(shingle: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        pivot, pivot_set = None, None
        with np.errstate(over="ignore"):
            for batch in batches:
                a, b, ta, tb = (batch.column(i).to_pylist() for i in range(4))
                keep = []
                for x, text, pivot_text in zip(b, ta, tb, strict=True):
                    if x != pivot or pivot_set[0] != pivot_text:
                        pivot, pivot_set = x, (pivot_text, np.unique(shingle_hashes(words.of(text_words(pivot_text)), shingle)))
                    own, other = np.unique(shingle_hashes(words.of(text_words(text)), shingle)), pivot_set[1]
                    shared = len(np.intersect1d(own, other, assume_unique=True))
                    union = len(own) + len(other) - shared
                    keep.append(union > 0 and 100 * shared >= percent * union)
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return run


def _differing(x: Column, y: Column) -> Column:
    out = F.lit(0)
    for i in range(SKETCH_BITS // 64):
        out = out + F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i))))
    return out


def _may_link(na: Column, nb: Column, bits_a: Column, bits_b: Column, percent: int) -> Column:
    """False only if the pair is below the threshold.

    Sizes alone bound the similarity.  A differing element flips one bit at
    most, so two whole sets of a linked pair differ in no more bits than they
    have elements apart, (na + nb)(100 - p) / (100 + p); an element that a
    sample left out adds one.  Two full samples have ``sketch_limit``.
    """
    apart = F.floor((na + nb) * (100 - percent) / (100 + percent)) + F.greatest(na - SAMPLE, F.lit(0)) + F.greatest(nb - SAMPLE, F.lit(0))
    limit = F.when(F.least(na, nb) > SAMPLE, F.least(apart, F.lit(sketch_limit(percent)))).otherwise(apart)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (_differing(bits_a, bits_b) <= limit)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    shingle: int = 5,
    percent: int = 80,
    rows: int = ROWS,
    miss: float = 1e-6,
    seed: int = 20,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``.

    Documents whose shingle sets have a Jaccard similarity of at least
    *percent* / 100 are linked; ``component_id`` is the least id reachable over
    links and ``kept`` is true for that document.

    Null, empty and blank texts have no shingles and stay alone and kept.
    Texts of any length are used whole.  Rows that share an id count as one
    document with several texts, each row being returned.  Rows with a null id
    are never grouped: their ``component_id`` is null and they are kept.  An
    empty table gives an empty result; other columns are neither read nor
    returned, whatever their names.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    bands = bands_needed(percent, rows, miss)
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("binary").alias("body"))
    signed = scratch.keep(source.mapInArrow(lean(_signer(shingle, bands, rows, seed)), _SIGNED), "signed")

    prints = ["print1", "print2", "n"]
    classes = scratch.keep(
        signed.where("n > 0 and doc is not null").groupBy(*prints).agg(F.min("doc").alias("class"), F.first("band_keys").alias("band_keys"), F.first("bits").alias("bits")), "classes"
    )
    banded = classes.select("class", F.posexplode("band_keys").alias("band", "key"))
    buckets = scratch.keep(banded.groupBy("key").agg(F.count("*").alias("size"), F.min("class").alias("pivot")).where("size > 1").select("key", "pivot"), "buckets")
    members = scratch.keep(banded.join(buckets, "key"), "members")
    wanted = scratch.keep(members.select(F.col("class").alias("doc")).distinct(), "wanted")
    pool = scratch.keep(source.where("doc is not null").join(wanted, "doc", "left_semi"), "pool")

    attributes = classes.select("class", "n", "bits")
    star = members.where("class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b")).distinct()
    star = _with_attributes(star, attributes, "a")
    star = _with_attributes(star, attributes, "b")
    star = star.where(_may_link(F.col("n_a"), F.col("n_b"), F.col("bits_a"), F.col("bits_b"), percent)).select("a", "b")
    links = scratch.keep(_confirmed(star, pool, shingle, percent), "star")
    found = scratch.keep(connected_components(links, scratch), "found")

    for best_only in (True, True, False):
        strays = _stray_pairs(members, classes, found, percent, bands, scratch, best_only)
        if strays is None:
            break
        more = scratch.keep(_confirmed(scratch.keep(strays, "strays"), pool, shingle, percent), "more")
        settled = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = scratch.keep(connected_components(settled.unionByName(more), scratch), "settled")

    groups = classes.select(*prints, F.col("class").alias("node")).join(found, "node", "left")
    groups = scratch.keep(groups.select(*prints, F.coalesce("component", "node").alias("group")), "groups")
    out = signed.select("doc", *prints).join(groups, prints, "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("group", "doc"))
    return out.select(
        F.col("doc").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc") == component, F.lit(True)).alias("kept"),
    )


def _with_attributes(pairs: DataFrame, attributes: DataFrame, side: str) -> DataFrame:
    named = attributes.select(F.col("class").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
    return pairs.join(named, side)


def _confirmed(pairs: DataFrame, pool: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left = pool.select(F.col("doc").alias("a"), F.col("body").alias("body_a"))
    right = pool.select(F.col("doc").alias("b"), F.col("body").alias("body_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "body_a", "body_b")
    return both.mapInArrow(lean(_verifier(shingle, percent)), "a bigint, b bigint")


def _stray_pairs(members: DataFrame, classes: DataFrame, found: DataFrame, percent: int, bands: int, scratch: Scratch, best_only: bool) -> DataFrame | None:
    """Pairs of one bucket and two components that the star has not compared; None if no bucket has two.

    With *best_only*, each stray's most promising partner alone: confirming
    those first joins most components, and leaves few pairs for the round
    that takes all.

    Both lie in a bucket whose members fall into several components, and one
    of them, the stray, is not in the component of the bucket's least class.
    The join meets every stray with its bucket's members and lets a pair out
    only in its first shared band.  Both sides of a large bucket are dealt into
    blocks of about BLOCK classes, and each pair of blocks is a key of its own.
    """
    labelled = members.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    labelled = scratch.keep(labelled, "labelled")
    split = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min_by("component", "class").alias("main"), F.count("*").alias("size"))
    split = scratch.keep(split.where("low <> high").select("key", "main", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "split")
    if split.isEmpty():
        return None
    keyed = labelled.join(split, "key").join(classes.select("class", "n", "bits", "band_keys"), "class")
    keyed = scratch.keep(keyed.withColumn("stray", F.col("component") != F.col("main")), "open")

    own, other = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = keyed.where("stray").select("key", own.alias("block_a"), other.alias("block_b"), "band", "pivot", *(F.col(c).alias(f"{c}_a") for c in ("class", "component", "n", "bits", "band_keys")))
    right = keyed.select("key", other.alias("block_a"), own.alias("block_b"), *(F.col(c).alias(f"{c}_b") for c in ("class", "component", "stray", "n", "bits", "band_keys")))
    earlier = F.lit(False)
    for i in range(bands - 1):
        earlier = earlier | ((F.col("band") > i) & (F.get("band_keys_a", F.lit(i)) == F.get("band_keys_b", F.lit(i))))
    pairs = left.join(
        right.withColumnsRenamed({"key": "key_b", "block_a": "of_a", "block_b": "of_b"}),
        (F.col("key") == F.col("key_b"))
        & (F.col("block_a") == F.col("of_a"))
        & (F.col("block_b") == F.col("of_b"))
        & (F.col("component_a") != F.col("component_b"))
        & (F.col("class_b") != F.col("pivot"))
        & (~F.col("stray_b") | (F.col("class_a") < F.col("class_b")))
        & _may_link(F.col("n_a"), F.col("n_b"), F.col("bits_a"), F.col("bits_b"), percent)
        & ~earlier,
    )
    if best_only:
        apart = _differing(F.col("bits_a"), F.col("bits_b")) / (F.col("n_a") + F.col("n_b"))
        pairs = pairs.groupBy("class_a").agg(F.min(F.struct(apart.alias("apart"), "class_b")).alias("best")).select("class_a", F.col("best.class_b").alias("class_b"))
    return pairs.select(F.greatest("class_a", "class_b").alias("a"), F.least("class_a", "class_b").alias("b")).distinct()
