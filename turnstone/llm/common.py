"""Helpers shared by the corpus operators: shared tables, words and hashes."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word separators of every word rule here: ASCII white space and nothing else.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"

_MASK = (1 << 64) - 1
_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)

_own_root: str | None = None
_written: list[tuple[SparkSession, str]] = []


def shared_root(spark: SparkSession) -> str:
    """Folder that the driver and all executors share.

    It is the cluster's ``spark.checkpoint.dir``.  Where that is unset, a
    session on one machine, as in tests, uses a folder of this process and any
    other one is refused.
    """
    global _own_root
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="turnstone-")
        _written.append((spark, _own_root))
    return _own_root


class Scratch:
    """Tables written to the shared folder, so that lineage ends there.

    A lost executor costs the tasks of the running job and never the steps
    before it.  The tables live until the process ends, as lazily evaluated
    results may still read them; ``drop()`` removes them earlier.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_root(spark)}/turnstone-{name}-{uuid.uuid4().hex}"
        self._count = 0
        _written.append((spark, self.path))

    def keep(self, df: DataFrame, label: str = "step") -> DataFrame:
        """Write *df* and return the table that was written."""
        self._count += 1
        path = f"{self.path}/{self._count:02d}-{label}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        delete_path(self.spark, self.path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _clean_up() -> None:
    for spark, path in _written:
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone already
            pass


atexit.register(_clean_up)


def sample_rows(source: DataFrame, most: int, seed: int, total: int) -> DataFrame:
    """At most *most* rows of *source* (doc, body), the first by a seeded hash of the id and the text's length.

    Hashes alone are ordered; texts are read again for those chosen.  *total*
    is about the number of rows.  Rows of one hash count once.
    """
    place = F.xxhash64(F.lit(seed), "doc", F.length("body"))
    share = min(1.0, 1.5 * most / max(total, 1))
    rough = min(int((2 * share - 1) * (1 << 63)), (1 << 63) - 1)
    last = source.select(place.alias("place")).where(F.col("place") <= rough).distinct().orderBy("place").limit(most).agg(F.max("place")).first()[0]
    if last is None:
        return source.limit(0)
    return source.withColumn("place", place).where(F.col("place") <= last).dropDuplicates(["place"]).drop("place")


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(df: DataFrame, wanted: str) -> str:
    """*wanted*, or a longer name if the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def evaluated(df: DataFrame, column: str) -> DataFrame:
    """*df* with *column* computed once, here.

    A filter on an expensive column would otherwise be pushed below it with a
    copy of its expression, lambdas and all.  Nothing is pushed below a
    generator's output.
    """
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.array(column)).alias(column)).select(*df.columns)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that every bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bounded number of words."""

    LIMIT = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for every window of *size* words, in order.

    Fewer words than *size* make one shingle of the whole sequence; no words
    make none.
    """
    n = len(words)
    if n == 0:
        return words
    width = min(n, size)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = (out ^ words[j : n - width + 1 + j]) * _M1
        out ^= out >> np.uint64(32)
    return mix(out)


def text_words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words of UTF-8 text; bytes.split() splits at ASCII space only."""
    return text.lower().split() if text else []


def slices(total: int, step: int) -> Iterable[tuple[int, int]]:
    for start in range(0, total, step):
        yield start, min(total, start + step)


def sized_slices(column: pa.Array, rows: int, size: int) -> Iterable[tuple[int, int]]:
    """Ranges of at most *rows* texts that, but for single texts, take at most *size* bytes."""
    upto = np.zeros(len(column) + 1, np.int64)
    np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0)), out=upto[1:])
    start = 0
    while start < len(column):
        end = int(np.searchsorted(upto, upto[start] + size, "right")) - 1
        end = min(max(end, start + 1), start + rows, len(column))
        yield start, end
        start = end


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Batches) -> Batches:
    """*run* for ``mapInArrow``, after which the worker gives back the memory that it freed.

    Workers outlive their tasks.  What allocators keep of a task would
    count beside the memory of all later steps.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # another C library
        pass


def seeded(seed: int, count: int) -> np.ndarray:
    """*count* fixed pseudo-random odd 64-bit numbers."""
    with np.errstate(over="ignore"):
        base = np.arange(1, count + 1, dtype=np.uint64) * _M1 + np.uint64(seed & _MASK)
        return mix(base) | np.uint64(1)
