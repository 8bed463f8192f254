"""Token ids in binary shards, compressed per document (operator 8).

A shared zstandard dictionary is trained on the serialised id arrays of a
bounded sample.  Each document is one zstandard frame, so short documents
compress well and any one can be read alone through its shard's offset index.

A shard is a byte string, all integers little-endian::

    8   magic "TSTOKID1"
    8   hash of the dictionary (xxh3-64; 0: compressed without one)
    8   n, number of documents
    8   ids in the shard
    n   1 where the document has an id, else 0
    8n  document ids (signed)
    8(n+1)  byte offsets of the frames, from the end of this header
    8(n+1)  id offsets of the documents, from the shard's first id
    ... the frames, each the unsigned 32-bit ids of one document

Shards are rows of a Parquet table (part, seq, first, n_docs, n_tokens,
payload) under ``<path>/shards``, ordered by document id over (part, seq);
``first`` counts the ids before the shard within its part.  The dictionary
lies in ``<path>/dictionary``.  Writing through Spark keeps the commit
protocol and reaches any store that Spark reaches.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lean, sample_rows, sized_slices
from .wordarrays import Texts

MAGIC = b"TSTOKID1"
END_ID = 1
#: Bounds of the dictionary's training sample, in documents and characters of each, and its size.
SAMPLE_DOCS = 1000
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 4 << 20
SHARD_DOCS = 8192
#: A shard also ends when its ids take so many bytes before compression.
RAW_BYTES = 32 << 20
LEVEL = 3
#: Documents, and bytes of their texts, that are encoded at once: the arrays of a batch take some 60 bytes for each byte of text.
BATCH_DOCS = 1024
BATCH_BYTES = 512 << 10


#: Fixed value: the split pattern of vocabularies whose tokens never reach over white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Bytes of words that hold nothing but letters, each of which is its own composed form: a-z, A-Z and U+00C0 to U+00FF.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), 0xC3, *(x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7))]] = True


def splits_at_space(config: dict) -> bool:
    """Whether a tokenizer gives a text the ids of its words, one after the other.

    That holds if its normaliser and pre-tokenizer look at nothing beyond white
    space, drop it, and nothing is added, cut or joined afterwards.
    """
    steps = lambda x, key: [] if x is None else x[key] if x["type"] == "Sequence" else [x]
    normal = [(n["type"], n.get("pattern"), n.get("content")) for n in steps(config["normalizer"], "normalizers")]
    known = [("NFC", None, None), ("Lowercase", None, None)]
    spaces = [n for n in normal if n not in known]
    split = steps(config["pre_tokenizer"], "pretokenizers")
    return (
        all(n[0] == "Replace" and n[1] == {"Regex": r"\s+"} and n[2] == " " for n in spaces)
        and len(split) == 2
        and (split[0]["type"], split[0].get("pattern"), split[0].get("behavior"), split[0].get("invert")) == ("Split", {"Regex": WORD_PATTERN}, "Removed", True)
        and (split[1]["type"], split[1].get("add_prefix_space"), split[1].get("use_regex")) == ("ByteLevel", False, False)
        and config["model"]["type"] == "BPE"
        and not config["model"].get("dropout")
        and not any(config.get(k) for k in ("post_processor", "truncation", "padding"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or len(t["content"].split()) != 1 for t in config["added_tokens"])
    )


def runs(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Runs of *values*, one after the other."""
    ends = np.cumsum(counts)
    return values[np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Known:
    """Ids of words by their 64-bit keys: sorted keys, and where each one's run lies in ``ids``.

    Arrays take some 32 bytes a word, a sixth of what dictionaries of Python
    integers do, and a batch of keys is sought at once.  Place 0 of ``ids`` has the end id.
    """

    def __init__(self, end: np.ndarray):
        self.ids = end
        self.keys, self.starts, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for those that aren't known."""
        if not len(self):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, starts: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """New keys in ascending order, with their runs in *ids*."""
        at = np.searchsorted(self.keys, keys)
        self.keys, self.counts = np.insert(self.keys, at, keys), np.insert(self.counts, at, counts)
        self.starts = np.insert(self.starts, at, starts + len(self.ids))
        self.ids = np.concatenate([self.ids, ids])


class Encoder:
    """Serialised ids of texts, without special tokens, then the end id.

    Where ``splits_at_space`` holds, texts are cut into words and the ids of
    each word are remembered; two generations are kept, and the older one goes
    when the newer one has LIMIT words or LIMIT_IDS ids.  Some LEARN_BYTES of
    unknown words are encoded in two calls: those of letters alone, one piece
    each, end where an id ends a piece, and the others are told apart by marks
    whose id is known.  Other tokenizers, and texts that hold the string of an
    added token, encode whole texts.
    """

    LIMIT = 500_000
    LIMIT_IDS = 8 * LIMIT
    #: The tokenizer takes hundreds of bytes for each byte of a text while it encodes it.
    LEARN_BYTES = 64 << 10
    #: Bytes of a word beyond which it is encoded alone.
    LONGEST = 64
    #: A control character: as a word of its own it has one fixed id, which no other character has.
    MARK = "\x01"

    def __init__(self, path: str, end_id: int = END_ID):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        self.folds = any(n["type"] == "Lowercase" for n in (config["normalizer"] or {}).get("normalizers", []))
        self.added = [t["content"].encode() for t in config["added_tokens"]]
        self.end = np.array([end_id], "<u4")
        self.newer, self.older = Known(self.end), Known(self.end)
        mark = self.ids(self.MARK)
        self.by_word = splits_at_space(config) and len(mark) == 1
        self.marks, self.last = np.zeros((2, max(self.tokenizer.get_vocab().values(), default=0) + 1), bool)
        if self.by_word:
            self.marks[mark] = True
            if suffix := config["model"].get("end_of_word_suffix"):
                self.last[[i for token, i in config["model"]["vocab"].items() if token.endswith(suffix)]] = True

    def ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def joined(self, split: Texts, words: np.ndarray, gap: str) -> str:
        """*words*, by number, each with *gap* after it."""
        begin, size = split.start[words], split.end[words] - split.start[words]
        own = np.arange(int(size.sum())) + np.repeat(len(gap) * np.arange(len(words)), size)
        out, between = np.zeros(len(own) + len(gap) * len(words), np.uint8), np.ones(len(own) + len(gap) * len(words), bool)
        between[own] = False
        out[own] = runs(split.bytes, begin, size)
        out[between] = np.tile(np.frombuffer(gap.encode(), np.uint8), len(words))
        return out.tobytes().decode()

    def learn(self, split: Texts, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and counts of the ids of *words*, by number, and the ids."""
        size = split.end[words] - split.start[words]
        body, first = runs(split.bytes, split.start[words], size), np.cumsum(size) - size
        odd = (size > self.LONGEST) | np.logical_or.reduceat(body == ord(self.MARK), first)
        letters = ~odd & np.logical_and.reduceat(_LETTER[body], first) & self.last.any()
        counts, order, parts = np.zeros(len(words), np.int64), [], []
        for chosen, gap, ends, marks in ((letters, " ", self.last, 0), (~letters & ~odd, f" {self.MARK} ", self.marks, 1)):
            chosen = np.flatnonzero(chosen)
            found = self.ids(self.joined(split, words[chosen], gap))
            at = np.flatnonzero(ends[found])
            if len(at) != len(chosen) or (len(at) and at[-1] != len(found) - 1):
                odd[chosen] = True
                continue
            counts[chosen] = np.diff(at, prepend=-1) - marks
            order.append(chosen)
            parts.append(found[~ends[found]] if marks else found)
        alone = [self.ids(split.word(i).decode()) for i in words[odd]]
        counts[odd] = [len(x) for x in alone]
        order = np.concatenate([*order, np.flatnonzero(odd)])
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        return starts, counts, np.concatenate([*parts, *alone])

    def places(self, split: Texts, keys: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The places in ``newer`` of ascending *keys*, which are those of the words *at*."""
        if len(self.newer) > self.LIMIT or len(self.newer.ids) > self.LIMIT_IDS:
            self.newer, self.older = Known(self.end), self.newer
        places = self.newer.find(keys)
        missing = np.flatnonzero(places < 0)
        if not len(missing):
            return places
        old = self.older.find(keys[missing])
        seen, place = missing[old >= 0], old[old >= 0]
        counts = self.older.counts[place]
        self.newer.add(keys[seen], np.cumsum(counts) - counts, counts, runs(self.older.ids, self.older.starts[place], counts))
        fresh = missing[old < 0]
        upto = np.cumsum(split.end[at[fresh]] - split.start[at[fresh]])
        for some in np.split(fresh, np.flatnonzero(np.diff(upto // self.LEARN_BYTES)) + 1) if len(fresh) else ():
            self.newer.add(keys[some], *self.learn(split, at[some]))
        return self.newer.find(keys)

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        if not self.by_word:
            return self.whole(texts)
        split = Texts(texts, places=False, fold=self.folds, stops=True)
        keys, at, back = np.unique(split.key, return_index=True, return_inverse=True)
        places = self.places(split, keys, at)
        n = len(split.counts)
        own = np.arange(len(back)) + split.text
        starts, counts = np.zeros(len(back) + n, np.int64), np.ones(len(back) + n, np.int64)
        starts[own], counts[own] = self.newer.starts[places][back], self.newer.counts[places][back]
        ends = np.cumsum(counts)
        ids = runs(self.newer.ids, starts, counts)
        bounds = np.concatenate([[0], ends[split.first[1:] + np.arange(n)]]) if n else np.zeros(1, np.int64)
        out = [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        if any(x in split.raw_bytes for x in self.added):
            odd = [i for i in range(n) if any(x in (texts[i].as_py() or "").encode() for x in self.added)]
            for i, raw in zip(odd, self.whole(texts.take(pa.array(odd, pa.int64()))), strict=True):
                out[i] = raw
        return out

    def whole(self, texts: pa.Array) -> list[bytes]:
        """Ids of whole texts, straight from the tokenizer."""
        found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        return [np.concatenate([np.asarray(x.ids, "<u4"), self.end]).astype("<u4").tobytes() for x in found]

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], pa.string()))[0]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder_for(path: str, end_id: int) -> Encoder:
    """The encoder of this process: a worker's later tasks find the pieces that its first ones learnt."""
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def train_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; of too few samples, their own bytes; of none, b""."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def dictionary_hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) if len(data) >= 8 else 0


def pack(doc_ids: list[int | None], frames: list[bytes], counts: list[int], hash_: int) -> bytes:
    """One shard of documents whose frames are compressed already."""
    n = len(frames)
    offsets, starts = np.zeros(n + 1, "<u8"), np.zeros(n + 1, "<u8")
    np.cumsum([len(f) for f in frames], out=offsets[1:])
    np.cumsum(counts, out=starts[1:])
    head = MAGIC + b"".join(int(x).to_bytes(8, "little") for x in (hash_, n, int(starts[-1])))
    has_id = bytes(d is not None for d in doc_ids)
    return b"".join([head, has_id, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), offsets.tobytes(), starts.tobytes(), *frames])


class Shard:
    """Reader of one shard; documents are decompressed one at a time."""

    def __init__(self, payload: bytes, dictionary: bytes):
        if payload[:8] != MAGIC:
            raise ValueError("not a token shard")
        want, n, self.n_tokens = (int.from_bytes(payload[i : i + 8], "little") for i in (8, 16, 24))
        if want != dictionary_hash(dictionary):
            raise ValueError("the shard was compressed with another dictionary")
        at = 32
        has_id = payload[at : at + n]
        ids = np.frombuffer(payload, "<i8", n, at + n)
        self.doc_ids = [int(d) if ok else None for d, ok in zip(ids, has_id, strict=True)]
        self.offsets = np.frombuffer(payload, "<u8", n + 1, at + 9 * n)
        self.starts = np.frombuffer(payload, "<u8", n + 1, at + 9 * n + 8 * (n + 1))
        self.body = at + 9 * n + 16 * (n + 1)
        self.payload = payload
        self.reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.doc_ids)

    def raw(self, i: int) -> bytes:
        start, end = (self.body + int(self.offsets[j]) for j in (i, i + 1))
        size = 4 * int(self.starts[i + 1] - self.starts[i])
        return self.reader.decompress(self.payload[start:end], max_output_size=size)

    def ids(self, i: int) -> np.ndarray:
        return np.frombuffer(self.raw(i), "<u4")


_SHARDS = "part int, seq int, first bigint, n_docs bigint, n_tokens bigint, payload binary"


def _shard_writer(path: str, end_id: int, dictionary: bytes, shard_bytes: int, shard_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path, end_id)
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_checksum=False)
        part, seq, first = TaskContext.get().partitionId(), 0, 0
        ids: list[int | None] = []
        frames: list[bytes] = []
        counts: list[int] = []
        size = raw_size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, first, ids, frames, counts, size, raw_size
            tokens = sum(counts)
            row = [part], [seq], [first], [len(ids)], [tokens], [pack(ids, frames, counts, dictionary_hash(dictionary))]
            types = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()
            seq, first, ids, frames, counts, size, raw_size = seq + 1, first + tokens, [], [], [], 0, 0
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], names=["part", "seq", "first", "n_docs", "n_tokens", "payload"])

        for batch in batches:
            for start, end in sized_slices(batch.column(1), BATCH_DOCS, BATCH_BYTES):
                piece = batch.slice(start, end - start)
                for doc, raw in zip(piece.column(0).to_pylist(), encoder.encode_all(piece.column(1)), strict=True):
                    frame = writer.compress(raw)
                    ids.append(doc)
                    frames.append(frame)
                    counts.append(len(raw) // 4)
                    size, raw_size = size + len(frame), raw_size + len(raw)
                    if size >= shard_bytes or len(ids) >= shard_docs or raw_size >= RAW_BYTES:
                        yield flush()
        if ids:
            yield flush()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    end_id: int = END_ID,
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
    dictionary_bytes: int = DICTIONARY_BYTES,
    shard_bytes: int = SHARD_BYTES,
    shard_docs: int = SHARD_DOCS,
    rows_per_part: int = 200_000,
    seed: int = 8,
) -> None:
    """Write the ids of every document, in ascending id order, under *path*.

    Null and empty texts have the end id alone.  Documents with a null id come
    first; those that share an id are ordered by their text's hash and text.
    Texts of any length are encoded whole; a shard holds one document at
    least.  An empty table writes no shards.  Other columns are ignored.  The
    dictionary, which is for short documents, is trained on *sample_docs*
    documents at most, of *sample_chars* characters at most, the first by a
    seeded hash of their ids.  *tokenizer* is the file of any tokenizer.

    Documents are dealt by id range into as many parts as the session's
    shuffle has, or more, so that no part grows with the input.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("body"))
    total = source.count()
    sampled = sample_rows(source.where(F.length("body") <= sample_chars), sample_docs, seed, total)
    names = "piece binary"

    def serialise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer, end_id)
        for batch in batches:
            for start, end in sized_slices(batch.column(1), BATCH_DOCS, BATCH_BYTES):
                yield pa.RecordBatch.from_arrays([pa.array(encoder.encode_all(batch.column(1).slice(start, end - start)), pa.binary())], names=["piece"])

    dictionary = train_dictionary([bytes(r.piece) for r in sampled.mapInArrow(lean(serialise), names).collect()], dictionary_bytes)
    spark.createDataFrame([(bytearray(dictionary), f"{dictionary_hash(dictionary):016x}")], "dictionary binary, hash string").write.mode("overwrite").parquet(f"{path}/dictionary")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // rows_per_part))
    body_hash = F.xxhash64("body")
    ordered = source.repartitionByRange(parts, "doc", body_hash).sortWithinPartitions("doc", body_hash, "body")
    ordered.mapInArrow(lean(_shard_writer(tokenizer, end_id, dictionary, shard_bytes, shard_docs)), _SHARDS).write.mode("overwrite").parquet(f"{path}/shards")


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])


_FIELDS = ["doc_id bigint", "start bigint", "n_tokens bigint", "ids_crc32 bigint"]


def _shard_reader(dictionary: bytes, base: dict[int, int], with_ids: bool):
    """Digests of shards; without the ids, one document's are held at a time."""
    names = [f.split()[0] for f in _FIELDS] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, payload in zip(*batch.columns, strict=True):
                shard = Shard(payload.as_py(), dictionary)
                starts = shard.starts.astype(np.int64) + first.as_py() + base[part.as_py()]
                crcs = [zlib.crc32(shard.raw(i)) for i in range(len(shard))]
                columns = [pa.array(shard.doc_ids, pa.int64()), pa.array(starts[:-1]), pa.array(np.diff(starts)), pa.array(crcs, pa.int64())]
                if with_ids:
                    columns.append(pa.array([shard.ids(i).astype(np.int64) for i in range(len(shard))], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Every document in the shards under *path*: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it.  *with_ids* adds the
    ids themselves.  The count of ids before a part comes from the shards'
    counters alone; there is one row per part, whatever the documents.
    """
    dictionary = read_dictionary(spark, path)
    shards = spark.read.schema(_SHARDS).parquet(f"{path}/shards")
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    base, before = {}, 0
    for row in totals.orderBy("part").collect():
        base[row.part] = before
        before += row.tokens
    fields = _FIELDS + ["ids array<bigint>"] * with_ids
    return shards.select("part", "first", "payload").mapInArrow(lean(_shard_reader(dictionary, base, with_ids)), ", ".join(fields))
