"""Words of many texts at once, as arrays.

A word is ``[^\\x20\\x09-\\x0D]+`` of the UTF-8 bytes with A-Z lower-cased.  All
work is on whole batches; memory is a few bytes per byte of text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from .common import mix, seeded

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: The base of all polynomial hashes here; odd, so it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_BYTES = seeded(77, 256)
#: Bytes that are hashed at once; keys don't depend on it.
_SEGMENT = 1 << 17
_LONG = 1 << 16


class _Powers:
    """Powers of BASE and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                for name, base in (("up", BASE), ("down", _INVERSE)):
                    values = np.full(size, base, np.uint64)
                    values[0] = 1
                    setattr(self, name, np.multiply.accumulate(values))
        return self.up[:n], self.down[:n]


_powers = _Powers()


class Sums:
    """Polynomial hashes of runs of values, each in constant time."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers.of(len(values) + 1)
        self.upto = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.upto[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return (self.upto[end] - self.upto[start]) * self.down[start]


class Texts:
    """The words of a column of texts; nulls have none.

    ``first`` has each text's first word and, last, the number of words; per
    word there are ``text``, ``line`` (breaks before it in the batch), ``key``
    (64-bit hash) and, with *places*, the code points ``begin`` and ``stop`` in
    its text.  With *fold* given, words that aren't ASCII keep their case, and
    without it true all do.  With *stops*, a full stop or
    comma that ends a word after a letter is a word of its own.
    """

    def __init__(self, column: pa.Array, places: bool = True, fold: bool | None = None, stops: bool = False):
        binary = pc.fill_null(column.cast(pa.large_binary()), b"")
        buffers = binary.buffers()
        offsets = np.frombuffer(buffers[1], np.int64)[binary.offset : binary.offset + len(binary) + 1] if len(binary) else np.zeros(1, np.int64)
        raw = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if len(binary) and buffers[2] is not None else np.zeros(0, np.uint8)
        self.offsets = offsets = offsets - offsets[0]
        self.raw_bytes = raw.tobytes() if fold is not None else b""
        self.bytes = LOWER[raw] if fold is not False else raw
        inside = ~_SPACE[raw]
        cut = np.zeros(len(raw) + 1, bool)
        cut[offsets] = True
        before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        starts, ends = inside & (~before | cut[:-1]), inside & (~after | cut[1:])
        if stops:
            at = np.flatnonzero(ends & ~starts & ((raw == 46) | (raw == 44)))
            last = raw[at - 1]
            letter = ((last | 32) >= 97) & ((last | 32) <= 122)
            letter |= (last >= 0x80) & (last <= 0xBF) & (last != 0x97) & (last != 0xB7) & (raw[np.maximum(at - 2, 0)] == 0xC3)
            at = at[letter]
            starts[at] = True
            ends[at - 1] = True
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(binary)), self.counts)
        high = np.concatenate([[0], np.cumsum(raw >= 128)]) if fold else np.zeros(1, np.int64)
        if high[-1]:
            step = np.zeros(len(raw) + 1, np.int8)
            odd = high[self.end] > high[self.start]
            step[self.start[odd]] += 1
            step[self.end[odd]] -= 1
            self.bytes = np.where(np.cumsum(step[:-1], dtype=np.int8) > 0, raw, self.bytes)
        with np.errstate(over="ignore"):
            self.key = self._keys()
        if places:
            self.line = np.concatenate([[0], np.cumsum(raw == 10)])[self.start]
            points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            own = points[offsets[:-1]][self.text]
            self.begin, self.stop = points[self.start] - own, points[self.end] - own

    def __len__(self) -> int:
        return len(self.start)

    def word(self, i: int) -> bytes:
        return self.bytes[self.start[i] : self.end[i]].tobytes()

    def _keys(self) -> np.ndarray:
        out = np.zeros(len(self.start), np.uint64)
        at = 0
        while at < len(out):
            base = self.start[at]
            upto = max(int(np.searchsorted(self.end, base + _SEGMENT, "right")), at + 1)
            if self.end[at] - base > _LONG:
                out[at] = xxhash.xxh3_64_intdigest(self.word(at))
                at += 1
                continue
            upto = min(upto, int(np.argmax(np.append(self.end[at:upto] - self.start[at:upto] > _LONG, True))) + at)
            sums = Sums(_BYTES[self.bytes[base : self.end[upto - 1]]])
            s, e = self.start[at:upto] - base, self.end[at:upto] - base
            out[at:upto] = mix(sums.of(s, e) + (e - s).astype(np.uint64))
            at = upto
        return out


class Md5Words(dict):
    """The first 32 bits of words' MD5, which SQL can compute too, by their keys."""

    LIMIT = 500_000

    def of(self, texts: Texts) -> np.ndarray:
        keys, at, back = np.unique(texts.key, return_index=True, return_inverse=True)
        if len(self) > self.LIMIT:
            self.clear()
        values = np.zeros(len(keys), np.uint64)
        for i, (key, place) in enumerate(zip(keys.tolist(), at.tolist(), strict=True)):
            value = self.get(key)
            if value is None:
                value = self[key] = int.from_bytes(hashlib.md5(texts.word(place), usedforsecurity=False).digest()[:4], "big")
            values[i] = value
        return values[back]


def sliding(least: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """The least or largest of every *width* values in a row."""
    n, size = len(x) - (width - 1), 1
    if n <= 0:
        return x[:0]
    while 2 * size <= width:
        x, size = least(x[:-size], x[size:]), 2 * size
    return least(x[:n], x[width - size : width - size + n])
