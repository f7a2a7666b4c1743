"""Whole columns of text as numpy arrays: words, their hashes, and windows of words, without a Python loop per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Odd, so that it has an inverse modulo 2^64; word hashes are polynomials in it.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_white = np.ones(256, dtype=bool)
_white[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of the words ``[^\x20\x09-\x0D]+``.
NOT_WHITE = _white

_alnum = np.zeros(256, dtype=bool)
_alnum[0x30:0x3A] = _alnum[0x61:0x7B] = True
_alnum[0x80:] = True
#: Bytes of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in lower-cased text.
LETTER_OR_DIGIT = _alnum


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= 1 << 23:
            _powers[base] = have
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts together, and the offset at which each begins (and the last ends); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of text each; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64) + 16)
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(begin, end - begin)
            begin = end
    # A Python worker outlives its task; what Arrow keeps for later goes back meanwhile.
    pa.default_memory_pool().release_unused()


@dataclass
class Words:
    """All words of a batch of texts: ``start[i]:end[i]`` in ``data``; text d has words ``first[d]:first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def text(self) -> np.ndarray:
        """Of each word, the number of its text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @cached_property
    def hashes(self) -> np.ndarray:
        """64-bit hash of each word; different words share one with a chance of about 2^-64."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _power(BASE, n), out=total[1:])
        return mix((total[self.end] - total[self.start]) * _power(INVERSE, n)[self.start])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each window of ``size`` words of one text."""
        n = len(self.start)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[: n - size + 1] == self.text[size - 1 :])
        value = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            value *= np.uint64(BASE)
            value += self.hashes[at + k]
        return at, mix(value)


def words(column: pa.Array, members: np.ndarray, lower: bool = True) -> Words:
    """Longest runs of bytes in ``members``, after lower-casing A-Z."""
    data, offsets = utf8(column)
    if lower:
        data = LOWER[data]
    inside = members[data]
    filled = offsets[:-1][np.diff(offsets) > 0]
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    before[filled] = False
    start = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    after[offsets[1:][np.diff(offsets) > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def sums_by_text(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of each text's values; ``first`` as in Words."""
    running = np.cumsum(values)
    total = np.zeros(len(running) + 1, running.dtype)
    total[1:] = running
    return total[first[1:]] - total[first[:-1]]
