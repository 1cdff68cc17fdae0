"""Whole-batch text arithmetic for Arrow columns: words, hashes and windows without a Python loop per word.

Words are ``[^\\x20\\x09-\\x0D]+``. A NULL text counts as an empty one. Every function works on a slice of a
record batch of bounded size, so memory does not depend on how many rows Spark puts into a batch; a single
text larger than the bound forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
WORD = r"[^\x20\x09-\x0D]+"
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over the whole word."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers that every worker derives alike."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + np.uint64(salt)) | np.uint64(1)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class Rolling:
    """Polynomial hashes of any byte range of a buffer, modulo 2**64 over randomised byte values."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        table = mix(np.arange(256, dtype=np.uint64) + np.uint64(77))
        if lower:
            table = table[_LOWER]
        size = 1 << max(20, int(len(data)).bit_length())
        forward, self.back = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(table[data] * forward[: len(data)], out=self.sums[1:])

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))

    def runs(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` bytes, the same values as ``between`` gives."""
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n] + np.uint64(size))


@dataclass
class Texts:
    """Texts of a slice: their bytes, and where each begins and ends in them."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def one(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


@dataclass
class Words:
    """Words of a slice: byte ranges, the text each belongs to, and the first word of every text (plus the end)."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Cut record batches into runs of rows of at most ``limit`` bytes of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        array = batch.column(batch.schema.get_field_index(column))
        array = array.cast(pa.large_string()) if not pa.types.is_large_string(array.type) else array
        if array.null_count:
            array = array.fill_null("")
        offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset: array.offset + len(array) + 1]
        data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] else np.zeros(0, np.uint8)
        row = 0
        while row < len(array):
            until = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            until = min(max(until, row + 1), len(array))
            base = offsets[row]
            yield batch.slice(row, until - row), Texts(
                data[base:offsets[until]], offsets[row:until] - base, offsets[row + 1:until + 1] - base)
            row = until


def find_words(texts: Texts) -> Words:
    n = len(texts.data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(texts.start) + 1, np.int64))
    ink = ~_IS_SPACE[texts.data]
    border = np.zeros(n + 1, bool)
    border[texts.start] = True
    border[n] = True
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1] | border[1:n]
    ends[:-1] &= ~ink[1:] | border[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, np.append(texts.start, n))
    return Words(start, end, np.repeat(np.arange(len(texts.start)), np.diff(first)), first)


def shingles(texts: Texts, width: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, text by text, and the first shingle of each text (plus the end).

    A text with fewer words has one shingle, all its words; a text without words has none. The third value
    is the number of words of each text.
    """
    words = find_words(texts)
    counts = words.counts()
    h = Rolling(texts.data, lower).between(words.start, words.end)
    factors = seeds(width + 1, 5)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(first[-1]) + np.repeat(words.first[:-1] - first[:-1], n)
    have = np.repeat(np.minimum(counts, width), n)
    out = have.astype(np.uint64) * factors[width]
    for j in range(width):
        inside = j < have
        if inside.all():
            out += mix(h[at + j] * factors[j])
        else:
            out[inside] += mix(h[at[inside] + j] * factors[j])
    return mix(out), first, counts
