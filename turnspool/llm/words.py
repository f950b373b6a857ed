"""Words of whole Arrow text columns as numpy arrays, without a Python object per word.

Both word rules in use only look at ASCII bytes, so they can be read off the UTF-8 bytes: every
byte of a non-ASCII character is a word byte. A word is known by a 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
SLICE_BYTES = 4 << 20


def _bytes(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


NOT_SPACE = ~_bytes((0x20, 0x20), (0x09, 0x0D))
LETTERS = _bytes((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
ALNUM = LETTERS | _bytes((0x30, 0x39))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of uint64 values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


class Words(NamedTuple):
    start: np.ndarray  # of each word: first byte,
    end: np.ndarray  # byte behind the last,
    code: np.ndarray  # and hash
    first: np.ndarray  # row r has the words first[r] to first[r + 1]

    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


class WordReader:
    """Finds and hashes the words of many texts at once; ``lower`` ignores the case of A-Z."""

    BASE = 0x9E3779B97F4A7C15 | 3

    def __init__(self, word_bytes: np.ndarray, lower: bool, seed: int = 1):
        self.word = word_bytes
        self.table = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=np.uint64)
        if lower:
            self.table[65:91] = self.table[97:123]
        self.table[~word_bytes] = 0
        self._grow(SEGMENT)

    def _grow(self, n: int) -> None:
        self.power = powers(self.BASE, n)
        self.inverse = powers(pow(self.BASE, -1, 2**64), n)

    def read(self, data: np.ndarray, bounds: np.ndarray) -> Words:
        """``data`` are the bytes of all rows, one after the other; row r ends at bounds[r + 1]."""
        mask = self.word[data]
        begin, stop = mask.copy(), mask.copy()
        begin[1:] &= ~mask[:-1]
        stop[:-1] &= ~mask[1:]
        filled = bounds[1:] > bounds[:-1]
        heads, tails = bounds[:-1][filled], bounds[1:][filled] - 1
        begin[heads] = mask[heads]
        stop[tails] = mask[tails]
        start, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        return Words(start, end, self._codes(data, start, end), np.searchsorted(start, bounds))

    def _codes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        code, i = np.empty(len(start), np.uint64), 0
        while i < len(start):
            low = start[i]
            j = max(i + 1, int(np.searchsorted(end, low + SEGMENT, "right")))
            size = int(end[j - 1] - low)
            if size > len(self.power):
                self._grow(size)
            at = start[i:j] - low
            values = self.table[data[low : low + size]] * self.power[:size]
            code[i:j] = np.add.reduceat(values, at) * self.inverse[at]
            i = j
        return mix(code ^ mix((end - start).astype(np.uint64)))


    def prefixes(
        self, data: np.ndarray, words: Words, lengths: tuple[int, ...]
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(word, code)`` of the first n bytes of every longer word, for each n in lengths."""
        code, size = np.zeros(len(words.start), np.uint64), words.end - words.start
        for k in range(max(lengths)):
            at = np.minimum(words.start + k, len(data) - 1)
            code = (code + self.table[data[at]]) * np.uint64(self.BASE)
            if k + 1 in lengths:
                longer = np.flatnonzero(size > k + 1)
                yield longer, mix(code[longer] ^ np.uint64(k + 1))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its row bounds; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = column.offset
    bounds = np.frombuffer(offsets, np.int64)[at : at + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row behind the last, bytes, bounds)`` of runs of rows of about ``limit``
    bytes, at least one row each, so that scratch arrays stay small for any batch."""
    data, bounds = utf8(column)
    row = 0
    while row < len(column):
        to = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield row, to, data[bounds[row] : bounds[to]], bounds[row : to + 1] - bounds[row]
        row = to


def grams(code: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of every n consecutive codes, one for each start at which n codes follow."""
    if len(code) < n:
        return np.zeros(0, np.uint64)
    factor = np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)
    size = len(code) - n + 1
    total = code[:size] * factor[0]
    for k in range(1, n):
        total += code[k : k + size] * factor[k]
    return mix(total)


def windows_of(first: np.ndarray, n: int) -> np.ndarray:
    """Starts of all runs of n words that lie inside one row."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    total = int(counts.sum())
    shift = np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + shift
