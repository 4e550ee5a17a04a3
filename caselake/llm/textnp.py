"""Whole Arrow batches of texts as one byte array.

Functions here work on all texts of a slice at once, so Python runs per slice
and not per document. Every hash is a polynomial over substituted bytes modulo
2**64 taken from one running sum, followed by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on together; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 18
U64 = np.uint64
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) for runs of rows of about ``limit`` bytes.

    A null counts as an empty text.
    """
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _substitution(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0x632BE59BD9B4E019) + U64(seed & 0xFFFFFFFF)) | U64(1)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept for slices of ordinary length."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.cumprod(np.concatenate([[U64(1)], np.full(n - 1, base, dtype=U64)]), dtype=U64)
        if n <= 2 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


class RollingHash:
    """Hashes of any stretches [start, end) of a byte array."""

    def __init__(self, data: np.ndarray, which: int = 0):
        self.base = BASES[which]
        n = len(data) + 1
        terms = _substitution(which + 1)[data] * powers(self.base, n)[:-1]
        self.sums = np.concatenate([np.zeros(1, U64), np.cumsum(terms, dtype=U64)])
        self.back = powers(pow(self.base, -1, 1 << 64), n)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])


_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of all words; words never cross texts."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~_SEPARATOR[data]
    begins = np.zeros(len(data) + 1, dtype=bool)  # a text begins here
    begins[offsets[:-1]] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | begins[1:-1]
    start = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row
