"""Vectorised 64-bit hashes of byte ranges over whole Arrow string columns.

A prefix sum of ``value[byte] * base**position`` (modulo 2**64) gives the hash
of any byte range in constant time, the same wherever the range stands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 19  # bytes of rows hashed together
U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of each value (a bijection)."""
    h = h ^ (h >> U(31))
    h = h * U(0x9E3779B97F4A7C15)
    h = h ^ (h >> U(29))
    h = h * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


class Base:
    """One hash function: a value for each byte and the powers of its base."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.base = int(rng.integers(1 << 62, 1 << 63)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
        self.powers = self.back = np.ones(0, np.uint64)

    def sized(self, n: int) -> None:
        if len(self.powers) < n:
            for name, b in (("powers", self.base), ("back", self.inverse)):
                steps = np.full(max(n, SLICE + 4096), b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        self.sized(len(data) + 1)
        h = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.powers[:len(data)], out=h[1:])
        return h

    def ranges(self, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((h[end] - h[start]) * self.back[start])


WORDS, LONG = Base(1), Base(2)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
INK = np.ones(256, bool)  # all but ASCII white space
INK[[9, 10, 11, 12, 13, 32]] = False
LETTERS = np.arange(256) >= 128  # letters, digits and bytes of longer characters
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of a string column with about ``most`` bytes each: (first row,
    row after the last, bytes, offsets of the rows in the bytes and their end)."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_hashes(data: np.ndarray, off: np.ndarray, of: np.ndarray = INK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of the bytes ``of``, A-Z lower-cased) of the
    rows in ``data``, and the word number at which each row starts."""
    low = LOWER[data]
    ink = of[low]
    first = np.zeros(len(low) + 1, bool)
    first[off] = True  # a row's first byte starts a word anew
    cut = first[:-1].copy()
    cut[1:] |= ~ink[:-1]
    start = np.flatnonzero(ink & cut)
    stop = np.ones(len(low), bool)
    stop[:-1] = ~ink[1:] | first[1:-1]
    end = np.flatnonzero(ink & stop) + 1
    h = WORDS.ranges(WORDS.prefix(low), start, end)
    return h, np.searchsorted(start, off)
