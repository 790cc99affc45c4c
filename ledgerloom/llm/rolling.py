"""Bytes of Arrow text columns as numpy arrays, and polynomial hashes of their substrings (modulo 2^64, over randomised byte values)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random value for each byte; the same in all workers.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))

_tables: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, from exponent 0, at least ``n`` of each."""
    if not _tables or len(_tables[0]) < n:
        size = max(n, 1 << 20)
        both = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _tables[:] = both
    return _tables[0], _tables[1]


class Hashes:
    """``of(starts, ends)``: hashes of substrings of ``data``; equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])

    def grams(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:-k]) * self.down[: max(n, 0)])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column in UTF-8, null as empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def row_groups(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows [i, j) of about ``size`` bytes; a longer row is alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = j
