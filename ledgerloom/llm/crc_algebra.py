"""CRC-32 of many strings at once, and of their concatenations from their parts alone.

Appending n zero bytes to a message is a linear map of the CRC over GF(2); its
matrices for n = 1, 2, 4, ... are squares of each other. So the CRC of a + b is
that of a, moved by the length of b, plus that of b: nothing is put together.
"""

from __future__ import annotations

import zlib

import numpy as np

# Fixed value: the reversed polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

#: Words longer than this are left to zlib, one by one.
LONG = 64


def _byte_table() -> np.ndarray:
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & 1, (r >> 1) ^ np.uint32(POLYNOMIAL), r >> 1).astype(np.uint32)
    return r


_BYTE = _byte_table()


def _lookup(columns: np.ndarray) -> np.ndarray:
    """Four tables, by the bytes of a vector, of a matrix given by its 32 columns."""
    out = np.zeros((4, 256), dtype=np.uint32)
    value = np.arange(256)
    for bit in range(32):
        out[bit // 8] ^= np.where(value >> (bit % 8) & 1, columns[bit], 0).astype(np.uint32)
    return out


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 0xFF] ^ table[1][crc >> 8 & 0xFF] ^ table[2][crc >> 16 & 0xFF] ^ table[3][crc >> 24]


def _shift_tables() -> list[np.ndarray]:
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    columns = _BYTE[unit & 0xFF] ^ (unit >> np.uint32(8))  # one zero byte
    tables = []
    for _ in range(40):
        tables.append(_lookup(columns))
        columns = _apply(tables[-1], columns)
    return tables


#: Shifts by 1, 2, 4, ... bytes.
SHIFTS = _shift_tables()


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Each CRC moved over ``length`` bytes that follow."""
    crc = crc.copy()
    for k in range(int(length.max()).bit_length() if len(length) else 0):
        at = np.flatnonzero(length >> k & 1)
        crc[at] = _apply(SHIFTS[k], crc[at])
    return crc


def joined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of concatenations, from the CRCs of both parts and the second's length."""
    return shifted(first, length) ^ second


def crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each data[start[i]:end[i]], a byte of all of them at a time."""
    length = end - start
    order = np.argsort(-length, kind="stable")
    begin, size = start[order], length[order]
    register = np.full(len(order), 0xFFFFFFFF, dtype=np.uint32)
    n_long = int(np.searchsorted(-size, -LONG, side="left"))
    for p in range(int(size[n_long]) if n_long < len(size) else 0):
        live = slice(n_long, int(np.searchsorted(-size, -p, side="left")))
        register[live] = _BYTE[(register[live] ^ data[begin[live] + p]) & 0xFF] ^ (register[live] >> np.uint32(8))
    register ^= np.uint32(0xFFFFFFFF)
    for i in range(n_long):
        register[i] = zlib.crc32(data[begin[i] : begin[i] + size[i]].tobytes())
    out = np.empty_like(register)
    out[order] = register
    return out
