"""Hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_tables: list[np.ndarray] = []


def byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64)


def odd_numbers(seed: int, n: int) -> np.ndarray:
    return (np.random.default_rng(seed).integers(1, 1 << 62, n, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of an odd base and of its inverse, modulo 2**64. A process keeps one pair of tables."""
    if not _tables or len(_tables[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(size, np.uint64(base), np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table, out=table))
        if size > 1 << 22:
            return tuple(tables)
        _tables[:] = tables
    return tuple(_tables)


def prefix_sums(data: np.ndarray, table: np.ndarray, up: np.ndarray) -> np.ndarray:
    """sums[j] - sums[i], times the inverse power i, is the hash of data[i:j]."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[:len(data)], out=sums[1:])
    return sums


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer: every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of each run of bytes other than space, tab, line feed, VT, FF and CR."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = powers(len(data) + 1)
    sums = prefix_sums(data, table, up)
    return (sums[ends] - sums[starts]) * down[starts], starts
