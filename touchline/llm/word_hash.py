"""Hashes of words and of word sequences anywhere in a text, by running sums over bytes and words."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
# Any odd base will do; these are splitmix64's constants.
BASE = U64(0x9E3779B97F4A7C15)
MIX = [U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)]


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's last steps: spreads every input bit over all output bits."""
    x = (x ^ (x >> U64(30))) * MIX[0]
    x = (x ^ (x >> U64(27))) * MIX[1]
    return x ^ (x >> U64(31))


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base modulo 2 ** 64, and of its inverse; kept for the next call."""
    global _powers
    if len(_powers[0]) < count:
        inverse = U64(pow(int(BASE), -1, 1 << 64))
        both = []
        for base in (BASE, inverse):
            row = np.full(count, base, np.uint64)
            row[0] = 1
            both.append(np.cumprod(row))
        _powers = (both[0], both[1])
    return _powers[0][:count], _powers[1][:count]


def running(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the base, before each place and after the last."""
    up, _ = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return sums


def between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the values from each start to its end; equal sequences hash alike wherever they stand."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * MIX[0])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return between(running(BYTE_VALUES[data]), starts, ends)
