"""Hashes of many byte ranges of one buffer, computed with array operations."""

from __future__ import annotations

import numpy as np

_random = np.random.Generator(np.random.PCG64(20240229))
CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class RangeHasher:
    """64-bit hash of each range [start, end) of a buffer.

    A running sum of code * base**position gives every range by one
    subtraction; the inverse power takes its position out again. The codes are
    random odd numbers, so unequal ranges meet with a chance of about 2**-64.
    """

    def __init__(self) -> None:
        self.up = self.down = powers(1, 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data) + 1:
            size = 1 << (len(data) + 1).bit_length()
            self.up, self.down = powers(BASE, size), powers(BASE_INVERSE, size)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(CODES[data] * self.up[: len(data)], out=total[1:])
        raw = (total[ends] - total[starts]) * self.down[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
