"""Minimal perfect hashing over pairs of 64-bit hashes, in numpy.

Keys are placed level by level: in a bit array of 1.5 bits per key left, a key that has
its bit to itself stays, the others go on to the next level. The number of a key is the
count of set bits before its own, so n keys get the numbers 0 to n - 1.
"""

from __future__ import annotations

import numpy as np

ROOM = 1.5
ABSENT = -1
_ODD = np.uint64(0x9E3779B97F4A7C15)  # 2 ** 64 over the golden ratio


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    x = (a + np.uint64((level + 1) * int(_ODD) % 2**64)) ^ (b * _ODD)
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(29))) * _ODD
    return x ^ (x >> np.uint64(32))


class MinimalHash:
    """``bits`` holds the levels one after another, ``sizes`` their lengths in bits."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        self.bits, self.sizes = bits, sizes
        counts = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> MinimalHash:
        """Over distinct pairs ``(a[i], b[i])``."""
        levels, sizes = [], []
        while len(a):
            size = 64 * (int(ROOM * len(a)) // 64 + 1)
            at = (_mix(a, b, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").view(np.uint64))
            sizes.append(size)
            left = ~alone[at]
            a, b = a[left], b[left]
        bits = np.concatenate(levels) if levels else np.zeros(0, np.uint64)
        return cls(bits, np.array(sizes, np.int64))

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each pair; ABSENT or any number for a pair that is not a key."""
        found = np.full(len(a), ABSENT, np.int64)
        open_ = np.arange(len(a))
        start = 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (_mix(a[open_], b[open_], level) % np.uint64(size)).astype(np.int64) + start
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[open_[hit]] = self.before[at[hit] >> 6] + np.bitwise_count(below)
            open_ = open_[~hit]
            start += int(size)
        return found
