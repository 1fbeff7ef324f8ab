"""Hashes of words and of word runs, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_MIX = np.uint64(0x9E3779B97F4A7C15)
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
# Distinct words remembered per task, some 50 MB.
CACHE_WORDS = 300_000


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


class WordHasher:
    """64-bit hashes of words, remembered for frequent words."""

    def __init__(self):
        self.known = {}

    def __call__(self, words: list) -> np.ndarray:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n words; of the whole sequence if it is shorter, none if it is empty."""
    if not len(hashes):
        return hashes
    n = min(n, len(hashes))
    count = len(hashes) - n + 1
    value = np.full(count, n, dtype=np.uint64)
    for i in range(n):
        value = scramble((value ^ hashes[i:i + count]) + _MIX)
    return value
