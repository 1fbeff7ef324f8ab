"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of lower-cased words. Five-word
runs that both hold are seeds; a pair whose seeds could cover enough of the item
is tiled: the longest common stretches of unmarked words, found by running
Karp-Rabin hashes, are marked again and again until none of five words is left.
The share of the item's words that lie in tiles decides, in whatever order the
passages stand.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from wakeline.llm.shingles import WordHasher, runs

MIN_TILE = 5
COVERAGE = 0.8
FIRST_LENGTH = 20
# Words of benchmark text that one pass over the documents holds in each task, some 100 MB.
BLOCK_WORDS = 2_000_000
# ASCII characters other than letters and digits part words; all others belong to them.
_PARTED = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words without ASCII punctuation, in UTF-8."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_PARTED).split()


_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]))


def _running(x: np.ndarray, n: int, powers: np.ndarray) -> np.ndarray:
    """The Karp-Rabin hash of each run of n: differences of one running sum, shifted to a common power."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(x * powers[:len(x)])])
    return (sums[n:] - sums[:-n]) * powers[len(powers) - 1 - np.arange(len(x) - n + 1)]


def _clear(free: np.ndarray, n: int) -> np.ndarray:
    """Where n unmarked words start."""
    ends = np.concatenate([[0], np.cumsum(free)])
    return ends[n:] - ends[:-n] == n


def _maximal(a, b, free_a, free_b, length, powers):
    """The matches of at least `length` unmarked words that can't be extended: (length, start in a, start in b)."""
    if min(len(a), len(b)) < length:
        return []
    hash_a, hash_b = _running(a, length, powers), _running(b, length, powers)
    places = {}
    for j in np.flatnonzero(_clear(free_b, length)).tolist():
        places.setdefault(int(hash_b[j]), []).append(j)
    found = []
    for i in np.flatnonzero(_clear(free_a, length) & np.isin(hash_a, hash_b)).tolist():
        for j in places.get(int(hash_a[i]), ()):
            if i and j and a[i - 1] == b[j - 1] and free_a[i - 1] and free_b[j - 1]:
                continue  # part of a match that starts earlier
            n, most = 0, min(len(a) - i, len(b) - j)
            while n < most and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                n += 1
            if n >= length:  # else only the hashes agree
                found.append((n, i, j))
    return sorted(found, key=lambda m: (-m[0], m[1], m[2]))


def tile(a: np.ndarray, b: np.ndarray, min_tile: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """The tiles of two hash sequences: (start in a, start in b, length), in the order of marking.

    The search length starts at FIRST_LENGTH and is halved down to min_tile when
    nothing of it is left; a match of more than twice the length restarts it
    there. Of equally long matches the first in a, then in b, is marked.
    """
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    powers = _powers(max(len(a), len(b)))
    tiles, length = [], max(FIRST_LENGTH, min_tile)
    while True:
        found = _maximal(a, b, free_a, free_b, length, powers)
        if found and found[0][0] > 2 * length:
            length = found[0][0]
            continue
        for n, i, j in found:
            if free_a[i:i + n].all() and free_b[j:j + n].all():
                free_a[i:i + n] = free_b[j:j + n] = False
                tiles.append((i, j, n))
        if not found:
            if length <= min_tile:
                return tiles
            length = max(min_tile, length // 2)


class _Items:
    """A block of benchmark items, indexed by their runs of words."""

    def __init__(self, rows, min_tile):
        hasher = WordHasher()
        self.words = [(item, hasher(tokens(text))) for item, text in rows]
        self.words = [(item, w) for item, w in self.words if len(w)]
        grams = [runs(w, min_tile) for _, w in self.words]
        gram = np.concatenate([*grams, np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.zeros(0, np.int64)])
        order = np.argsort(gram, kind="stable")
        self.gram, self.owner, self.place = gram[order], owner[order], place[order]
        self.bits = max(16, (16 * len(gram)).bit_length())
        self.maybe = np.zeros(1 << self.bits, bool)
        self.maybe[gram >> np.uint64(64 - self.bits)] = True

    def shared(self, seen: np.ndarray) -> np.ndarray:
        """Those of the runs that some item has: a bitmap first, then a search."""
        seen = np.unique(seen[self.maybe[seen >> np.uint64(64 - self.bits)]])
        at = np.searchsorted(self.gram, seen)
        return seen[(at < len(self.gram)) & (self.gram[np.minimum(at, len(self.gram) - 1)] == seen)] if len(self.gram) else seen

    def candidates(self, seen: np.ndarray, min_tile: int, coverage: float):
        """The items whose words in shared runs could reach the coverage."""
        at = np.searchsorted(self.gram, seen)
        at_end = np.searchsorted(self.gram, seen, side="right")
        rows = np.concatenate([*(np.arange(s, e) for s, e in zip(at, at_end) if e > s), np.zeros(0, np.int64)]).astype(np.int64)
        for k in np.unique(self.owner[rows]).tolist():
            item, w = self.words[k]
            cover = np.zeros(len(w) + min_tile, bool)
            starts = self.place[rows[self.owner[rows] == k]]
            for d in range(min(min_tile, len(w))):
                cover[starts + d] = True
            if cover.sum() >= coverage * len(w):
                yield item, w


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, min_tile: int = MIN_TILE,
          block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, covered, n_words, coverage, n_tiles, spans.

    `spans` lists the tiles as (start in the document, start in the item,
    length) in words. Items of fewer than min_tile words leak only as a whole;
    items and documents without words leak nothing. The benchmark is taken in
    blocks of bounded size, each with one pass over the documents; each item is
    compared with every document. Items of equal id are compared separately.
    """
    spark = docs.sparkSession
    schema = ("doc_id bigint, item_id bigint, covered int, n_words int, coverage double, n_tiles int, "
              "spans array<struct<doc_start:int,item_start:int,length:int>>")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def search(block):
        shared = spark.sparkContext.broadcast(block)

        def run(frames):
            items, hasher = _Items(shared.value, min_tile), WordHasher()
            shortest = {len(w) for _, w in items.words if len(w) < min_tile}
            for frame in frames:
                out = []
                for doc_id, text in zip(frame["doc_id"], frame["text"]):
                    a = hasher(tokens(text))
                    if not len(a):
                        continue
                    seen = runs(a, min_tile) if len(a) >= min_tile else np.zeros(0, np.uint64)
                    seen = np.concatenate([seen, *(runs(a, n) for n in shortest if n <= len(a))])
                    for item, b in items.candidates(items.shared(seen), min_tile, coverage):
                        found = tile(a, b, min(min_tile, len(b)))
                        covered = sum(n for _, _, n in found)
                        if covered >= coverage * len(b):
                            out.append((doc_id, item, covered, len(b), covered / len(b), len(found),
                                        [dict(doc_start=i, item_start=j, length=n) for i, j, n in sorted(found)]))
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "covered", "n_words", "coverage", "n_tiles", "spans"]).astype(
                    {"doc_id": "Int64", "item_id": "Int64"})
        return docs.mapInPandas(run, schema)

    result = None
    for block in _blocks(benchmark, block_words):
        found = search(block)
        result = found if result is None else result.unionByName(found)
    return spark.createDataFrame([], schema) if result is None else result


def _blocks(benchmark: DataFrame, block_words: int):
    """The items in lists of about block_words words each, streamed through the driver."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("bigint"), "text").toLocalIterator():
        block.append((row[0], row[1]))
        size += len(tokens(row[1]))
        if size >= block_words:
            yield block
            block, size = [], 0
    if block:
        yield block
