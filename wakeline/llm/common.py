"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import types

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

# The white space that separates words: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"


def parts(text: Column) -> Column:
    """What a text's blanks separate, empty strings included: one more than there are blanks."""
    return F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", -1)


def words(text: Column) -> Column:
    """The words of a text, `[^\\x20\\x09-\\x0D]+`, as an array; none for a null text."""
    return F.array_remove(parts(text), "")


def let(value: Column, body) -> Column:
    """body(value), with value computed once per row however often body names it."""
    return F.transform(F.array(value), body).getItem(0)


def broadcast_if(df: DataFrame, rows: int) -> DataFrame:
    """Broadcasts a table of at most `rows` rows (counted here); else leaves the join to Spark."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def kept_in_worker(key, make):
    """make(), once in the life of a Python worker: the tasks that it runs share the object."""
    store = vars(sys.modules.setdefault("_wakeline_kept", types.ModuleType("_wakeline_kept")))
    if key not in store:
        store[key] = make()
    return store[key]


def give_back() -> None:
    """Returns freed memory to the system: Arrow and the C library keep what a batch took for the worker's next one."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a batch's texts, one after another, and where each ends; null is empty."""
    texts = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return data, offsets[1:] - offsets[0]


def chunks(texts: pa.Array):
    """The chunks of texts (no nulls) between blanks, empty ones included.

    Returns the distinct chunks, the number of each chunk in that list, and
    where each text's chunks begin and the last one's end.
    """
    for blank in "\n\t":
        texts = pc.replace_substring(texts, blank, " ")
    found = pc.split_pattern(texts, " ")
    coded = found.flatten().dictionary_encode()
    ends = found.offsets.to_numpy().astype(np.int64)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), ends - ends[0]


class Remembered:
    """Numbers for strings that come again and again; too many are thinned out to those met most."""

    def __init__(self, most: int):
        self.most, self.place, self.met = most, {}, np.zeros(0, np.int64)

    def thin(self) -> np.ndarray | None:
        """If there are too many: which of the old numbers stay, renumbered in their order."""
        if len(self.place) <= self.most:
            return None
        stay = self.met >= 2
        if stay.sum() > self.most // 2:
            stay[:] = False
        self.place = {c: i for i, c in enumerate(c for c, k in zip(self.place, stay.tolist()) if k)}
        self.met = np.zeros(len(self.place), np.int64)
        return stay

    def add(self, new: list[str]) -> None:
        self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])

    def numbers(self, distinct: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.place.__getitem__, distinct), np.int64, len(distinct))
        self.met[at] += 1
        return at
