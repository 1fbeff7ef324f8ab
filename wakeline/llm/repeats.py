"""Repeated passages, byte for byte, by merging Burrows-Wheeler transforms of text pieces.

A string of LENGTH bytes is found with the smallest hash of its runs of GRAM
bytes, its anchor; equal strings have equal anchors. So texts are cut into
segments, the strings that share one anchor, and only segments whose anchor
comes again are compared, with those of the same anchor. Equal segments are one
string, known by the place of the first; where that leaves one string of an
anchor, there is nothing to compare, as the strings of a segment all differ in
how far before the anchor they begin.

The strings of many anchors make a unit. Each half of a unit is sorted by
itself and has its own Burrows-Wheeler transform; the two are merged by
refining their interleave, a character at a time: a stable sort of the
transforms' characters in the order so far gives the order by one character
more, and the bounds between groups with equal beginnings. After LENGTH rounds
such a group is a repeated interval: the strings of LENGTH bytes that are equal.
All but the earliest of each are covered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wakeline.llm.common import broadcast_if, buffer, kept_in_worker
from wakeline.llm.shingles import scramble
from wakeline.operators import skew

LENGTH, GRAM = 100, 32
# Bytes of text whose anchors are searched at once.
CHUNK = 1 << 16
# Strings of an anchor up to which they stay together, and the bytes of a unit of whole anchors.
STRINGS, UNIT = 8_000, 1 << 16
# Anchors with too many strings up to this number are joined by broadcast (some 40 MB).
MAX_BROADCAST_ANCHORS = 1_000_000
# An odd multiplier and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers, kept in the worker."""
    size = 1 << n.bit_length()

    def make():
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)
    return kept_in_worker(("powers", base, size), make)[:n]


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all runs of `gram` bytes, for every string of `length` bytes the place of its first smallest).

    Smallest by the upper half of the hash.
    """
    x = (data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])
    hashes = scramble((total[gram:] - total[:-gram]) * _powers(INVERSE, len(data) - gram + 1))
    low = np.uint64(0xFFFFFFFF)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    span, width = length - gram + 1, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[step:], least[:-step])
        width += step
    return hashes, (least & low).astype(np.int64)


def cut_segments(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """The segments of texts that lie one after another in `data`, each up to its end.

    Returns arrays of text number, start in `data`, size, place of the anchor
    in the segment and the anchor's hash. Strings do not reach over an end.
    """
    begins = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - begins >= length)
    steps = np.zeros(len(data) + 1, np.int8)
    steps[begins[long]] += 1
    steps[ends[long] - length + 1] -= 1
    inside = np.cumsum(steps[:-1], dtype=np.int8).view(bool)
    out = []
    for at in range(0, max(len(data) - length + 1, 0), CHUNK):
        hashes, place = anchors(data[at:at + CHUNK + length - 1], length, gram)
        starts = np.flatnonzero(inside[at:at + len(place)])
        if not len(starts):
            continue
        place = place[starts]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = starts[np.concatenate([first[1:], [len(place)]]) - 1]
        place, first = place[first], starts[first]
        out.append((first + at, last - first + length, place - first, hashes[place].view(np.int64)))
    start, size, core, anchor = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4
    return np.searchsorted(ends, start, "right"), start, size, core, anchor


def segments(docs: DataFrame, length: int, gram: int, places: bool) -> DataFrame:
    """Every segment of (doc, text): anchor, and with `places` also digest, doc, start, size, core.

    `core` is where the anchor stands in the segment.
    """
    def run(batches):
        for batch in batches:
            data, ends = buffer(batch.column(1))
            text, start, size, core, anchor = cut_segments(data, ends, length, gram)
            columns = {"anchor": pa.array(anchor, pa.int64())}
            if places:
                view = memoryview(np.ascontiguousarray(data))
                digest = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), (start + size).tolist())),
                                     np.uint64, len(start)).view(np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                columns |= {"digest": pa.array(digest), "doc": batch.column(0).take(pa.array(text, pa.int64())),
                            "start": pa.array(start - begins[text], pa.int64()), "size": pa.array(size, pa.int32()),
                            "core": pa.array(core, pa.int32())}
            yield pa.RecordBatch.from_pydict(columns)
    schema = "anchor bigint" + (", digest bigint, doc bigint, start bigint, size int, core int" if places else "")
    return docs.mapInArrow(run, schema)


def _strings(docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(key, lo, hi, core, doc, start, bytes) of the first places, cut out of their documents."""
    lists = firsts.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "size", "core")).alias("cuts"))

    def rows(out):
        columns = zip(*out) if out else [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=["key", "core", "doc", "start", "bytes"])

    def run(batches):
        out = []
        for batch in batches:
            for doc, text, cuts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                text = text.as_py()
                out += [(c["anchor"], c["core"], doc, c["start"], text[c["start"]:c["start"] + c["size"]]) for c in cuts.as_py()]
                if len(out) >= 20_000:
                    yield rows(out)
                    out = []
        yield rows(out)
    return docs.join(lists, "doc").select("doc", F.col("text").cast("binary"), "cuts").mapInArrow(
        run, "key bigint, core int, doc bigint, start bigint, bytes binary")


def _bounded(strings: DataFrame, length: int, gram: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(strings, covered): the strings with no key of more than `most`, and (doc, begin, stop) that this shows to be covered.

    The strings of LENGTH bytes around an anchor begin 0 to LENGTH - GRAM bytes
    before it. Those of a key with too many strings are parted by that number;
    the strings of a part have more in common than the anchor, and that is
    their key. Where one number is left, equal keys are equal strings.
    """
    left = strings.withColumns({"lo": F.lit(0), "hi": F.lit(length - gram)})
    covered, done = [], []
    while True:
        large = skew.settle(left.filter("lo < hi").groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).select("key"))
        if large.isEmpty():
            break
        side = broadcast_if(large, MAX_BROADCAST_ANCHORS)
        done.append(left.join(side, "key", "left_anti"))
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = left.join(side, "key", "left_semi").withColumn("half", F.explode(F.array(
            F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct((middle + 1).alias("lo"), F.col("hi").alias("hi")))))
        # The strings at hand begin `least` to `core` bytes before the anchor.
        least = F.col("core") - F.length("bytes") + length
        ranged = halves.withColumns({"lo": F.col("half.lo"), "hi": F.col("half.hi")}).withColumns(
            {"nearest": F.greatest("lo", least), "farthest": F.least("hi", "core")}).filter("nearest <= farthest")
        cut = ranged.selectExpr(
            f"xxhash64(key, lo, hi, substring(bytes, core - lo + 1, {length} - (hi - lo))) as key", "lo", "hi", "farthest as core", "doc",
            "start + core - farthest as start", f"substring(bytes, core - farthest + 1, farthest - nearest + {length}) as bytes")
        cut = skew.settle(cut)
        same = ["key", "lo", "hi", "core", "bytes"]
        least_place = skew.settle(cut.groupBy(*same).agg(F.min(F.struct("doc", "start")).alias("place")))
        covered.append(cut.join(least_place, same).filter("struct(doc, start) <> place").selectExpr(
            "doc", "start as begin", "start + length(bytes) as stop"))
        left = least_place.select(*same, "place.*")
    none = strings.limit(0).selectExpr("doc", "start as begin", "start as stop")
    for part in done:
        left = left.unionByName(part)
    for part in covered:
        none = none.unionByName(part)
    return left, none


def _apart(ordered: np.ndarray) -> np.ndarray:
    """For each value of a list whether it is the first of its run of equal ones."""
    first = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    return first


class Shard:
    """Strings and their suffixes in order.

    Every string ends with a character of its own, smaller than all others and
    ordered as the strings are, so that no two suffixes are equal. A suffix is
    known by its row, its place in the order. Characters have `bits` bits.
    """

    def __init__(self, texts: list[np.ndarray], bits: int = 9):
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.sizes, self.begins = sizes, np.cumsum(sizes) - sizes
        self.owner = np.repeat(np.arange(len(texts)), sizes)
        # Characters from each place to its string's end, the last one included.
        self.to_end = np.repeat(self.begins + sizes, sizes) - np.arange(sizes.sum())
        self.symbols = np.zeros(len(self.owner), np.int64)
        if texts:
            self.symbols[self.to_end > 1] = np.concatenate(texts)
        # As many characters as one number holds are a suffix's head.
        self.bits, self.head = bits, 63 // bits
        self.order, self.heads = self._sorted()

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """(places of the suffixes in order, their first `head` characters as one number).

        By the heads, then those that are still equal by the ranks of what follows, each round several times as far.
        """
        n, k = len(self.symbols), self.head
        packed = np.zeros(n, np.int64)
        for j in range(k):
            packed <<= self.bits
            m = max(n - j, 0)
            packed[:m] |= self.symbols[j:] * (self.to_end[:m] > j)
        order = np.argsort(packed)
        heads = packed[order]
        rank, width = np.empty(n, np.int64), n.bit_length()
        parts = 64 // width if n else 0
        tied, new = np.arange(n), _apart(heads)
        while len(tied):
            # A rank is the place of the first that is equal so far.
            rank[order[tied]] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
            tied = tied[~(new & np.append(new[1:], True))]
            at = order[tied]
            left, key = self.to_end[at], rank[at].astype(np.uint64)
            for far in range(k, k * parts, k):
                more = np.where(left > far, rank[np.minimum(at + far, n - 1)], self.owner[at] if far == k else 0)
                key = key << np.uint64(width) | more.astype(np.uint64)
            by_key = np.argsort(key)
            order[tied], new = at[by_key], _apart(key[by_key])
            k *= parts
        return order, heads

    def before(self, step: int) -> np.ndarray:
        """For each row, the row of the suffix that begins `step` characters earlier, around the string's end."""
        rank = np.empty(len(self.order), np.int64)
        rank[self.order] = np.arange(len(self.order))
        owner = self.owner[self.order]
        return rank[self.begins[owner] + (self.order - self.begins[owner] - step) % self.sizes[owner]]


def interleave(a: Shard, b: Shard, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """How the sorted suffixes of two shards interleave by their first `rounds` characters.

    Returns the rows in that order, b's counted on after a's, and for each the
    number of its group: rows of a group have equal first `rounds` characters.

    The characters before a suffix, which are its shard's Burrows-Wheeler
    transform, say where the suffix that begins with them goes: a stable sort by
    them in the order so far gives the order by as many characters more. They
    are taken `step` at a time, as many as make no more than 2^16 different ones.
    The groups begin with as many characters as whole steps leave over.
    """
    n = len(a.order) + len(b.order)
    for step in range(min(a.head, rounds), 0, -1):
        heads = [x.heads >> x.bits * (x.head - step) for x in (a, b)]
        firsts = [_apart(h) for h in heads]
        kinds = np.sort(np.concatenate([h[f] for h, f in zip(heads, firsts)]), kind="stable")
        kinds = kinds[_apart(kinds)]
        if len(kinds) <= 1 << 16 or step == 1:
            break
    head = np.concatenate([np.searchsorted(kinds, h[f]).astype(np.uint16)[np.cumsum(f) - 1] for h, f in zip(heads, firsts)])
    back = np.concatenate([a.before(step), b.before(step) + len(a.order)]).astype(np.int32)
    transform = head[back]
    to_end = np.concatenate([x.to_end[x.order] for x in (a, b)])
    rows = np.argsort(head, kind="stable").astype(np.int32)

    def bounds(chars):
        """Where the first `chars` characters differ from those of the row before; all that end within them do."""
        ended = np.flatnonzero(to_end[rows] <= chars)
        apart = _apart((kinds >> a.bits * (step - chars))[head[rows]])
        apart[ended] = True
        apart[ended[ended < n - 1] + 1] = True
        return apart

    # Suffixes that end within `step` characters are in their last places from the first round on.
    settled = np.flatnonzero(to_end[rows] <= step)
    stay, apart = rows[settled], bounds(step)
    group = np.cumsum(bounds((rounds - 1) % step + 1), dtype=np.int32)
    for _ in range((rounds - 1) // step):
        order = np.argsort(transform[rows], kind="stable")
        rows, group = back[rows[order]], group[order]
        rows[settled] = stay
        group = np.cumsum(apart | _apart(group), dtype=np.int32)
    return rows, group


def _codes(texts: list[bytes]) -> list[np.ndarray]:
    """Texts as arrays of numbers from 1 on in byte order, one for each byte that occurs."""
    whole = np.frombuffer(b"".join(texts), np.uint8)
    number = np.cumsum(np.bincount(whole, minlength=256) > 0)
    return np.split(number[whole], np.cumsum([len(t) for t in texts])[:-1])


def repeated(texts: list[bytes], docs: list[int], starts: list[int], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(doc, begin, stop): what strings of `length` bytes cover in these texts that are also met earlier.

    Each text stands in a document from a place on; earlier is in a smaller
    document, or in the same one at a smaller place.
    """
    codes, half = _codes(texts), len(texts) // 2
    bits = len(set().union(*texts)).bit_length() or 1
    a, b = Shard(codes[:half], bits), Shard(codes[half:], bits)
    rows, group = interleave(a, b, length)
    owner = np.concatenate([a.owner[a.order], b.owner[b.order] + half])[rows]
    offset = np.concatenate([x.order - x.begins[x.owner[x.order]] for x in (a, b)])[rows]
    ids, rank = np.unique(np.array(docs, np.int64), return_inverse=True)
    place = (rank[owner] << 40) + np.array(starts, np.int64)[owner] + offset
    bounds = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    earliest = np.repeat(np.minimum.reduceat(place, bounds), np.diff(np.append(bounds, len(group))))
    later = np.unique(place[place != earliest])
    if not len(later):
        return []
    # Strings that overlap or touch make one run.
    breaks = np.flatnonzero(later[1:] - later[:-1] > length)
    first, last = later[np.concatenate([[0], breaks + 1])], later[np.concatenate([breaks, [len(later) - 1]])]
    low = (1 << 40) - 1
    return list(zip(ids[first >> 40].tolist(), (first & low).tolist(), ((last & low) + length).tolist()))


def _merged(strings: DataFrame, length: int) -> DataFrame:
    """(doc, begin, stop): what is covered in the strings, by units of whole keys."""
    def run(batches):
        key, held, bytes_held, out = None, [], 0, []

        def settle_unit():
            if len(held) > 1:
                out.extend(repeated([t for _, _, t in held], [d for d, _, _ in held], [s for _, s, _ in held], length))

        for batch in batches:
            for k, doc, start, text in zip(*(c.to_pylist() for c in batch.columns)):
                if k != key and bytes_held >= UNIT:
                    settle_unit()
                    held, bytes_held = [], 0
                key = k
                held.append((doc, start, text))
                bytes_held += len(text)
            yield _spans(out)
            out = []
        settle_unit()
        yield _spans(out)

    ordered = strings.select("key", "doc", "start", "bytes").repartition("key").sortWithinPartitions("key")
    return ordered.mapInArrow(run, "doc bigint, begin bigint, stop bigint")


def _spans(out) -> pa.RecordBatch:
    columns = zip(*out) if out else [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc", "begin", "stop"])


def covered(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = STRINGS) -> DataFrame:
    """(doc, begin, stop): stretches of bytes that repeat, in any order and overlapping, of (doc, text) without nulls."""
    seen = segments(docs, length, gram, places=False).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    again = skew.settle(seen.filter("n > 1").select("anchor"))
    found = skew.settle(segments(docs, length, gram, places=True).join(again, "anchor", "left_semi"))
    same = ["anchor", "digest", "core", "size"]
    firsts = skew.settle(found.groupBy(*same).agg(F.min(F.struct("doc", "start")).alias("place")))
    copies = found.join(firsts, same).filter("struct(doc, start) <> place").selectExpr("doc", "start as begin", "start + size as stop")
    shared = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    compared = firsts.join(shared, "anchor", "left_semi")
    strings = skew.settle(_strings(docs, compared.select("anchor", "size", "core", "place.*")))
    bounded, parted = _bounded(strings, length, gram, most)
    return copies.unionByName(parted).unionByName(_merged(bounded, length))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = STRINGS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, and the bytes that stay (`kept`, binary).

    A byte goes if a string of `length` bytes that covers it also starts
    earlier: in a document with a smaller id, or in the same one before. A null
    text is empty. Rows of one doc_id are one document and must have one text;
    rows without a doc_id stay whole and nothing is removed for them. Other
    columns are left out.
    """
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    gone = covered(named.filter("doc is not null"), length, gram, most).groupBy("doc").agg(
        F.collect_list(F.struct("begin", "stop")).alias("spans"))

    def run(batches):
        for batch in batches:
            sizes, removed, spans, kept = [], [], [], []
            for text, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                at, parts, n = 0, [], 0
                for a, b in sorted((c["begin"], c["stop"]) for c in cuts or ()):
                    if a > at or not n:
                        n += 1
                        parts.append(text[at:a])
                    at = max(at, b)
                parts.append(text[at:])
                kept.append(b"".join(parts))
                sizes.append(len(text))
                removed.append(len(text) - len(kept[-1]))
                spans.append(n)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return named.join(gone, "doc", "left").select("doc", F.col("text").cast("binary"), "spans").mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
