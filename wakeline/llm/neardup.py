"""MinHash near-duplicates by an inverted join over signature coordinates.

A document is posted under each (coordinate, minimum) of its signature. Postings
that no other document has are dropped; a document left with fewer than the
match threshold has no partner. Of the others only the prefix is merged, the
rarest postings that any pair above the threshold must share one of. Documents
that share a prefix posting meet in the group of its smallest document; there
collisions are counted, the rest of the signature being read only for pairs that
met, and pairs above the threshold are confirmed on their full shingle sets.
Each group hands on a spanning forest of its links, and components are formed
from those.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wakeline.llm.shingles import WordHasher, runs, scramble
from wakeline.operators import skew

WORDS = 5
SIMILARITY = 85  # per cent of the union
# Coordinates of a signature, and how many a pair at 85 % must share: it shares
# 54.4 on average with a deviation of 2.9, below 36 in one of 10^9.
COORDINATES, MATCHES = 64, 36
# At other similarities: the share of pairs at the limit that may be missed.
MISSED = 1e-9
# Documents of a group that one task compares with as many others.
BLOCK = 512
# Shingles per document up to which a block holds BLOCK documents.
LONG = 2000
# Groups of more than WIDE blocks are compared with a first document, up to ROUNDS times,
# before all that is left is paired; fewer blocks are paired with few copies of a document.
WIDE, ROUNDS = 3, 3
# Candidates up to this number are picked from the documents by broadcast (40 MB); more by a shuffle.
MAX_BROADCAST_IDS = 2_000_000


def matches_for(similarity: int) -> int:
    """How many coordinates a pair must share: the most that a pair at the limit misses in MISSED of all cases."""
    if similarity == SIMILARITY:
        return MATCHES
    p, below, k = similarity / 100, 0.0, 0
    while k < COORDINATES and (below := below + math.comb(COORDINATES, k) * p**k * (1 - p)**(COORDINATES - k)) <= MISSED:
        k += 1
    return max(k, 1)


def shingle_set(text: str | None, hasher: WordHasher, n: int = WORDS) -> np.ndarray:
    """The distinct hashes of n-word runs, ascending; words as bytes, A to Z lower-cased."""
    if not text:
        return np.zeros(0, np.uint64)
    return np.unique(runs(hasher(text.encode("utf-8", "surrogatepass").lower().split()), n))


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The minimum of each coordinate's hash function, as a posting key of coordinate and minimum."""
    seeds = scramble(np.arange(1, coordinates + 1, dtype=np.uint64))
    multipliers = seeds | np.uint64(1)
    least = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(shingles), 1024):  # bounded memory for long texts
        part = shingles[start:start + 1024, None] * multipliers[None, :] + seeds[None, :]
        least = np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0))
    return scramble(least ^ seeds)


def describe(docs: DataFrame) -> DataFrame:
    """Each document's set size, a digest of its set, and its signature (null if empty)."""
    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, hasher)
                sizes.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                signatures.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())], names=["doc_id", "n_shingles", "digest", "signature"])
    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, digest binary, signature binary")


def _postings(classes: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(0))
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, COORDINATES)), pa.array(keys)], names=["id", "posting"])
    return classes.select("id", "signature").mapInArrow(run, "id bigint, posting bigint")


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """(hub, id): documents that share a prefix posting with others, under its smallest document."""
    posted = _postings(classes)
    shared = (posted.groupBy("posting").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("hub"))
              .filter(F.col("n") > 1))
    rare_first = F.sort_array(F.collect_list(F.struct("n", "posting", "hub")))  # COORDINATES entries at most
    held = (posted.join(shared, "posting").groupBy("id").agg(rare_first.alias("held"))
            .filter(F.size("held") >= matches))
    # The postings that nobody shares come first in the prefix of COORDINATES - matches + 1.
    prefix = F.slice("held", F.lit(1), F.size("held") - (matches - 1))
    return held.select("id", F.explode(F.array_distinct(F.transform(prefix, lambda p: p["hub"]))).alias("hub"))


def _parts(block: int):
    """Blocks of a group by its documents' number and their sets' sizes."""
    return F.ceil(F.greatest(F.count(F.lit(1)) / block, F.sum("size") / (block * LONG))).cast("int").alias("parts")


def _groups(members: DataFrame, block: int) -> DataFrame:
    """(hub, a, b, id): each group cut into blocks, every two blocks put together once.

    A block has about `block` documents, fewer if they are long. A group of one
    block is the pair (0, 0); else a document of block k goes to all pairs that hold k.
    """
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("n"), _parts(block)).filter("n > 1")
    cut = members.join(sizes, "hub").withColumn("k", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    others = F.array_remove(F.sequence(F.lit(0), F.col("parts") - 1), F.col("k"))
    other = F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(others))
    return cut.select("hub", "id", "k", other.alias("o")).select(
        "hub", F.least("k", "o").alias("a"), F.greatest("k", "o").alias("b"), "id")


def _distances(rows: DataFrame, similarity: int) -> DataFrame:
    """(hub, id, first, far, matches): the Jaccard distance of each document to its group's first one, which is with it in every block."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        first = frame[frame["id"] == frame["first"]].iloc[0]
        own, signed = np.frombuffer(first["shingles"], np.uint64), np.frombuffer(first["signature"], np.int64)
        out = []
        for i, shingles, signature in zip(frame["id"], frame["shingles"], frame["signature"]):
            other = np.frombuffer(shingles, np.uint64)
            common = len(np.intersect1d(own, other, assume_unique=True))
            out.append((i, 1 - common / (len(own) + len(other) - common), int((np.frombuffer(signature, np.int64) == signed).sum())))
        found = pd.DataFrame(out, columns=["id", "far", "matches"]).drop_duplicates("id")
        return found.assign(hub=frame["hub"].iloc[0], first=first["id"])[["hub", "id", "first", "far", "matches"]]
    return rows.groupBy("hub", "k").applyInPandas(run, "hub bigint, id bigint, first bigint, far double, matches int")


def _shrunk(members: DataFrame, sets: DataFrame, block: int, similarity: int) -> tuple[DataFrame, DataFrame | None]:
    """(members, links): large groups without the documents that no more comparison is needed for; links are None if none is large.

    The documents of a group of more than WIDE blocks are compared with its first one.
    Those linked to it are connected. The Jaccard distance is a metric, so of
    these only the ones far enough from the first can be near one that is not
    linked to it; the others go. A group of near copies is gone then, at two
    rows a document.
    """
    sizes = skew.settle(members.groupBy("hub").agg(_parts(block), F.min("id").alias("first")).filter(F.col("parts") > WIDE))
    if sizes.isEmpty():
        return members, None
    large = members.join(sizes, "hub").filter("id <> first").select(
        "hub", "id", "first", F.pmod(F.xxhash64("id"), F.col("parts")).alias("k"))
    firsts = sizes.select("hub", F.col("first").alias("id"), "first", F.explode(
        F.sequence(F.lit(0).cast("bigint"), (F.col("parts") - 1).cast("bigint"))).alias("k"))
    measured = skew.settle(_distances(large.unionByName(firsts).join(sets, "id"), similarity))
    limit = 1 - similarity / 100 + 1e-9
    linked = F.col("far") <= limit
    nearest = measured.filter(~linked).groupBy("hub").agg(F.min("far").alias("nearest"))
    # Every group has its first document once for each block; one is enough.
    stay = (measured.join(nearest, "hub").filter(~linked | (F.col("far") >= F.col("nearest") - limit))
            .select("hub", "id").distinct())
    rest = members.join(sizes.select("hub"), "hub", "left_anti").unionByName(members.join(stay, ["hub", "id"], "left_semi"))
    links = measured.filter(linked & (F.col("id") != F.col("first"))).select(
        F.col("first").alias("u"), F.col("id").alias("v"), "matches")
    return skew.settle(rest), links


class _Forest:
    """Union-find over the positions of a group."""

    def __init__(self, n):
        self.up = list(range(n))

    def root(self, x):
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, x, y):
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def linked(ids: np.ndarray, signatures: np.ndarray, sets: list[np.ndarray], similarity: int = SIMILARITY):
    """Links that connect all documents of a group that are connected: (id, id, signature matches).

    Collisions are counted against all later documents at once; set overlaps,
    counted along the lists of the group's shared shingles, confirm them.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    ends = np.cumsum(count)
    by_value, starts = owner[order], ends - count
    first = np.concatenate([[0], np.cumsum(sizes)])
    forest, links, matches = _Forest(len(sets)), [], matches_for(similarity)
    for x in range(len(sets) - 1):
        near = x + 1 + np.flatnonzero((signatures[x + 1:] == signatures[x]).sum(axis=1) >= matches)
        near = [y for y in near.tolist() if forest.root(y) != forest.root(x)]
        if not near:
            continue
        v = place[first[x]:first[x + 1]]
        v = v[count[v] > 1]
        n = count[v]
        at = np.repeat(starts[v] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        common = np.bincount(by_value[at], minlength=len(sets))
        for y in near:
            if 100 * common[y] >= similarity * (sizes[x] + sizes[y] - common[y]) and forest.join(x, y):
                links.append((int(ids[x]), int(ids[y]), int((signatures[x] == signatures[y]).sum())))
    return links


def _confirm(grouped: DataFrame, similarity: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("id").sort_values("id")
        signatures = np.frombuffer(b"".join(frame["signature"]), np.int64).reshape(len(frame), COORDINATES)
        sets = [np.frombuffer(s, np.uint64) for s in frame["shingles"]]
        return pd.DataFrame(linked(frame["id"].to_numpy(), signatures, sets, similarity), columns=["u", "v", "matches"])
    return grouped.groupBy("hub", "a", "b").applyInPandas(run, "u bigint, v bigint, matches int")


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, shingles, signature) of the documents in `ids`, each id once."""
    few = ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    picked = docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == ids["id"], "left_semi")

    def run(batches):
        hasher = WordHasher()
        for batch in batches:
            found = [shingle_set(t, hasher) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.tobytes() for s in found], pa.binary()),
                 pa.array([signature(s).tobytes() for s in found], pa.binary())], names=["id", "shingles", "signature"])
    return picked.select("doc_id", "text").mapInArrow(run, "id bigint, shingles binary, signature binary")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (u, v): the smallest id reachable.

    Large-star and small-star steps in turn, each cut off by a written table,
    until the links are stars around the smallest ids.
    """
    edges = skew.settle(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                        .filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = skew.settle(small.select("u", F.col("m").alias("v"))
                            .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
                            .filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = now


def near_duplicates(docs: DataFrame, block: int = BLOCK, similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Documents are linked from `similarity` per cent of the union of their sets on.

    Texts without words have an empty set and are linked with nothing; so are
    rows without a doc_id, whose component is null and which are kept. Rows of
    one doc_id are one document and must have one text. Other columns are left
    out.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    noted = skew.settle(describe(docs))
    # Documents of one set are one class, known by its smallest doc_id.
    first = skew.settle(noted.filter("digest is not null and doc_id is not null").groupBy("digest")
                        .agg(F.min("doc_id").alias("id")))
    classes = noted.join(first.withColumnRenamed("id", "doc_id"), ["digest", "doc_id"], "left_semi").select(
        F.col("doc_id").alias("id"), "signature")
    members = skew.settle(_prefixes(classes, matches_for(similarity)))
    sets = skew.settle(_sets(docs, members.select("id").distinct()))
    sized = skew.settle(members.join(sets.select("id", (F.octet_length("shingles") / 8).alias("size")), "id"))
    left, stars = sized, []
    for _ in range(ROUNDS):
        left, found = _shrunk(left, sets, block, similarity)
        if found is None:
            break
        stars.append(found)
    links = _confirm(_groups(left, block).join(sets, "id"), similarity)
    for found in stars:
        links = links.unionByName(found)
    links = skew.settle(links)
    return (noted.select("doc_id", "n_shingles", "digest").join(first, "digest", "left")
            .withColumn("id", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")))
            .join(components(links), "id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
