"""Spelling variants: frequent words one edit apart, and the form each one stands for.

Two words one edit apart share what stands before the edit and what stands after
it, so they share a first half or a last half. Words are posted under the first
half and, read backwards, under the last; the words of such a group are scanned
in sorted order. Each of them extends the rows of the edit matrix that its
predecessor left for their common prefix, three cells a row for every word that
is still within one edit of that prefix; where none is, the range of words with
that prefix is passed over.

A group of too many words is cut further: its pairs share one more character, or
all that follows the next one.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wakeline.llm.common import broadcast_if
from wakeline.operators import skew

# The letters of words, the deletion rate, and the words that count.
LETTERS = "A-Za-zÀ-ÿ"
DELETED, MIN_CHARS, MIN_COUNT, RATIO = 97, 5, 3, 2
# Words of a group that one task scans at once.
GROUP = 20_000
# Groups to be cut further, up to this number, are joined by broadcast (some 40 MB).
MAX_BROADCAST_GROUPS = 500_000
FAR = 9


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all whole texts that are long and frequent enough.

    Words are maximal runs of letters with A to Z lower-cased. Where 97 divides
    the crc32 of doc_id, a colon and the run, one character of it is missing. A
    null doc_id is written as nothing; a null text has no words.
    """
    run = F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"[{LETTERS}]{{{min_chars},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run")).withColumn(
        "run", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % DELETED == 0, shorter).otherwise(F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= min_count))


def near_words(words: list[str], shared: int = 0) -> list[tuple[int, int]]:
    """Positions (i, j), i < j, of words one edit apart in a sorted list of distinct words.

    All words have their first `shared` characters in common.
    """
    sizes = [len(w) for w in words]
    # rows[k] is for the prefix of length shared + k: (word, the cells of its
    # prefixes one shorter, as long and one longer), only for words still near.
    rows = [[(j, 1 if shared else FAR, 0, 1) for j in range(len(words))]]
    found, last, common = [], "", shared
    for i, w in enumerate(words):
        # What the word has in common with the last one whose rows were computed.
        lcp, top = shared, min(common, len(w)) if i else shared
        while lcp < top and w[lcp] == last[lcp]:
            lcp += 1
        common = lcp
        del rows[lcp - shared + 1:]
        if not rows[-1]:
            continue  # the range of this prefix is passed over
        for d in range(lcp + 1, len(w) + 1):
            c, row = w[d - 1], []
            for j, x, y, z in rows[-1]:
                if j <= i:
                    continue
                q, size = words[j], sizes[j]
                a = min(y + 1, x + (d < 2 or d - 2 >= size or c != q[d - 2])) if d - 1 <= size else FAR
                b = min(z + 1, a + 1, y + (c != q[d - 1])) if d <= size else FAR
                e = min(b + 1, z + (c != q[d])) if d < size else FAR
                if a < 2 or b < 2 or e < 2:
                    row.append((j, a, b, e))
            rows.append(row)
            if not row:
                break
        depth = shared + len(rows) - 1
        last, common = w, depth
        if depth == len(w):
            for j, *cells in rows[-1]:
                by = sizes[j] - depth
                if j > i and -1 <= by <= 1 and cells[by + 1] < 2:
                    found.append((i, j))
    return found


def _prefix(length) -> Column:
    return F.substring("w", F.lit(1), length)


def _postings(words: DataFrame, min_chars: int) -> DataFrame:
    """(way, m, p, key, w, n): each word under its halves, for pairs whose shorter word has m characters.

    Way 1 has the words backwards. All words of a group have p first characters
    in common; p is 0 where the key says it all.
    """
    both = words.select("n", F.explode(F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("w")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("w")))).alias("x")).select("n", "x.*")
    sized = both.select("*", F.explode(F.array(F.length("w"), F.length("w") - 1)).alias("m")).filter(F.col("m") >= min_chars)
    half = F.floor(F.col("m") / 2)
    return (sized.withColumn("p", F.when(F.col("way") == 0, half).otherwise(F.col("m") - half).cast("int"))
            .select("way", "m", "p", _prefix(F.col("p")).alias("key"), "w", "n"))


GROUP_KEY = ["way", "m", "p", "key"]


def _bounded(postings: DataFrame, most: int) -> DataFrame:
    """The postings with groups of more than `most` words cut, until there are none.

    The words around an edit after exactly p characters share all from there but
    for two at most, so groups by that are small whatever the vocabulary.
    """
    done, left = [], postings
    while True:
        sizes = left.filter("p > 0").groupBy(*GROUP_KEY).agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") > most)
        large = skew.settle(sizes.drop("words"))
        if large.isEmpty():
            return left if not done else left.unionByName(done[0])
        side = broadcast_if(large, MAX_BROADCAST_GROUPS)
        hot = left.join(side, GROUP_KEY, "left_semi")
        rest = left.join(side, GROUP_KEY, "left_anti")
        one_more = hot.filter(F.length("w") > F.col("p")).withColumn("p", F.col("p") + 1).withColumn("key", _prefix(F.col("p")))
        tail = F.col("m") - 1 - F.col("p")
        just_here = hot.withColumn("key", F.concat("key", F.lit("\0"), F.when(tail > 0, F.expr("right(w, m - 1 - p)")).otherwise(
            F.lit("")), F.lit("\0"), F.col("p").cast("string"))).withColumn("p", F.lit(0))
        small = skew.settle(rest.unionByName(just_here))
        done = [small.unionByName(done[0]) if done else small]
        left = skew.settle(one_more)


def near_pairs(words: DataFrame, min_chars: int = MIN_CHARS, most: int = GROUP) -> DataFrame:
    """(u, v, nu, nv): every pair of words one edit apart, once, with their counts.

    `words` has distinct (word, n) of at least `min_chars` characters.
    """
    def run(batches):
        key, group, out = None, [], []

        def scan():
            if len(group) < 2:
                return
            backward, m, shared = key[0] == 1, key[1], key[2]
            for i, j in near_words([w for w, _ in group], shared):
                (u, nu), (v, nv) = group[i], group[j]
                if len(u) == m or len(v) == m:  # longer pairs have a group of their own
                    if backward:
                        u, v = u[::-1], v[::-1]
                    out.append((u, v, nu, nv) if u < v else (v, u, nv, nu))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:4] != key:
                    scan()
                    key, group = row[:4], []
                group.append(row[4:])
            yield _pairs(out)
            out = []
        scan()
        yield _pairs(out)

    grouped = (_bounded(_postings(words, min_chars), most).repartition(*GROUP_KEY)
               .sortWithinPartitions(*GROUP_KEY, "w").select(*GROUP_KEY, "w", "n"))
    return grouped.mapInArrow(run, "u string, v string, nu bigint, nv bigint").distinct()


def _pairs(out) -> pa.RecordBatch:
    u, v, nu, nv = zip(*out) if out else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(u, pa.string()), pa.array(v, pa.string()), pa.array(nu, pa.int64()),
                                       pa.array(nv, pa.int64())], names=["u", "v", "nu", "nv"])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the way from form to form, for the words of `forms` (word, form).

    Every step doubles the count at least, so ways have no circles; each round
    doubles the part of a way that is known.
    """
    ways = skew.settle(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = skew.settle(ways.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        ways = joined.drop("moved")
        if joined.filter("moved").isEmpty():
            return ways


def group_variants(words: DataFrame, min_chars: int = MIN_CHARS, ratio: int = RATIO, most: int = GROUP) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n.

    A word's form is the most frequent word one edit away, the first in
    code-point order of equals, if it is `ratio` times as frequent; else null.
    The root is reached by following forms. No words, no rows.
    """
    pairs = skew.settle(near_pairs(words, min_chars, most))
    both = pairs.select(F.col("u").alias("word"), F.col("v").alias("near"), F.col("nv").alias("near_n")).unionByName(
        pairs.select(F.col("v").alias("word"), F.col("u").alias("near"), F.col("nu").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    chosen = skew.settle(words.join(best, "word", "left").withColumn("likely", -F.col("best.less") >= ratio * F.col("n")).select(
        "word", F.when(F.col("likely"), F.col("best.near")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(F.col("likely"), -F.col("best.less")).alias("form_n")))
    ends = roots(chosen.filter("form is not null"))
    return chosen.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
