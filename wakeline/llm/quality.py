"""Quality rules: repetition rules and a hashed n-gram likelihood ratio, in SQL functions only.

Words and word pairs are hashed into buckets. One pass over all documents counts
the buckets of the raw corpus and of the trusted documents, and each bucket gets
the log ratio of the two multinomials. Both counts are shrunk towards each
other, so a bucket says something only where the corpus has enough of it,
whatever the corpus' size. A document's score adds up the log ratios beyond a
margin, which few n-grams of ordinary text reach, and is divided by the root of
their number. So a few words that trusted text avoids show in a long text, and
length alone does not. The threshold comes from trusted documents that were not
counted: a fixed small share of them would be lost. Every document gets the same
rules and thresholds.
"""

from __future__ import annotations

import math
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wakeline.llm.common import broadcast_if, let, parts, words
from wakeline.operators.skew import settle

# Buckets of words and of word pairs. Rare n-grams share buckets, in a large corpus
# many of them, but by their counts those say little beside a frequent one.
WORD_BUCKETS, PAIR_BUCKETS = 1 << 18, 1 << 14
BUCKETS = WORD_BUCKETS + PAIR_BUCKETS
WINDOW = 5
# N-grams that each bucket's trusted and expected counts get on top.
PRIOR = 1.5
# Nats by which an n-gram must be rarer in trusted text to count.
MARGIN = 1.0
# Log ratios are kept in steps of 1 / STEPS, down to -127 of them: a byte for each bucket.
STEPS = 10
# One in HELD of the trusted documents is held out, of which the share LOST may fail.
HELD, LOST = 4, 0.005
# The threshold lies so much further from 0 than the score of that share: few held-out
# documents show their own extremes, not those of all others.
SLACK = 1.25
SYMBOL = "[#*$%&|<>]"
# Keys of eight bytes up to this number are joined by broadcast; more by a shuffle.
MAX_BROADCAST_KEYS = 1_000_000


def _hashes(array: Column) -> Column:
    return F.transform(array, lambda w: F.xxhash64(w))


def _pairs(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))


def _part(array: Column, start: int, short: int) -> Column:
    """The elements from `start` (1-based) on, `short` fewer than the array has."""
    return F.slice(array, F.lit(start), F.greatest(F.size(array) - short, F.lit(0)))


def _twos(hashes: Column) -> Column:
    """A 64-bit hash of each pair of neighbouring words."""
    return F.transform(_part(hashes, 1, 1), lambda h, i: F.xxhash64(h, hashes[i + 1]))


def _word_bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(WORD_BUCKETS - 1))


def _pair_bucket(h: Column) -> Column:
    """The bucket of a pair, counted from 0; those of words come before."""
    return h.bitwiseAND(F.lit(PAIR_BUCKETS - 1))


def _buckets(hashes: Column) -> Column:
    """The buckets of all words, then of all word pairs."""
    return F.concat(F.transform(hashes, lambda h: _word_bucket(h).cast("int")), F.transform(
        _part(hashes, 1, 1), lambda h, i: (_pair_bucket(F.xxhash64(h, hashes[i + 1])) + WORD_BUCKETS).cast("int")))


def _windows(hashes: Column, twos: Column) -> Column:
    """A 64-bit hash of each run of five words: pairs of pairs, and the fifth word."""
    return _pairs(_pairs(_part(twos, 1, 2), _part(twos, 3, 2)), _part(hashes, WINDOW, WINDOW - 1))


def _covered(windows: Column) -> Column:
    """The number of words in windows that occur twice or more: sort, keep equal neighbours, add up."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s):
        twins = F.zip_with(_part(s, 1, 1), _part(s, 2, 1), lambda a, b: F.when(
            a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.flatten(F.filter(twins, lambda t: t.isNotNull())))

    def total(p):
        after = _part(p, 2, 1)
        return F.aggregate(F.zip_with(p, after, lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
                           F.lit(0), lambda x, y: x + y)
    return let(let(placed, starts), total)


def repeated_words(hashes: Column, twos: Column) -> Column:
    """Words inside a five-word window that the text has twice or more, the first included."""
    def count(windows):
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(_covered(windows))
    return F.when(F.size(hashes) <= WINDOW, 0).otherwise(let(_windows(hashes, twos), count))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, held): all good and harmless documents, and which of them are held out."""
    judged = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return judged.filter((F.col("q") == 1) & (F.coalesce("t", F.lit(0)) == 0)).select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string")) % HELD == 0).alias("held"))


def log_ratios(docs: DataFrame, trusted: DataFrame) -> bytes | None:
    """For each bucket how many steps below 0 its n-grams take a score; None without trusted text.

    `trusted` is a written table of trusted_ids, small or not.
    """
    marked = docs.select("doc_id", "text").join(
        broadcast_if(trusted.filter("NOT held").select("doc_id", F.lit(1).alias("_counts")), MAX_BROADCAST_KEYS), "doc_id", "left")
    grams = marked.select("_counts", F.explode(let(_hashes(words(F.col("text"))), _buckets)).alias("bucket"))
    counts = settle(grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("_counts").alias("good")))
    n_raw, n_good = counts.agg(F.sum("raw"), F.sum("good")).first()
    if not n_good:
        return None
    expected = F.col("raw") * (n_good / n_raw)
    beyond = -F.log((F.col("good") + PRIOR) / (expected + PRIOR)) - MARGIN
    steps = F.least(F.round(F.greatest(beyond, F.lit(0.0)) * STEPS), F.lit(127.0)).cast("int")
    table = bytearray(BUCKETS)
    for bucket, n in counts.select("bucket", steps.alias("n")).filter("n > 0").collect():  # BUCKETS rows at most
        table[bucket] = n
    return bytes(table)


def _with_steps(docs: DataFrame, ratios: bytes | None) -> tuple[DataFrame, list[str]]:
    """`docs` with the steps of words and of pairs as two columns, and their names; none without a model.

    They are read from written tables by scalar queries: as literals they would
    stand in every plan, and in what the driver keeps of it, many times over.
    """
    names = []
    for steps in (ratios[:WORD_BUCKETS], ratios[WORD_BUCKETS:]) if ratios else ():
        row = pa.table({"steps": pa.array([list(steps)], pa.list_(pa.int8()))})
        table = settle(docs.sparkSession.createDataFrame(row))
        names.append(f"_steps_{uuid.uuid4().hex}")
        docs = docs.withColumn(names[-1], table.scalar())
    return docs, names


def score(hashes: Column, twos: Column, steps: list[str]) -> Column:
    """The sum of the log ratios beyond the margin over the root of the number of n-grams, rounded.

    0 for a text without words or without a model. `steps` are the columns of _with_steps.
    Each is named once, so Spark puts its query in its place and no row carries it.
    """
    if not steps:
        return F.lit(0.0)

    def total(array, bucket, name):
        return F.aggregate(array, F.lit(0), lambda s, h: s + F.col(name)[bucket(h)])
    total_steps = total(hashes, _word_bucket, steps[0]) + total(twos, _pair_bucket, steps[1])
    return F.round(F.when(F.size(hashes) == 0, 0.0).otherwise(
        total_steps / (-STEPS * F.sqrt((2 * F.size(hashes) - 1).cast("double")))), 3)


def threshold(docs: DataFrame, trusted: DataFrame, ratios: bytes | None) -> float:
    """SLACK times the score below which the share LOST of the held-out trusted documents falls; minus infinity without any.

    Scores have three places, so their distinct values are few at every size.
    """
    held = broadcast_if(trusted.filter("held").select("doc_id"), MAX_BROADCAST_KEYS)
    texts, steps = _with_steps(docs.select("doc_id", "text").join(held, "doc_id", "left_semi"), ratios)
    scores = texts.select(let(_hashes(words(F.col("text"))), lambda h: let(_twos(h), lambda t: score(h, t, steps))).alias("score"))
    at = scores.agg(F.expr(f"percentile_disc({LOST}) WITHIN GROUP (ORDER BY score)")).first()[0]
    return -math.inf if at is None else SLACK * at


def rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds `_quality`, a struct of the base counts, the score and the verdict, to every row.

    `docs` needs doc_id and text, `labels` doc_id, quality and toxic; other
    columns are carried along, but for one of that name. A null or empty text has no words and fails the
    base rules. Without a trusted document the base rules decide alone.
    """
    trusted = settle(trusted_ids(labels))
    ratios = log_ratios(docs, trusted)
    least = threshold(docs, trusted, ratios)
    given, steps = _with_steps(docs, ratios)
    text = F.coalesce(F.col("text"), F.lit(""))
    filled = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    dups = let(filled, lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))
    measured = let(parts(text), lambda p: let(_hashes(F.array_remove(p, "")), lambda h: let(_twos(h), lambda twos: F.struct(
        F.size(h).cast("bigint").alias("n_words"),
        (F.length(text) - F.size(p) + 1).cast("bigint").alias("word_chars"),
        (F.size(F.split(text, SYMBOL, -1)) - 1).cast("bigint").alias("n_symbols"),
        dups.cast("bigint").alias("n_dup_lines"), repeated_words(h, twos).cast("bigint").alias("n_repeat_words"),
        score(h, twos, steps).alias("score")))))

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")

    def judged(m):  # one expression, so a filter on the verdict that Spark moves below measures a text once
        failed = (m["n_words"] < 10) | (m["n_repeat_words"] * 100 > m["n_words"] * 20)
        return F.struct(*[m[n].alias(n) for n in names], failed.alias("base_failed"),
                        (~failed & (m["score"] >= least)).alias("kept"))
    return given.withColumn("_quality", let(measured, judged)).drop(*steps)
