"""Token corpora, term counts and TF-IDF, one row per (track, token)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.functions import scalars as S
from wakeline.operators import motion
from wakeline.operators.skew import MAX_GROUP_ROWS, TAG, find_large, positions, settle

# Fixed value: words of two or more word characters.
TOKEN_PATTERN = r"\b\w\w+\b"


def tokens(text) -> Column:
    """Array of lower-case tokens of a text."""
    return F.regexp_extract_all(F.lower(S.col(text)), F.lit(TOKEN_PATTERN), F.lit(0))


@dataclass(frozen=True)
class Corpus:
    """`words(pings, large)` -> (id, text) per ping; a track's document is all of its texts."""

    name: str
    words: object


def _plain(text, mask=None):
    def build(pings, large="find"):
        rows = pings if mask is None else pings.filter(mask())
        return rows.select("id", text().alias("text"))
    return build


def _gradients(pings, large="find"):
    moved = pings if "prev" in pings.columns else motion.with_motion(pings, large=large)
    return moved.select("id", motion.gradient_text().alias("text"))


def _sampled(pings, large="find"):
    rows = pings.select("id", "seq", "lat", "lon", *[c for c in pings.columns if c == TAG])
    return sample_rows(rows, large=large).select("id", S.geohash(precision=7).alias("text"))


CORPORA = {c.name: c for c in (
    Corpus("geohash", _plain(lambda: S.geohash(precision=7))),
    Corpus("gradient", _gradients),
    Corpus("sample", _sampled),
    Corpus("place", _plain(lambda: S.place_key(digits=None))),
    Corpus("lat", _plain(lambda: S.float_text("lat"))),
    Corpus("lon", _plain(lambda: S.float_text("lon"))),
    Corpus("slow_geohash", _plain(lambda: S.geohash(precision=7), lambda: S.speed_bin() == "low")),
)}


def sample_rows(pings: DataFrame, fraction: float = 0.1, seed: int = 1,
                limit: int = MAX_GROUP_ROWS, large="find") -> DataFrame:
    """A fixed pseudo-random share of every track: round-half-even(fraction * n) rows."""
    keyed = pings.withColumn("draw", F.md5(F.concat_ws(
        "_", F.col("id").cast("string"), F.col("seq").cast("string"), F.lit(str(seed)))))
    placed = positions(keyed, ["id"], ["draw", "seq"], limit=limit, large=large)
    wanted = F.rint(F.col("group_total").cast("double") * F.lit(fraction))
    return placed.filter(F.col("before") < wanted).select(*pings.columns)


def all_counts(words: DataFrame) -> DataFrame:
    """(id, token, n) from (id, text) rows, counted before the shuffle; a text without tokens counts as a NULL.

    So the documents are the ids of this table. The outer explode keeps Spark
    from adding a non-empty filter that would compute the text a second time.
    """
    return (words.select("id", F.explode_outer(tokens("text")).alias("token"))
            .groupBy("id", "token").agg(F.count(F.lit(1)).alias("n")))


def token_counts(words: DataFrame) -> DataFrame:
    """(id, token, n) from (id, text) rows."""
    return all_counts(words).filter(F.col("token").isNotNull())


def idf_table(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """(token, idf): smooth idf ln((1+N)/(1+df))+1 of a corpus.

    `documents` holds the ids of all its documents, also those without a token.
    """
    size = documents.agg(F.count(F.lit(1))).scalar()
    spread = counts.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log((size + F.lit(1)).cast("double") / (F.col("df") + 1).cast("double")) + F.lit(1.0)
    return spread.select("token", idf.alias("idf"))


def weigh(counts: DataFrame, idf: DataFrame, all_small: bool = False) -> DataFrame:
    """(id, token, n, weight): counts times idf, rows of unit length; tokens without an idf are unknown and left out.

    With `all_small` every document is known to fit one task and a window
    gives the row lengths; otherwise they come from a pre-aggregated sum and a
    join, whose long documents adaptive execution splits.
    """
    raw = counts.join(idf, "token").select("id", "token", "n", (F.col("n") * F.col("idf")).alias("raw"))
    squares = F.sum(F.col("raw") * F.col("raw"))
    if all_small:
        scaled = raw.withColumn("norm", F.sqrt(squares.over(Window.partitionBy("id"))))
    else:
        scaled = raw.join(raw.groupBy("id").agg(F.sqrt(squares).alias("norm")), "id")
    return scaled.select("id", "token", "n", (F.col("raw") / F.col("norm")).alias("weight"))


def tfidf(counts: DataFrame, documents: DataFrame, all_small: bool = False) -> DataFrame:
    """(id, token, n, weight): TF-IDF of a corpus by its own idf."""
    return weigh(counts, idf_table(counts, documents), all_small)


def dictionary(counts: DataFrame, limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """(token, code): the distinct tokens numbered from 0 without gaps, in code-point order.

    Numbers come from ranges of the tokens and the ranges' sizes.
    """
    distinct = counts.filter("token IS NOT NULL").select("token").distinct().withColumn("_all", F.lit(0))
    return positions(distinct, ["_all"], ["token"], limit=limit).select("token", F.col("before").cast("bigint").alias("code"))


def coded(counts: DataFrame, codes: DataFrame) -> DataFrame:
    """(id, token, n) with the tokens' codes in place of the tokens; tokens without a code are left out."""
    return counts.join(codes, "token").select("id", F.col("code").alias("token"), "n")


def corpus_tfidf(pings: DataFrame, corpus: str, limit: int = MAX_GROUP_ROWS, fit_on=None) -> DataFrame:
    """TF-IDF weights of one corpus.

    `fit_on`, a condition on `type`, names the tracks whose documents give the
    idf; all of them if not given. Tokens that those lack are left out.
    """
    large = find_large(pings, ["id"], limit)
    counted = settle(all_counts(CORPORA[corpus].words(pings, large)))
    known = counted if fit_on is None else chosen(counted, pings, fit_on)
    idf = idf_table(known.filter("token IS NOT NULL"), document_ids(known))
    return weigh(counted.filter("token IS NOT NULL"), idf, all_small=large is None)


def chosen(counted: DataFrame, pings: DataFrame, condition) -> DataFrame:
    """The rows of (id, ...) whose track fulfils a condition on its `type`."""
    ids = pings.groupBy("id").agg(F.min_by("type", F.when(F.col("type").isNotNull(), F.col("seq"))).alias("type"))
    return counted.join(ids.filter(condition), "id", "left_semi")


def document_ids(words: DataFrame) -> DataFrame:
    return words.select("id").distinct()


def token_documents(words: DataFrame, order=("ts", "seq"), chunk: int = 1000, ahead: int = 0,
                    limit: int = MAX_GROUP_ROWS, large="find") -> DataFrame:
    """Ordered token lists, cut every `chunk` pings so that no list grows with the track.

    `words` has id, the order columns and text. `ahead` holds the tokens of the
    next `ahead` pings beyond the cut, so that no neighbourhood is lost there.
    """
    if not 0 <= ahead <= chunk:
        raise ValueError("a list can look no further ahead than one chunk")
    placed = (positions(words, ["id"], order, limit=limit, large=large)
              .withColumn("part", F.floor(F.col("before") / F.lit(chunk)).cast("bigint")))
    both = F.array(F.struct("part", F.lit(False).alias("beyond")),
                   F.struct((F.col("part") - 1).alias("part"), F.lit(True).alias("beyond")))
    first = (F.col("before") % chunk < ahead) & (F.col("part") > 0)
    placed = placed.select("id", "before", tokens("text").alias("tok"),
                           F.inline(F.when(first, both).otherwise(F.slice(both, 1, 1))))

    def listed(beyond, name):
        own = F.collect_list(F.when(F.col("beyond") == beyond, F.struct("before", "tok")))
        return F.flatten(F.transform(F.array_sort(own), lambda x: x["tok"])).alias(name)
    return placed.groupBy("id", "part").agg(listed(False, "tokens"), listed(True, "ahead"))
