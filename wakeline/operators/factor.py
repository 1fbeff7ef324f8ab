"""Dense summaries of token corpora: truncated SVD scores and Word2Vec means."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from wakeline.functions import scalars as S
from wakeline.operators import text
from wakeline.operators.prepared import bucketed
from wakeline.operators.skew import MAX_GROUP_ROWS, TAG, find_large, settle

# MLlib's Word2Vec keeps vocabulary x size floats on the driver; 100 million are 400 MB.
MAX_WORD2VEC_FLOATS = 100_000_000
# Partial triangles that are put together on the driver.
TRIANGLES = 32
# A column that adds less than this share of its length to those before it depends on them,
# and a direction below this share of the first is rounding.
DEPENDENT, RANK = 1e-13, 1e-14
# Cells that a task multiplies at once, and those of one id beyond which it has no block.
BLOCK_CELLS, MAX_ID_CELLS = 100_000, 200_000


def _triangle(df: DataFrame, cols) -> np.ndarray:
    """R of the QR decomposition of the rows: QR by partition, of those results if they are many, and of these on the driver."""
    schema = ", ".join(f"`{c}` double" for c in cols)

    def reduce_rows(batches):
        r = np.zeros((0, len(cols)))
        for b in batches:
            r = np.linalg.qr(np.vstack([r, b[list(cols)].to_numpy()]), mode="r")
        yield pd.DataFrame(r, columns=list(cols))

    parts = df.select(*cols).mapInPandas(reduce_rows, schema)
    if df.rdd.getNumPartitions() > TRIANGLES:
        parts = parts.repartition(TRIANGLES).mapInPandas(reduce_rows, schema)
    rows = [list(r) for r in parts.collect()]  # TRIANGLES x len(cols) rows at most
    return np.linalg.qr(np.array(rows), mode="r") if rows else np.zeros((0, len(cols)))


def _rotate(df: DataFrame, key: str, cols, matrix: np.ndarray, names) -> DataFrame:
    """Multiply the row vectors in `cols` by a small matrix."""
    schema = ", ".join([f"{key} {dict(df.dtypes)[key]}", *[f"`{n}` double" for n in names]])

    def apply(batches):
        for b in batches:
            out = dict(zip(names, (b[cols].to_numpy() @ matrix).T))
            yield b[[key]].assign(**out)

    return df.select(key, *cols).mapInPandas(apply, schema)


def _independent(r: np.ndarray) -> np.ndarray:
    """For R of some columns: the matrix that makes them orthonormal.

    Columns are compared with their own length, so short ones count as long
    ones do; those that depend on the ones before to double precision go.
    """
    keep = np.zeros(r.shape[1], bool)
    keep[:len(r)] = np.abs(np.diagonal(r)) > DEPENDENT * np.maximum(np.linalg.norm(r, axis=0)[:len(r)], 1e-300)
    inverse = np.zeros((r.shape[1], keep.sum()))
    if keep.any():
        small = np.linalg.qr(r[:, keep], mode="r")
        length = np.linalg.norm(small, axis=0)
        inverse[keep] = np.linalg.inv(small / length) / length[:, None]
    return inverse


def _block_products(cols, key: str, again: bool):
    """Cells and vectors of a block -> sums of weight * vector by id, or with `again` those taken back to the tokens."""
    def run(cells: pa.Table, vectors: pa.Table) -> pa.Table:
        known = vectors["token"].combine_chunks()
        at = pc.index_in(cells["token"], value_set=known)
        cells, at = cells.filter(pc.is_valid(at)), at.drop_null().to_numpy()
        ids = cells["id"].combine_chunks().dictionary_encode()
        row, weight = ids.indices.to_numpy(), cells["weight"].to_numpy()
        out = [known if again else ids.dictionary]
        for c in cols:
            sums = np.bincount(row, weight * vectors[c].to_numpy()[at], len(ids.dictionary))
            out.append(pa.array(np.bincount(at, weight * sums[row], len(known)) if again else sums))
        return pa.table(out, [key, *cols])
    return run


@dataclass(frozen=True)
class PlacedCells:
    """The cells (id, token, weight) in blocks of whole ids, written bucketed by block.

    A product with token vectors sends each block the vectors of its tokens,
    once each however many cells they have, and takes back a sum for each; it
    moves no cells and no vectors of ids in between. The cells of ids that are too
    long for a block are bucketed by token; such ids are few, so their sums are
    broadcast to them, and a token has no more cells there than there are such ids.
    """

    rows: DataFrame
    tokens: DataFrame
    long: DataFrame | None

    @staticmethod
    def of(cells: DataFrame, block_cells: int = BLOCK_CELLS, limit: int = MAX_ID_CELLS) -> PlacedCells:
        """`cells` is a written table."""
        buckets = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        large = find_large(cells, ["id"], limit)
        few = cells if large is None else large.without(cells)
        blocks = math.ceil(cells.count() / block_cells) or 1
        placed = few.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
        rows = bucketed(placed.repartition(buckets, "block"), buckets, "block")
        tokens = bucketed(rows.select("token", "block").distinct().repartition(buckets, "token"), buckets, "token")
        return PlacedCells(rows, tokens, None if large is None else bucketed(
            large.only(cells).repartition(buckets, "token"), buckets, "token"))

    def _in_blocks(self, vectors: DataFrame, cols, again: bool) -> DataFrame:
        key = "token" if again else "id"
        schema = ", ".join([f"{key} {dict(self.rows.dtypes)[key]}", *[f"`{c}` double" for c in cols]])
        needed = self.tokens.join(vectors, "token").select("block", "token", *cols)
        return self.rows.groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(
            _block_products(list(cols), key, again), schema)

    def _of_long(self, vectors: DataFrame, cols) -> DataFrame:
        return _weighted(self.long.join(vectors, "token"), "id", cols)

    def by_id(self, vectors: DataFrame, cols) -> DataFrame:
        """(id, cols): the vectors (token, cols) times the weights, summed by id."""
        short = self._in_blocks(vectors, cols, False)
        return short if self.long is None else short.unionByName(self._of_long(vectors, cols))

    def by_token(self, vectors: DataFrame, cols) -> DataFrame:
        """(token, cols): these sums times the weights again, summed by token."""
        parts = self._in_blocks(vectors, cols, True)
        if self.long is not None:
            parts = parts.unionByName(_weighted(
                self.long.join(F.broadcast(self._of_long(vectors, cols)), "id"), "token", cols))
        return parts.groupBy("token").agg(*[F.sum(c).alias(c) for c in cols])


def _weighted(joined: DataFrame, key: str, cols) -> DataFrame:
    return joined.groupBy(key).agg(*[F.expr(f"sum(weight * {c})").alias(c) for c in cols])


@dataclass(frozen=True)
class SvdModel:
    """The leading right singular vectors as a table (token, r0, r1, ...); directions beyond the rank are not there."""

    vectors: DataFrame | None
    names: list
    k: int

    def scores(self, cells: DataFrame | PlacedCells, documents: DataFrame, prefix: str) -> DataFrame:
        """(id, <prefix>_0, ...): the rows of a matrix (id, token, weight) in these directions.

        Documents without a known token and directions beyond the rank score 0.
        """
        names = [f"{prefix}_{i}" for i in range(self.k)]
        if self.vectors is None:
            return documents.selectExpr("id", *[f"0D AS {n}" for n in names])
        if not isinstance(cells, PlacedCells):
            cells = PlacedCells.of(settle(cells.select("id", "token", "weight")))
        projected = cells.by_id(self.vectors, self.names)
        return documents.join(projected, "id", "left").selectExpr("id", *[
            f"coalesce({self.names[i]}, 0D) AS {n}" if i < len(self.names) else f"0D AS {n}" for i, n in enumerate(names)])


def fit_svd(cells: DataFrame, k: int, iterations: int = 20, oversample: int = 10, seed: int = 1,
            tolerance: float = 1e-9) -> tuple[SvdModel, DataFrame | PlacedCells]:
    """The k leading singular directions of a sparse matrix (id, token, weight), and its cells placed in blocks.

    Block power iteration on the table itself: a step multiplies by the matrix
    and back, block by block of its rows (see PlacedCells), and only
    (k + oversample)^2 numbers reach the driver, so neither the vocabulary nor a
    long document has to fit in one place. Stops early once the leading values have settled, or once the block
    holds all directions that there are. In each direction the largest score in
    size of these rows is positive.
    """
    width = k + oversample
    cells = settle(cells.select("id", "token", "weight"))
    names = [f"v{i}" for i in range(width)]
    if cells.isEmpty():
        return SvdModel(None, [], k), cells
    placed = PlacedCells.of(cells)
    half = float(2 ** 63)
    basis = cells.select("token").distinct().selectExpr("token", *[
        f"xxhash64(token, {seed * width + i}) / {half}D AS {n}" for i, n in enumerate(names)])
    cols, settled = names, None
    for step in range(iterations):
        image = settle(placed.by_token(basis, cols))
        triangle = _triangle(image, cols)
        inverse = _independent(triangle)
        used = names[:inverse.shape[1]]
        if not used:
            return SvdModel(None, [], k), placed
        basis, cols = _rotate(image, "token", cols, inverse, used), used
        lead = np.sqrt(np.linalg.svd(triangle, compute_uv=False)[:k])
        if len(used) < width and step > 0:  # no direction is left that the block could turn to
            break
        if step > 1 and len(settled) == len(lead) and np.all(np.abs(lead - settled) <= tolerance * lead[0]):
            break
        settled = lead
    # Once more: the first result is not orthogonal to the last digit.
    inverse = _independent(_triangle(basis, cols))
    basis, cols = _rotate(basis, "token", cols, inverse, names[:inverse.shape[1]]), names[:inverse.shape[1]]

    projected = settle(placed.by_id(basis, cols))
    _, values, turned = np.linalg.svd(_triangle(projected, cols))
    found = [f"r{i}" for i in range(min(k, int((values > values[0] * RANK).sum())))]
    turn = turned.T[:, :len(found)]
    # The sign of each direction comes from its largest score (smallest id first).
    leads = _rotate(projected, "id", cols, turn, found).agg(
        *[F.expr(f"min_by({c}, struct(-abs({c}), id))").alias(c) for c in found]).first()
    turn = turn * np.array([-1.0 if leads[c] < 0 else 1.0 for c in found])
    return SvdModel(settle(_rotate(basis, "token", cols, turn, found)), found, k), placed


def truncated_svd(cells: DataFrame, documents: DataFrame, k: int, prefix: str,
                  iterations: int = 20, seed: int = 1) -> DataFrame:
    """Scores U*S of the k leading singular directions, one row per document (see fit_svd)."""
    model, placed = fit_svd(cells, k, iterations, seed=seed)
    return model.scores(placed, documents, prefix)


@dataclass(frozen=True)
class CorpusModel:
    """What is learned from a corpus: its dictionary, the idf of each code, and the directions."""

    codes: DataFrame
    idf: DataFrame | None
    svd: SvdModel

    def cells(self, counted: DataFrame, all_small: bool) -> DataFrame:
        return _cells(text.coded(counted.filter("token IS NOT NULL"), self.codes), self.idf, all_small)


def _cells(counts: DataFrame, idf: DataFrame | None, all_small: bool) -> DataFrame:
    """Weights by an idf, or the counts themselves."""
    if idf is None:
        return counts.select("id", "token", F.col("n").cast("double").alias("weight"))
    return text.weigh(counts, idf, all_small)


def fit_corpus(counted: DataFrame, k: int, weighting: str, iterations: int = 20, seed: int = 1,
               all_small: bool = False) -> tuple[CorpusModel, DataFrame | PlacedCells]:
    """A model of a corpus (see text.all_counts), and the corpus' own cells; weighting is 'tfidf' or 'count'."""
    if weighting not in ("tfidf", "count"):
        raise ValueError(f"unknown weighting {weighting!r}")
    codes = settle(text.dictionary(counted))
    counts = text.coded(counted.filter("token IS NOT NULL"), codes)
    idf = settle(text.idf_table(counts, text.document_ids(counted))) if weighting == "tfidf" else None
    svd, placed = fit_svd(_cells(counts, idf, all_small), k, iterations, seed=seed)
    return CorpusModel(codes, idf, svd), placed


def svd_features(pings: DataFrame, corpus: str, k: int, blocks, iterations: int = 20,
                 seed: int = 1, limit: int = MAX_GROUP_ROWS, large="find", fit_on=None) -> DataFrame:
    """SVD scores of one corpus (see text.CORPORA).

    `blocks` maps a column prefix to its weighting, 'tfidf' or 'count'; the
    corpus is tokenised and counted once for all of them. All tracks in `pings`
    are scored, unlabelled ones included. They are all fitted too, but with
    `fit_on`, a condition on `type`, only those that fulfil it: idf and
    directions are then theirs, and tokens that they lack count nothing.
    """
    if large == "find":
        large = find_large(pings, ["id"], limit)
    counted = settle(text.all_counts(text.CORPORA[corpus].words(pings, large)))
    documents = text.document_ids(counted)
    out = documents
    for prefix, weighting in blocks.items():
        known = counted if fit_on is None else settle(text.chosen(counted, pings, fit_on))
        model, cells = fit_corpus(known, k, weighting, iterations, seed, all_small=large is None)
        if fit_on is not None:
            cells = model.cells(counted, all_small=large is None)
        out = out.join(model.svd.scores(cells, documents, prefix), "id", "left")
    return out


def word2vec_means(pings: DataFrame, size: int = 30, window: int = 5, iterations: int = 10,
                   seed: int = 1, prefix: str = "w2v", chunk: int = 1000,
                   limit: int = MAX_GROUP_ROWS, large="find") -> DataFrame:
    """Mean word vector of each track's geohash cells, repeated cells counted each time.

    Skip-gram implicitly factorises the pointwise mutual information of cell
    and context; here that table is built and factorised directly, at every
    size, and neither the vocabulary nor the number of partitions matters.
    """
    tag = [TAG] if TAG in pings.columns else []
    words = pings.select("id", "ts", "seq", *tag, S.geohash(precision=7).alias("text"))
    sentences = settle(text.token_documents(words, chunk=chunk, ahead=window, limit=limit, large=large))
    scores = truncated_svd(context_weights(sentences, window).selectExpr("token AS id", "context AS token", "weight"),
                           sentences.selectExpr("explode(tokens) AS id").distinct(), size, "v", iterations, seed=seed)
    vectors = scores.select(F.col("id").alias("token"), F.array(*[f"v_{i}" for i in range(size)]).alias("v"))
    return mean_vectors(text.token_counts(words), vectors, size, prefix)


def skipgram_means(pings: DataFrame, size: int = 30, window: int = 5, iterations: int = 10,
                   seed: int = 1, prefix: str = "w2v", limit: int = MAX_GROUP_ROWS,
                   max_floats: int = MAX_WORD2VEC_FLOATS) -> DataFrame:
    """The same from MLlib's skip-gram trainer, for vocabularies that fit the driver.

    It trains in one partition on sentences in a fixed order, so that the
    vectors are the same on any cluster, and refuses a vocabulary of more than
    max_floats / size cells. The trainer itself cuts sentences at 1,000 tokens.
    """
    words = pings.select("id", "ts", "seq", S.geohash(precision=7).alias("text"))
    counts = text.token_counts(words)
    if counts.select("token").distinct().count() * size > max_floats:
        raise ValueError("the vocabulary is too large for the driver; use word2vec_means")
    sentences = settle(text.token_documents(words, limit=limit).coalesce(1).sortWithinPartitions("id", "part"))
    model = Word2Vec(vectorSize=size, windowSize=window, minCount=1, maxIter=iterations, seed=seed, numPartitions=1,
                     maxSentenceLength=1000, inputCol="tokens", outputCol="v").fit(sentences.coalesce(1))
    vectors = model.getVectors().select(F.col("word").alias("token"), vector_to_array("vector").alias("v"))
    return mean_vectors(counts, vectors, size, prefix)


def context_weights(sentences: DataFrame, window: int = 5, shift: float = 1.0) -> DataFrame:
    """(token, context, weight): positive pointwise mutual information, less log(shift).

    A context is a token at most `window` places away; `sentences` has tokens
    and `ahead`, the tokens that follow its cut.
    """
    pairs = ", ".join(
        f"filter(zip_with(tokens, slice(concat(tokens, ahead), {d + 1}, size(tokens)), (a, b) -> struct(a, b)), "
        "x -> x.a IS NOT NULL AND x.b IS NOT NULL)" for d in range(1, window + 1))
    ahead = (sentences.selectExpr(f"inline(flatten(array({pairs}))) AS (token, context)")
             .groupBy("token", "context").agg(F.count(F.lit(1)).alias("n")))
    both = settle(ahead.unionByName(ahead.selectExpr("context AS token", "token AS context", "n"))
                  .groupBy("token", "context").agg(F.sum("n").alias("n")))
    totals = both.groupBy("token").agg(F.sum("n").alias("total"))
    everything = both.agg(F.sum("n")).scalar()
    ratio = (F.col("n").cast("double") * everything.cast("double")
             / (F.col("total").cast("double") * F.col("context_total").cast("double")))
    return (both.join(totals, "token")
            .join(totals.withColumnsRenamed({"token": "context", "total": "context_total"}), "context")
            .select("token", "context", (F.log(ratio) - F.log(F.lit(float(shift)))).alias("weight"))
            .filter("weight > 0"))


def mean_vectors(counts: DataFrame, vectors: DataFrame, size: int, prefix: str) -> DataFrame:
    """Mean of the token vectors (token, v) of each track, weighted by the token counts."""
    return (counts.join(vectors, "token").groupBy("id")
            .agg(*[F.expr(f"sum(n * v[{i}]) / sum(n)").alias(f"{prefix}_{i}_mean") for i in range(size)]))
