"""Language identification by unigrams over pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A
word's likelihood is the sum over all ways to cut it into pieces, which a
forward pass over its positions adds up; a text's is the product over its words.
The piece probabilities come from expectation maximisation on labelled words.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.llm.common import Remembered, broadcast_if, chunks, kept_in_worker, words
from wakeline.operators import skew

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"  # stands for the start of a word in the vocabulary
# A character that is no piece by itself; also what an unseen piece gets, as a share of its language's count.
UNKNOWN = 1e-7
# Characters up to which a word's likelihood can't underflow.
SHORT = 40
ROUNDS = 3
# Learning takes at most this many documents per language, those with the smallest hashes of the id.
TRAIN_DOCS = 1000
# Languages times TRAIN_DOCS ids up to which the learning documents are picked by broadcast.
MAX_BROADCAST_IDS = 1_000_000
# Distinct words whose scores a worker remembers, and texts that are scored together.
CACHE_WORDS = 120_000
ROWS = 1500
UNDETERMINED = "und"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def read_pieces(path: str | None = None) -> list[str]:
    """The vocabulary's pieces without control and byte pieces, in code point order."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path or vocabulary_path())
    plain = (model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p for p in plain if p})


_BASE = np.uint64(0x100000001B3)


class Lattice:
    """Finds the pieces inside words of one length, for many words at once."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        codes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], order
        assert len(np.unique(codes)) == len(codes), "two pieces share a hash"
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[codes >> np.uint64(44)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h ^ ord(c)) * 0x9E3779B97F4A7C15 + 0x100000001B3) & 0xFFFFFFFFFFFFFFFF
        return h

    def grids(self, chosen: list[str]):
        """Words of equal length together: (positions in `chosen`, code points as rows)."""
        lengths = np.fromiter(map(len, chosen), dtype=np.int64, count=len(chosen))
        for n in np.unique(lengths).tolist():
            for at in np.array_split(np.flatnonzero(lengths == n), max(1, (lengths == n).sum() * n // 400_000)):
                if len(at):
                    flat = np.frombuffer("".join(chosen[k] for k in at).encode("utf-32-le", "surrogatepass"), np.uint32)
                    yield at, flat.reshape(len(at), n)

    def arcs(self, grid: np.ndarray):
        """(start, end, rows, piece ids) of all pieces inside the words of a grid, by end."""
        n = grid.shape[1]
        live = {}
        for end in range(1, n + 1):
            letter = grid[:, end - 1].astype(np.uint64)
            live[end - 1] = np.zeros(len(grid), np.uint64)
            live.pop(end - 1 - self.longest, None)
            for start in live:
                code = (live[start] ^ letter) * np.uint64(0x9E3779B97F4A7C15) + _BASE
                live[start] = code
                rows = np.flatnonzero(self.maybe[code >> np.uint64(44)])
                if len(rows):
                    at = np.minimum(np.searchsorted(self.codes, code[rows]), len(self.codes) - 1)
                    ok = self.codes[at] == code[rows]
                    if ok.any():
                        yield start, end, rows[ok], self.ids[at[ok]]


@dataclass
class Model:
    """Log-likelihoods of words by language; probabilities[k, l] of piece k in language l."""

    languages: list[str]
    pieces: list[str]
    probabilities: np.ndarray
    priors: np.ndarray

    def word_scores(self, lattice: Lattice, chosen: list[str]) -> np.ndarray:
        """The log of the forward sum over all segmentations, a row per word."""
        out = np.zeros((len(chosen), len(self.languages)))
        for at, grid in lattice.grids(chosen):
            alpha, scale = _forward(lattice, grid, self.probabilities)
            out[at] = np.log(alpha[-1]) + scale[-1][:, None]
        return out


def _forward(lattice: Lattice, grid: np.ndarray, probabilities: np.ndarray):
    """alpha[position, row, language] * exp(scale[position, row]): the sum over segmentations of each prefix.

    Words of more than SHORT characters, whose sums could underflow, are scaled
    by their largest language at each position.
    """
    rows, n = grid.shape
    alpha = np.zeros((n + 1, rows, probabilities.shape[1]))
    scale = np.zeros((n + 1, rows))
    alpha[0] = 1.0
    arcs = {}
    for start, end, r, k in lattice.arcs(grid):
        arcs.setdefault(end, []).append((start, r, k))
    for end in range(1, n + 1):
        alpha[end] = alpha[end - 1] * UNKNOWN
        total = alpha[end]
        for start, r, k in arcs.get(end, ()):
            more = alpha[start, r] * probabilities[k]
            if n > SHORT:
                more *= np.exp(scale[start, r] - scale[end - 1, r])[:, None]
            total[r] += more
        if n > SHORT:
            largest = total.max(axis=1)
            total /= largest[:, None]
            scale[end] = scale[end - 1] + np.log(largest)
    return alpha, scale


def _expected(lattice: Lattice, grid: np.ndarray, probabilities: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Expected piece counts of one language's words (forward and backward sums)."""
    alpha, scale = _forward(lattice, grid, probabilities[:, None])
    alpha, n = alpha[:, :, 0], grid.shape[1]
    beta, back = np.zeros((n + 1, len(grid))), np.zeros((n + 1, len(grid)))
    beta[n] = 1.0
    arcs = list(lattice.arcs(grid))
    by_start = {}
    for start, end, r, k in arcs:
        by_start.setdefault(start, []).append((end, r, k))
    for start in range(n - 1, -1, -1):
        total = beta[start + 1] * UNKNOWN
        for end, r, k in by_start.get(start, ()):
            total[r] += beta[end, r] * probabilities[k] * np.exp(back[end, r] - back[start + 1, r])
        beta[start] = 1.0
        back[start] = back[start + 1] + np.log(total)
    counts = np.zeros(len(probabilities))
    whole = np.log(alpha[n]) + scale[n]
    for start, end, r, k in arcs:
        share = alpha[start, r] * probabilities[k] * beta[end, r] * np.exp(scale[start, r] + back[end, r] - whole[r])
        counts += np.bincount(k, weights=share * weights[r], minlength=len(counts))
    return counts


def learning_rows(docs: DataFrame, held_out: Column, limit: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, lang, text) of at most `limit` documents per language that are not held out."""
    known = docs.filter(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = known.select("doc_id", "lang").withColumn("n", place).filter(F.col("n") <= limit).select(
        F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    return known.join(broadcast_if(picked, MAX_BROADCAST_IDS), F.col("doc_id").eqNullSafe(F.col("_id"))
                      & (F.col("lang") == F.col("_lang")), "left_semi").select("doc_id", "lang", "text")


def learn(docs: DataFrame, held_out: Column, pieces: list[str], limit: int = TRAIN_DOCS, rounds: int = ROUNDS) -> Model | None:
    """The model of all languages in the learning rows; None if there are none.

    Words are counted by Spark; each round's expected counts are summed by
    Spark over (language, piece), so the driver holds one number for each.
    """
    rows = learning_rows(docs, held_out, limit)
    counted = skew.settle(rows.select("lang", F.explode(words(F.col("text"))).alias("word"))
                          .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    sizes = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    probabilities = np.full((len(pieces), len(languages)), 1.0 / max(1, len(pieces)))
    for _ in range(rounds):
        shared = docs.sparkSession.sparkContext.broadcast((languages, pieces, probabilities))

        def expect(batches):
            names, vocabulary, p = shared.value
            lattice, total = Lattice(vocabulary), np.zeros_like(p)
            for batch in batches:
                lang, word, n = (batch.column(i).to_pylist() for i in range(3))
                for at, name in enumerate(names):
                    own = [i for i, x in enumerate(lang) if x == name]
                    chosen, weight = [MARK + word[i] for i in own], np.array([n[i] for i in own], dtype=float)
                    for rows_, grid in lattice.grids(chosen):
                        total[:, at] += _expected(lattice, grid, p[:, at].copy(), weight[rows_])
            k, lang_no = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": pa.array(lang_no, pa.int32()), "piece": pa.array(k, pa.int32()),
                                              "n": pa.array(total[k, lang_no])})
        sums = counted.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        probabilities = np.zeros_like(probabilities)
        for r in sums.collect():  # languages times pieces at most
            probabilities[r["piece"], r["lang"]] = r["n"]
        total = probabilities.sum(axis=0, keepdims=True)
        probabilities = np.maximum(probabilities / np.maximum(total, 1e-300), UNKNOWN)
    return Model(languages, pieces, probabilities, np.log([1 / len(languages)] * len(languages)))


class Scorer:
    """Languages of texts; the scores of frequent words are remembered."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.known, self.table = Remembered(CACHE_WORDS), np.zeros((0, len(model.languages)))

    def __call__(self, texts: pa.Array, lettered: list[bool]):
        stay = self.known.thin()
        if stay is not None:
            self.table = self.table[stay]
        distinct, codes, ends = chunks(texts)
        new = [w for w in distinct if w not in self.known.place]
        if new:
            self.known.add(new)
            scores = self.model.word_scores(self.lattice, [MARK + w for w in new])
            scores[[not w for w in new]] = 0.0  # nothing stands between two blanks
            self.table = np.concatenate([self.table, scores])
        scores = self.table[self.known.numbers(distinct)][codes]
        total = np.add.reduceat(scores, ends[:-1], axis=0) + self.model.priors  # a text has a chunk at least
        best = total.argmax(axis=1)
        share = 1 / np.exp(total - total[np.arange(len(total)), best][:, None]).sum(axis=1)
        return ([self.model.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), lettered)],
                np.where(lettered, share, 0.0))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Adds `lang_pred` and `score` to (doc_id, text): the likeliest language and its share of the likelihood.

    Null texts and texts without a letter are `und` with score 0, and so is
    every text if nothing was learned. Of equally likely languages the first by
    name is taken.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model and (
        model.languages, model.pieces, model.probabilities, model.priors))

    def run(batches):
        scorer = None
        if shared.value:
            key = hashlib.blake2b(shared.value[2].tobytes()).hexdigest()
            kept = kept_in_worker("language scorer", dict)
            if key not in kept:  # the last model only
                kept.clear()
                kept[key] = Scorer(Model(*shared.value))
            scorer = kept[key]
        for batch in batches:
            for start in range(0, len(batch), ROWS):
                rows = batch.slice(start, ROWS)
                texts = pc.fill_null(rows.column(1), "")
                lettered = [any(map(str.isalpha, t)) for t in texts.to_pylist()]
                if scorer is None:
                    names, scores = [UNDETERMINED] * len(rows), [0.0] * len(rows)
                else:
                    names, scores = scorer(texts, lettered)
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                                 names=["doc_id", "lang_pred", "score"])
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        run, "doc_id bigint, lang_pred string, score double")
