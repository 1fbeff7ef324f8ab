"""Token ids of documents in a compressed block file format, and back.

A token table is a Parquet folder of blocks. Documents are ordered by doc_id and
cut into ranges; a range's documents follow each other in blocks of whole
documents, coded by `coder`, each block with its checksum and on its own. A
block row lists its documents and their lengths, so that positions in the whole
id sequence follow from the lengths alone and blocks can be read in any order.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wakeline.llm.coder import decode, encode
from wakeline.llm.common import buffer, give_back, kept_in_worker

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
BLOCK_IDS = 1 << 20
# Distinct pieces of text whose ids a task remembers.
CACHE_PIECES = 400_000
# Pieces put together in one text, and texts that are encoded together.
TOGETHER = 2000
ROWS = 2000
# New pieces that are encoded at once: the library's results take some hundred bytes an id.
NEW_PIECES = 10 * TOGETHER
BLOCK_SCHEMA = ("part int, block int, n_ids bigint, doc_ids array<bigint>, lengths array<bigint>, data binary")
# What a tokenizer does first if its texts may be cut between a letter and a sign, and A-Z lower-cased.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
         "behavior": "Removed", "invert": True}
# Bytes by kind: blanks, ASCII signs, A-Z, and the rest.
BLANK, SIGN, UPPER = 1, 2, 3
KINDS = np.array([BLANK if c in b" \n\t" else UPPER if 65 <= c <= 90 else SIGN if 32 < c < 127 and not chr(c).isalnum() else 0
                  for c in range(256)], np.uint8)
ASCII_LETTER = np.array([c < 128 and chr(c).isalpha() for c in range(256)])
# The second bytes of the letters U+00C0 to U+00FF, whose first one is C3.
LATIN_LETTER = np.array([128 <= c < 192 and c not in (0x97, 0xB7) for c in range(256)])
WORD = "^[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+$"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] to starts[0] + lengths[0] - 1, then those of the next, and so on."""
    after = np.cumsum(lengths)
    found = np.repeat(starts - after + lengths, lengths)
    found += np.arange(len(found))
    return found


def _groups(values: np.ndarray) -> list[np.ndarray]:
    return [values[i:i + TOGETHER] for i in range(0, len(values), TOGETHER)]


def _joined(pieces: pa.Array) -> list[str]:
    """Texts of TOGETHER pieces each, put together with blanks."""
    bounds = np.append(np.arange(0, len(pieces), TOGETHER), len(pieces)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(bounds, pieces), pa.scalar(" ", pieces.type)).to_pylist()


class Pieces:
    """Numbers for pieces that come again and again, like `Remembered`, from arrays of strings."""

    def __init__(self, most: int):
        self.most, self.strings, self.met = most, pa.array([], pa.large_string()), np.zeros(0, np.int64)

    def thin(self) -> np.ndarray | None:
        """If there are too many: which of the old numbers stay, renumbered in their order."""
        if len(self.met) <= self.most:
            return None
        stay = self.met >= 2
        if stay.sum() > self.most // 2:
            stay[:] = False
        self.strings, self.met = self.strings.filter(pa.array(stay)), np.zeros(stay.sum(), np.int64)
        return stay

    def add(self, new: pa.Array) -> None:
        self.strings = pa.concat_arrays([self.strings, new])
        self.met = np.concatenate([self.met, np.zeros(len(new), np.int64)])

    def numbers(self, distinct: pa.Array) -> np.ndarray:
        """-1 for a piece that is not remembered."""
        return pc.fill_null(pc.index_in(distinct, self.strings), -1).to_numpy().copy()


class TextEncoder:
    """The ids of texts, by the tokenizers library.

    `parted` is for tokenizers that drop white space and let no token span it:
    such a text is the sequence of its pieces between blanks. Each distinct
    piece is encoded once; new ones are put together in longer texts.

    Where the tokenizer's first steps are NORMALIZERS and SPLIT (`fine`), fewer
    pieces are distinct: a sign after a letter always begins a new match of the
    split, so texts are cut there too, and A-Z can be lower-cased beforehand.
    """

    def __init__(self, path: str, parted: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core
        from tokenizers import Tokenizer
        self.tokenizer, self.parted = Tokenizer.from_file(path), parted
        self.alphabet = self.tokenizer.get_vocab_size()
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        first = [(settings[x] or {}).get(f"{x}s".replace("_", ""), []) for x in ("normalizer", "pre_tokenizer")]
        self.added = [t["content"].lower().encode() for t in settings["added_tokens"]]
        self.fine = first == [NORMALIZERS, [SPLIT, *first[1][1:]]] and not any(t["normalized"] for t in settings["added_tokens"])
        # Where a word is one match of the split, its last id, and no other, has the suffix of word ends.
        suffix = settings["model"].get("end_of_word_suffix")
        self.closing = np.zeros(self.alphabet, bool)
        if suffix:
            self.closing[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.known, self.flat = Pieces(CACHE_PIECES), np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The distinct pieces, the number of each piece in that list, and where each text's pieces begin and the last one's end."""
        data, ends = buffer(texts)
        kinds, begins = KINDS[data], np.zeros(len(data) + 1, bool)
        filled = kinds != BLANK
        begins[0] = True
        begins[1:] = ~np.append(filled, True)[:-1]
        begins[ends] = True
        low = data.tobytes().lower() if self.fine else b""
        if self.fine and not any(token in low for token in self.added):
            at = np.flatnonzero(kinds == SIGN)
            before, further = data[at - 1], data[at - 2]
            begins[at[ASCII_LETTER[before] | LATIN_LETTER[before] & (further == 0xC3)]] = True
            # A letter before a character from U+0300 on may be composed with it.
            at = np.flatnonzero(kinds == UPPER)
            data = data.copy()
            data[at[np.append(data, 0)[at + 1] < 0xCC]] |= 32
        begins = begins[:-1] & filled
        packed = np.ascontiguousarray(data[filled])
        offsets = np.append(np.flatnonzero(begins[filled]), len(packed))
        pieces = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(packed)).dictionary_encode()
        cuts = np.searchsorted(np.flatnonzero(begins), np.append(0, ends))
        return pieces.dictionary, pieces.indices.to_numpy(), cuts

    def _encoded(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after another, and how many each one has, from the ids' offsets."""
        ids, lengths = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for e, sizes in zip(self.tokenizer.encode_batch(_joined(new), add_special_tokens=False),
                            _groups(pc.utf8_length(new).to_numpy())):
            at = np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0]
            ids.append(np.array(e.ids, np.int32))
            lengths.append(np.bincount(np.searchsorted(np.cumsum(sizes + 1), at, side="right"), minlength=len(sizes)))
        return np.concatenate(ids), np.concatenate(lengths)

    def _encoded_words(self, new: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of pieces that are one match of the split each, from the ids that end a word."""
        ids = np.concatenate([np.zeros(0, np.int32)] + [
            np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(_joined(new), add_special_tokens=False)])
        lengths = np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)
        return (ids, lengths) if len(lengths) == len(new) else self._encoded(new)

    def _learn(self, new: pa.Array):
        words = pc.match_substring_regex(new, WORD).to_numpy(zero_copy_only=False) if self.fine else np.zeros(len(new), bool)
        starts, lengths = np.zeros((2, len(new)), np.int64)
        for some, encoded in ((words, self._encoded_words), (~words, self._encoded)):
            some = np.flatnonzero(some)
            parts = []
            for at in (some[i:i + NEW_PIECES] for i in range(0, len(some), NEW_PIECES)):
                ids, lengths[at] = encoded(new.take(pa.array(at)))
                parts.append(ids)
            n = lengths[some]
            starts[some] = len(self.flat) + np.cumsum(n) - n
            self.flat = np.concatenate([self.flat, *parts])
        self.known.add(new)
        self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of a string array without nulls."""
        if not self.parted:
            return [np.array(e.ids, np.int64) for e in self.tokenizer.encode_batch_fast(
                texts.to_pylist(), add_special_tokens=False)]
        stay = self.known.thin()
        if stay is not None:
            n = self.lengths[stay]
            self.flat = self.flat[_spans(self.starts[stay], n)]
            self.lengths, self.starts = n, np.cumsum(n) - n
        distinct, codes, ends = self._cut(texts)
        at = self.known.numbers(distinct)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.starts) + np.arange(len(new))
            self._learn(distinct.take(pa.array(new)))
        self.known.met[at] += 1
        at = at[codes]
        n = self.lengths[at]
        ids, after = self.flat[_spans(self.starts[at], n)], np.cumsum(n)
        cuts = np.concatenate([[0], after])[ends]
        return [ids[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def blocks(docs: DataFrame, path: str, parted: bool = True, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The block rows of (doc_id, text), each document followed by end_id.

    Documents are in ascending order of doc_id, null first; rows of one doc_id
    in the order of their texts. A null or empty text is end_id alone. A block
    holds whole documents and is closed at `block_ids` ids, so it has as many
    more as its last document. Other columns are left out.
    """
    def run(batches):
        encoder = kept_in_worker(("encoder", path, parted), lambda: TextEncoder(path, parted))
        part, number = 0, 0
        ids, doc_ids, size = [], [], 0

        def close():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()),
                 pa.array([doc_ids], pa.list_(pa.int64())), pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
                 pa.array([encode(np.concatenate(ids), encoder.alphabet)], pa.binary())],
                names=["part", "block", "n_ids", "doc_ids", "lengths", "data"])

        for batch in batches:
            part = batch.column(0)[0].as_py() if len(batch) else part
            for start in range(0, len(batch), ROWS):
                rows = batch.slice(start, ROWS)
                texts = pc.fill_null(rows.column(2), "")
                for name, x in zip(rows.column(1).to_pylist(), encoder(texts)):
                    ids.append(np.append(x, end_id))
                    doc_ids.append(name)
                    size += len(ids[-1])
                    if size >= block_ids:
                        yield close()
                        ids, doc_ids, size, number = [], [], 0, number + 1
        if ids:
            yield close()
        ids = []
        give_back()

    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return ordered.select(F.spark_partition_id().alias("part"), "doc_id", "text").mapInArrow(run, BLOCK_SCHEMA)


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, **settings) -> None:
    """Write the token table of (doc_id, text) with the tokenizer at `path`."""
    blocks(docs, path or tokenizer_path(), **settings).write.option("compression", "uncompressed").parquet(folder)


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a token table: doc_id, part, block, offset in the block, ids (u32 little-endian)."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data = decode(row["data"]).tobytes()
                lengths = np.array(row["lengths"], np.int64)
                starts, n = np.cumsum(lengths) - lengths, len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * n, pa.int32()),
                     pa.array([row["block"]] * n, pa.int32()), pa.array(starts),
                     pa.array([data[4 * s:4 * (s + k)] for s, k in zip(starts.tolist(), lengths.tolist())], pa.binary())],
                    names=["doc_id", "part", "block", "offset", "ids"])
        give_back()
    table = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    return table.select("part", "block", "doc_ids", "lengths", "data").mapInArrow(
        run, "doc_id bigint, part int, block int, offset bigint, ids binary")


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(part, block, start): the number of ids before each block of a token table.

    Sums of whole parts come first, so one task sees a row per part at most.
    """
    sizes = spark.read.schema(BLOCK_SCHEMA).parquet(folder).select("part", "block", "n_ids")

    def ahead(window):
        return F.coalesce(F.sum("n_ids").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = (sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
             .select(F.col("part"), ahead(Window.orderBy("part")).alias("_before")))
    return (sizes.withColumn("_inside", ahead(Window.partitionBy("part").orderBy("block"))).join(parts, "part")
            .select("part", "block", (F.col("_before") + F.col("_inside")).alias("start")))


def token_index(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of a token table: doc_id, start, n_tokens, ids_crc32."""
    found = read_tokens(spark, folder).select(
        "doc_id", "part", "block", "offset", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))
    return found.join(block_starts(spark, folder), ["part", "block"]).select(
        "doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
