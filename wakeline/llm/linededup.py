"""Line dedup: two Bloom filters find the lines that may repeat; only those are shuffled.

Each task notes the lines of its documents in a filter of lines seen once, and
those that hit it in a filter of lines seen twice. Filters of several tasks
merge by bits: what two once-filters share was seen twice. Lines that hit the
merged filter are suspects; they are counted exactly by their key, and the
largest document of a repeated line keeps it. A false hit costs a shuffled row,
never a wrong result. Documents without a suspect pass through untouched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from wakeline.llm.common import BLANKS
from wakeline.operators import skew

MIN_CHARS, MIN_DOCS = 40, 5
# Bits of a filter for each long line, and the least and most bits of a filter: 128 MB.
# Up to a hundred million lines some per cent of the single ones are suspects; beyond,
# more lines only mean more suspects.
LINE_BITS, LEAST_BITS, MOST_BITS = 10, 1 << 22, 1 << 30
SEGMENT_BITS = 1 << 20
# Stands for a null id: such rows count as one document, smaller than all others.
NO_ID = -(1 << 63)


def line_key(line: bytes) -> bytes:
    """What lines are compared by: blanks stripped at both ends, A to Z lower-cased; in UTF-8."""
    return line.strip(BLANKS.encode()).lower()


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts of a string column in UTF-8; null is empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), dtype=np.uint64, count=len(keys))


def _bits(h: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions of each hash, as rows."""
    low = np.uint64(bits - 1)
    return np.stack([h & low, (h >> np.uint64(32)) & low], axis=1).astype(np.int64)


def _has(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1) != 0).all(axis=1)


def _add(bitmap: np.ndarray, at: np.ndarray) -> None:
    np.bitwise_or.at(bitmap, at >> 3, np.left_shift(1, at & 7).astype(np.uint8))


def _long_keys(lines: list[bytes], min_chars: int) -> list[bytes]:
    """The distinct keys of a document that have enough code points."""
    keys = dict.fromkeys(line_key(x) for x in lines if len(x) >= min_chars)
    return [k for k in keys if len(k) >= min_chars and (len(k) >= 4 * min_chars or len(k.decode()) >= min_chars)]


def _pack(bitmap: np.ndarray) -> bytes:
    return zlib.compress(bitmap.tobytes(), 1)


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint8)


def filter_bits(docs: DataFrame, min_chars: int = MIN_CHARS) -> int:
    """Bits that the lines of the documents need: a power of two.

    A text has no more long lines than lines, and no more than fit its length.
    """
    size = F.octet_length("text")
    lines = size - F.octet_length(F.translate("text", "\n", "")) + 1
    most = docs.agg(F.sum(F.least(lines, F.floor((size + 1) / (min_chars + 1))))).first()[0] or 0
    return min(max(1 << (int(most) * LINE_BITS).bit_length(), LEAST_BITS), MOST_BITS)


def repeat_filter(docs: DataFrame, bits: int, min_chars: int = MIN_CHARS) -> np.ndarray:
    """The merged twice-filter over the lines of all documents, `bits` long."""
    step = min(bits, SEGMENT_BITS) // 8

    def build(batches):
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            keys = [k for text in texts_of(batch.column(0)) for k in _long_keys(text.split(b"\n"), min_chars)]
            if keys:
                distinct, count = np.unique(_hashes(keys), return_counts=True)
                at = _bits(distinct, bits)
                _add(twice, at[(count > 1) | _has(once, at)])
                _add(once, at)
        for i in range(0, bits // 8, step):
            if once[i:i + step].any():
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([i // step], pa.int32()), "once": [_pack(once[i:i + step])],
                    "twice": [_pack(twice[i:i + step])]})

    def merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(step, np.uint8), np.zeros(step, np.uint8)
        for batch in batches:
            for o, t in zip(batch.column("once"), batch.column("twice")):
                other = _unpack(o.as_py())
                twice |= _unpack(t.as_py()) | (once & other)
                once |= other
        yield pa.RecordBatch.from_pydict({"segment": pa.array([key[0].as_py()], pa.int32()), "twice": [_pack(twice)]})

    parts = docs.select("text").mapInArrow(build, "segment int, once binary, twice binary")
    merged = np.zeros(bits // 8, np.uint8)
    for row in parts.groupBy("segment").applyInArrow(merge, "segment int, twice binary").collect():  # `bits` in all
        merged[row.segment * step:(row.segment + 1) * step] = _unpack(row.twice)
    return merged


def suspects(docs: DataFrame, merged: np.ndarray, min_chars: int = MIN_CHARS) -> DataFrame:
    """Adds to (doc_id, text) the number of lines and the keys that the twice-filter holds."""
    shared = docs.sparkSession.sparkContext.broadcast(_pack(merged))
    bits = len(merged) * 8

    def probe(batches):
        twice = _unpack(shared.value)
        for batch in batches:
            lines = [t.split(b"\n") for t in texts_of(batch.column(1))]
            keys = [_long_keys(x, min_chars) for x in lines]
            hit = _has(twice, _bits(_hashes([k for x in keys for k in x]), bits)).tolist()
            ends = np.cumsum([len(x) for x in keys]).tolist()
            found = [[k for k, h in zip(x, hit[e - len(x):e]) if h] for x, e in zip(keys, ends)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(x) for x in lines], pa.int64()),
                 pa.array(found, pa.list_(pa.string()))], names=["doc_id", "text", "n_lines", "keys"])

    return docs.mapInArrow(probe, "doc_id bigint, text string, n_lines bigint, keys array<string>")


def dedup(docs: DataFrame, bits: int | None = None, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and the text that stays.

    A line whose key has `min_chars` code points or more and is found in at
    least `min_docs` documents stays only in the largest doc_id holding it,
    there wherever it stands. A null or empty text is one empty line. Rows of
    one doc_id are one document; rows with a null id are one document, smaller
    than all others. Other columns are left out. `bits` is the filters' size,
    taken from the number of lines if not given.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    bits = bits or filter_bits(docs, min_chars)
    noted = skew.settle(suspects(docs, repeat_filter(docs, bits, min_chars), min_chars))
    held = (noted.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("holder"), F.explode("keys").alias("key"))
            .groupBy("key", "holder").agg(F.lit(1).alias("one")))
    repeated = (held.groupBy("key").agg(F.count("one").alias("n_docs"), F.max("holder").alias("keeper"))
                .filter(F.col("n_docs") >= min_docs).select("key", "keeper"))
    drops = (held.join(repeated, "key").filter(F.col("holder") != F.col("keeper"))
             .groupBy("holder").agg(F.collect_list("key").alias("drop")))
    touched = (noted.filter(F.size("keys") > 0).withColumn("holder", F.coalesce("doc_id", F.lit(NO_ID)))
               .join(drops, "holder", "left").select("doc_id", "text", "n_lines", "drop"))

    def cut(batches):
        for batch in batches:
            texts, dropped = [], []
            for text, drop in zip(texts_of(batch.column(1)), batch.column(3).to_pylist()):
                lines, gone = text.split(b"\n"), {k.encode() for k in drop or ()}
                stay = [x for x in lines if line_key(x) not in gone] if gone else lines
                texts.append(b"\n".join(stay))
                dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "text"])

    clean = noted.filter(F.size("keys") == 0).select(
        "doc_id", "n_lines", F.lit(0).cast("bigint").alias("n_dropped"), F.coalesce("text", F.lit("")).alias("text"))
    return clean.unionByName(touched.mapInArrow(cut, "doc_id bigint, n_lines bigint, n_dropped bigint, text string"))
