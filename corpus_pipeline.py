"""From raw documents to token blocks, in five stages.

Each stage takes (spark, docs, folder of tables) and returns a DataFrame, which
is written as Parquet and read again as the next one's documents. A stage works
on all rows that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline.llm import decontaminate, mixing, neardup, quality, tokenio
from wakeline.llm.common import broadcast_if
from wakeline.operators.skew import settle, shared_folder

# Near-duplicates share this part of their shingles, per cent of the union.
SIMILARITY = 80
# Ids to remove up to this number are joined by broadcast (some 40 MB); more by a shuffle.
MAX_BROADCAST_IDS = 2_000_000


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is not in `ids` (doc_id)."""
    return docs.join(broadcast_if(settle(ids.distinct()), MAX_BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that pass the quality rules."""
    judged = quality.rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged.filter("_quality.kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return without(docs, neardup.near_duplicates(docs, similarity=SIMILARITY).filter("not kept").select("doc_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item.

    Documents without a doc_id are known by a hash of their texts instead.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    named = docs.filter("doc_id is not null")
    clean = without(named, decontaminate.leaks(named, benchmark).select("doc_id"))
    nameless = docs.filter("doc_id is null")
    hashed = nameless.select(F.xxhash64("text").alias("doc_id"), "text")
    found = settle(decontaminate.leaks(hashed, benchmark).select(F.col("doc_id").alias("leak")).distinct())
    rest = nameless.join(broadcast_if(found, MAX_BROADCAST_IDS), F.xxhash64("text") == F.col("leak"), "left_anti")
    return clean.unionByName(rest)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, not at all for some."""
    return mixing.repeat(mixing.mix(docs), docs.columns)


def token_blocks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The index of the token table that is written of the documents: doc_id, start, n_tokens, ids_crc32."""
    folder = f"{shared_folder(spark)}/wakeline-tokens-{uuid.uuid4().hex}"
    tokenio.write_tokens(docs, folder)
    return tokenio.token_index(spark, folder)


STAGES = [("quality rules", quality_rules), ("MinHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("mixing sources to target weights", mix_sources),
          ("token-ID / binary output", token_blocks)]

# Hashed likelihood ratios, MinHash and a tokenizer have no SQL form; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
