"""The operators of this subpackage as named queries, with SQL where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from wakeline.llm import (decontaminate, langid, licenses, linededup, mixing, neardup, prefixtrie, quality, repeats, sharding,
                          tokenio, urlfilter, variants)
from wakeline.operators import skew
from wakeline.operators.skew import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
SHARDS = 40


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_licence_sentences(spark, sf_dir):
    """The licences of every document, by its known sentences."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "_licence.*")


ORACLES["op1_licence_sentences"] = licenses.oracle()


@query
def op2_benchmark_tiling(spark, sf_dir):
    """The benchmark items that documents hold, with the tiles that show it."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_line_dedup(spark, sf_dir):
    """Every document's lines, how many of them go, and a digest of the text that stays."""
    cleaned = linededup.dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_quality_rules(spark, sf_dir):
    """Base counts and the verdict of every document."""
    judged = quality.rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "_quality.*")


@query
def op5_mix_sources(spark, sf_dir):
    """Every document with its source's target and the words that the mix takes of it."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target",
                        (F.col("_mix.size") * F.col("_mix.times")).alias("taken"))


def fetched_pages(spark, sf_dir) -> DataFrame:
    """The pages with a fetch date made from their number, as the table has none."""
    return table(spark, sf_dir, "pages").select("page_id", "url", F.expr(
        "date_add(date'2023-01-01', cast(pmod(page_id * 37, 1461) as int))").alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list made from the pages' own hosts, domains and addresses.

    The digits of a key's md5 say whether and when it is added, removed and
    added again.
    """
    keys = pages.select(F.explode(urlfilter.lookup_keys(F.col("url"))).alias("key")).distinct().withColumn("h", F.md5("key"))
    digits = "cast(conv(substr(h, {}, {}), 16, 10) as int)"
    start = f"date_add(date'2022-06-01', {digits.format(2, 3)} % 1200)"
    return keys.filter("substr(h, 1, 1) < '6'").selectExpr("key", f"""explode(array(
        struct({start} as date, 'add' as action),
        struct(date_add({start}, {digits.format(5, 2)}) as date, 'remove' as action),
        struct(date_add({start}, {digits.format(5, 2)} + {digits.format(7, 2)}) as date, 'add' as action))) as e""").selectExpr(
            "key", "e.date", "e.action")


@query
def op6_temporal_list(spark, sf_dir):
    """Every page, and the list entry that was active for it when it was fetched."""
    pages = fetched_pages(spark, sf_dir)
    judged = urlfilter.judge(pages, list_entries(pages))
    return judged.select("page_id", "url", "fetched", F.col("_verdict.key").isNotNull().alias("blocked"),
                         F.col("_verdict.key").alias("entry"), F.col("_verdict.since").alias("listed_since"))


HOST = r"regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*[^/:?#.])', 1)"
PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
ORACLES["op6_temporal_list"] = f"""with captures as (
  select page_id, url, cast(date '2023-01-01' + cast(((page_id * 37 % 1461) + 1461) % 1461 as integer) as date) as fetched from pages),
hosts as (select distinct url, {HOST} as host, {PATH} as path from captures where url is not null),
labels as (select url, host, path, string_split(host, '.') as l from hosts where host <> ''),
keys as (select url, array_to_string(l[i:], '.') as key, len(l) - i as rank
    from (select *, unnest(range(1, greatest(len(l) - 1, 1) + 1)) as i from labels)
  union all select url, host || case when path = '' then '/' else path end, 1000 from labels),
hashed as (select distinct key, md5(key) as h from keys),
dated as (select key, cast('0x' || substr(h, 2, 3) as integer) % 1200 as a, cast('0x' || substr(h, 5, 2) as integer) as b,
  cast('0x' || substr(h, 7, 2) as integer) as c from hashed where substr(h, 1, 1) < '6'),
entries as (select key, date '2022-06-01' + a as date, 'add' as action from dated
  union all select key, date '2022-06-01' + a + b, 'remove' from dated
  union all select key, date '2022-06-01' + a + b + c, 'add' from dated),
daily as (select key, date, max(action) as action from entries group by all),
spans as (select key, date as since, lead(date) over (partition by key order by date) as until, action from daily),
best as (select c.url, c.fetched, max_by({{'key': s.key, 'since': s.since}}, k.rank) as v
  from (select distinct url, fetched from captures) c join keys k on c.url = k.url
  join spans s on s.key = k.key and s.action = 'add' and s.since <= c.fetched and (s.until is null or s.until > c.fetched)
  group by c.url, c.fetched)
select c.page_id, c.url, c.fetched, v is not null as blocked, v.key as entry, v.since as listed_since
from captures c left join best b on c.url = b.url and c.fetched = b.fetched"""


@query
def op7_piece_language(spark, sf_dir):
    """Every document's language, learned from those whose id falls in other folds than the third of four."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = langid.learn(docs, held_out, langid.read_pieces())
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op8_minhash_components(spark, sf_dir):
    """Every document's component of near-duplicates."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_token_blocks(spark, sf_dir):
    """Every document's place, length and checksum in the token table written of all documents."""
    folder = f"{shared_folder(spark)}/wakeline-tokens-{uuid.uuid4().hex}"
    tokenio.write_tokens(table(spark, sf_dir, "documents"), folder)
    return tokenio.token_index(spark, folder)


@query
def op10_jump_shards(spark, sf_dir):
    """Every document's shard, its place there, and its shard if there were one more."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = sharding.assign(docs, "doc_id", SHARDS, grown="grown_shard")
    numbered = sharding.slots(placed, "shard", ["doc_id", "text_crc32", "size"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# Conversations that share a start, and the bound of how many turns of it they take.
FAMILY, HEADS = 5, 9


@query
def op11_prefix_bands(spark, sf_dir):
    """The prefix trie of all conversations, each given the first turns of its family's first one."""
    placed = skew.settle(prefixtrie.turns(table(spark, sf_dir, "conversations")))
    return prefixtrie.trie(*prefixtrie.families(placed, FAMILY, HEADS))


@query
def op12_merged_transforms(spark, sf_dir):
    """Every document's bytes, how many of them repeat and go, and a digest of those that stay."""
    cleaned = repeats.dedup(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op13_sorted_variants(spark, sf_dir):
    """The frequent words of all documents, the more frequent word that each is a variant of, and the last such word."""
    words = skew.settle(variants.word_counts(table(spark, sf_dir, "documents")))
    return variants.group_variants(words)
