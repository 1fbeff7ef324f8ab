"""Each operator against its plain version, on a small table and on odd rows."""

import collections
import random
import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import compare
import corpus_pipeline
from wakeline.llm import (coder, common, decontaminate, langid, licenses, linededup, mixing, neardup, quality, queries, sharding,
                          tokenio, urlfilter)
from wakeline.operators.skew import settle, shared_folder


def pairs(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


def by_value(rows):
    return collections.Counter(map(tuple, rows))


@pytest.fixture(scope="module", params=["table", "odd", "none"])
def docs(request, spark, sf_dir):
    if request.param == "table":
        return spark.read.parquet(f"{sf_dir}/documents.parquet")
    return request.getfixturevalue(request.param)


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_with_sql(spark, sf_dir, name):
    difference, _ = compare.differences(spark, compare.connect(sf_dir), name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)
    assert difference is None


# -- licences

MIT = """/* Permission is hereby granted, free of charge, to any person obtaining a copy
 of this software and associated documentation files (the "Software"), to deal
 in the Software without restriction, including without limitation the rights
 to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 copies of the Software, and to permit persons to whom the Software is
 furnished to do so, subject to the following conditions:

 The above copyright notice and this permission notice shall be included in all
 copies or substantial portions of the Software.

 THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
 IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
 FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
 AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
 LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
 OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
 SOFTWARE."""


@pytest.mark.parametrize("text, ids, found, unmatched", [
    (MIT, "<mit-grant><mit-notice><mit-as-is><mit-liability>", "MIT", 0),
    (MIT + "\nAll rights reserved.", "<mit-grant><mit-notice><mit-as-is><mit-liability><all-rights>", "MIT;proprietary", 0),
    ("no stop here\nReleased under the MIT License.\nmore. All rights reserved.", "<mit-short><all-rights>", "MIT;proprietary", 0),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software.", "<mit-notice>", "", 1),
    ("Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", "<cc-by-nc-4.0><cc-by-nc-4.0>", "CC-BY-NC-4.0", 0),
    ("licence permit rights", "", "", 0), ("", "", "", 0), (None, "", "", 0)])
def test_licences(spark, text, ids, found, unmatched):
    row = licenses.scan(spark.createDataFrame([(text, 1)], "text string, licences int")).first()
    assert (row._licence.sentence_ids, row._licence.licences, row._licence.n_unmatched) == (ids, found, unmatched)
    assert row.licences == 1


@pytest.mark.parametrize("gap", ["\n", "  ", "\t", "\n * ", " " * 2500])
def test_notices_wrapped_or_padded(spark, gap):
    for text, ids in ((f"This is free and unencumbered software released into the public{gap}domain.", "<unlicense-head>"),
                      (f"/* This work is released into the public{gap}domain. */", "<public-domain>"),
                      (f"Released under the MIT{gap}License.", "<mit-short>")):
        assert licenses.scan(spark.createDataFrame([(text,)], "text string")).first()._licence.sentence_ids == ids


def test_licence_tables(spark, odd, none):
    known = licenses.sentences()
    assert all(any(s in text for s in licenses.STEMS) for text in known)
    rows = spark.createDataFrame([(k,) for k in known], "s string").select("s", licenses.normal(F.col("s")).alias("n")).collect()
    assert [r.s for r in rows if r.s != r.n] == []
    assert {i for names, _ in licenses.RULES for i in names} <= set(known.values())
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(none).count() == 0


# -- decontamination

def test_tiling_marks_what_plain_tiling_marks():
    rng = random.Random(3)
    for _ in range(150):
        a = np.array([rng.randrange(3) for _ in range(rng.randrange(1, 60))], np.uint64)
        b = np.array([rng.randrange(3) for _ in range(rng.randrange(1, 30))], np.uint64)
        if rng.random() < 0.5:
            cut = rng.randrange(len(b))
            a = np.concatenate([a, b[cut:], b[:cut]])
        found, plain = decontaminate.tile(a, b, 3), brute.tiles(a.tolist(), b.tolist(), 3)
        assert all((a[i:i + n] == b[j:j + n]).all() for i, j, n in found)
        assert sum(n for _, _, n in found) == len({x for i, _, n in found for x in range(i, i + n)})
        assert max([n for *_, n in found], default=0) == max([n for *_, n in plain], default=0) or len(a) > 40


def test_leaks_are_found_reordered_too(spark, docs, sf_dir):
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    text = next(t for _, t in items if len(brute.tokens(t)) > 24)
    w = text.split(" ")
    extra = [(900, "before " + " ".join(w[12:]) + " between " + " ".join(w[:12])), (901, " ".join(w[:6])), (902, text.upper() + "!")]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"))
    bench = spark.createDataFrame([*items, (None, text), (777, None), (778, ""), (779, "a b")], "item_id bigint, text string")
    plain = brute.leaked(pairs(both.filter("doc_id is null or doc_id <> 3 or length(text) < 50000")), [*items, (None, text)])
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(both, bench).collect()}
    assert plain <= found and {d for d, _ in found - plain} <= {3, None} | {d for d, k in found if k == 779}
    assert {900, 902} <= {d for d, _ in found} and 901 not in {d for d, _ in found}
    small = {(r.doc_id, r.item_id) for r in decontaminate.leaks(both, bench, block_words=200).collect()}
    assert small == found


def test_no_benchmark(spark, odd):
    assert decontaminate.leaks(odd, spark.createDataFrame([], "item_id bigint, text string")).count() == 0


# -- line dedup

@pytest.mark.parametrize("bits", [None, 1 << 27, 1 << 6])
def test_line_dedup(docs, bits):
    found = by_value(linededup.dedup(docs, bits=bits).select("doc_id", "n_lines", "n_dropped", "text").collect())
    assert found == by_value(brute.line_dedup(pairs(docs)))


# -- quality

def plain_scores(docs, labels):
    """{text: score} and the threshold, from every document's bucket numbers."""
    trusted = {r.doc_id: r.held for r in quality.trusted_ids(labels).collect()}
    grams = docs.select("doc_id", "text", quality._buckets(quality._hashes(quality.words(F.col("text")))).alias("g")).collect()
    raw, own = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    for r in grams:
        np.add.at(raw, r.g, 1)
        if trusted.get(r.doc_id) is False:
            np.add.at(own, r.g, 1)
    if not own.any():
        return {r.text: 0.0 for r in grams}, -np.inf
    ratio = np.log((own + quality.PRIOR) / (raw * own.sum() / raw.sum() + quality.PRIOR))
    beyond = np.round(np.minimum(ratio + quality.MARGIN, 0), 1)
    scores = {r.text: beyond[r.g].sum() / np.sqrt(max(len(r.g), 1)) for r in grams}
    held = [round(scores[r.text], 3) for r in grams if trusted.get(r.doc_id)]
    return scores, quality.SLACK * np.quantile(held, quality.LOST, method="inverted_cdf") if held else -np.inf


def test_quality(docs, labels):
    scores, least = plain_scores(docs, labels)
    rows = quality.rules(docs, labels).select("text", "_quality.*").collect()
    for r in rows:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.base_counts(r["text"])
        assert r["base_failed"] == brute.base_failed(r["text"])
        assert r["score"] == pytest.approx(scores[r["text"]], abs=2e-3)
        if abs(scores[r["text"]] - least) > 4e-3:
            assert r["kept"] == (not r["base_failed"] and scores[r["text"]] >= least)


def test_parts_count_the_blanks(docs):
    """One split gives the words and the number of blanks, also of U+000B and others that are no blanks elsewhere."""
    rows = docs.select("text", common.parts(F.col("text")).alias("parts"), common.words(F.col("text")).alias("words")).collect()
    for r in rows:
        assert r.parts == re.split(r"[\x20\x09-\x0D]", r.text or "")
        assert r.words == re.findall(r"[^\x20\x09-\x0D]+", r.text or "")


def test_good_documents_pass_and_bad_ones_fail(spark, labels, sf_dir):
    judged = quality.rules(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).join(labels, "doc_id")
    clean = judged.filter("quality = 1 and toxic = 0 and not _quality.base_failed")
    assert clean.filter("_quality.kept").count() >= 0.98 * clean.count()
    bad = judged.filter("quality = 0")
    assert bad.filter("_quality.kept").count() <= 0.25 * bad.count()


def test_without_trusted_documents(odd, labels):
    rows = quality.rules(odd, labels.limit(0)).select("_quality.*").collect()
    assert all(r.score == 0 and r.kept != r.base_failed for r in rows)


def test_all_trusted_documents_count(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")).unionByName(
        spark.range(-1, 0).select(F.col("id").alias("doc_id"), F.lit("c c c c c c").alias("text")))
    labels = docs.filter("doc_id >= 0").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    trusted = settle(quality.trusted_ids(labels))
    counted = trusted.filter("not held").count()
    assert trusted.count() == 30_000 and 22_000 < counted < 23_000
    # What a word without any trusted use adds tells how many trusted n-grams there are, three a document.
    expected = 6 * 3 * counted / (3 * 30_000 + 11)
    ratios = quality.log_ratios(docs, trusted)
    want = np.log(expected / quality.PRIOR + 1) - quality.MARGIN
    assert len(ratios) == quality.BUCKETS and max(ratios) / quality.STEPS == pytest.approx(want, abs=0.051)


def test_fluent_toxic_documents_go(spark):
    """A few tell-tale words in long, otherwise clean texts; half of the documents have no label."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(800)]
    texts, marks = [], []
    for d in range(600):
        w, toxic = rng.choices(vocabulary, k=300), d % 5 == 0
        if toxic:
            for bad in rng.sample(["vile1", "vile2", "vile3"], 2):
                w[rng.randrange(300)] = bad
        texts.append((d, " ".join(w)))
        if d % 4 < 2:
            marks.append((d, 1, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    rows = quality.rules(spark.createDataFrame(texts, "doc_id bigint, text string"), labels).select("doc_id", "_quality.*").collect()
    assert not any(r.base_failed for r in rows)
    assert not [r.doc_id for r in rows if r.doc_id % 5 == 0 and r.kept]
    assert sum(r.kept for r in rows if r.doc_id % 5) >= 0.98 * 480


def test_quality_plan_is_small(spark):
    """The score table stands in no plan, and a filter on the verdict measures a text once."""
    texts = spark.createDataFrame([(i, "plain words of text " * 5) for i in range(8)], "doc_id bigint, text string")
    trusted = spark.createDataFrame([(i, 1, 0) for i in range(8)], "doc_id bigint, quality int, toxic int")
    for judged in (quality.rules(texts, trusted), quality.rules(texts, trusted).filter("_quality.kept").select("text")):
        plan = judged._jdf.queryExecution().executedPlan().toString()
        assert len(plan) < 50_000 and plan.count("array_remove(") == 1 and "Subquery" in plan


def test_quality_keeps_clashing_columns(spark, labels):
    docs = spark.createDataFrame([(1, "some words", "d", 5, "x")], "doc_id bigint, text string, _digest string, n_foreign int, bucket string")
    row = quality.rules(docs, labels).first()
    assert (row["_digest"], row["n_foreign"], row["bucket"]) == ("d", 5, "x")


# -- mixing

def test_mix(docs):
    rows = mixing.mix(docs).select("doc_id", "text", F.col("source").alias("s"), "_mix.size", "_mix.source_size", "_mix.target",
                                   "_mix.times").collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in rows:
        assert r.size == len(brute.words(r.text)) and 0 <= r.times <= 3
        sizes[r.s] += r.size
        taken[r.s] += r.size * r.times
        largest[r.s] = max(largest[r.s], r.size)
    for r in rows:
        assert r.source_size == sizes[r.s]
        assert r.target == pytest.approx(brute.targets(sizes)[r.s])
    for s in sizes:
        assert abs(taken[s] - brute.targets(sizes)[s]) <= largest[s] / 2 + 1e-6
    again = mixing.mix(docs.repartition(5)).select("doc_id", "text", "_mix.times").collect()
    assert by_value(again) == by_value((r.doc_id, r.text, r.times) for r in rows)
    assert mixing.repeat(mixing.mix(docs), ["doc_id"]).count() == sum(r.times for r in rows)


def test_mix_keeps_clashing_columns(spark):
    names = ["doc_id", "text", "source", "key", "size", "row", "planned", "_key", "_size", "_epochs", "_target", "_plan_source", "epochs", "cut_key"]
    docs = spark.createDataFrame([(1, "a b", "s", *range(11)), (2, None, None, *range(11))], ", ".join(
        f"{n} {'bigint' if n not in ('text', 'source') else 'string'}" for n in names))
    mixed = mixing.mix(docs)
    assert mixed.columns == [*names, "_mix"]
    assert by_value(mixed.drop("_mix").collect()) == by_value(docs.collect())
    assert mixing.repeat(mixed, names).columns == names


# -- URL filter

def test_verdicts_as_of_the_fetch(spark):
    entries = spark.createDataFrame([("bad.org", "2024-01-10", "add"), ("bad.org", "2024-03-01", "remove"), ("bad.org", "2024-06-01", "add"),
                                     ("a.bad.org", "2024-02-01", "add"), ("ok.org/p", "2024-01-01", "add"), ("tie.org", "2024-01-01", "add"),
                                     ("tie.org", "2024-01-01", "remove"), (None, "2024-01-01", "add"), ("x.org", None, "add"),
                                     ("odd.org", "2024-01-01", "other")], "key string, date string, action string")
    asked = [("http://BAD.org/x", "2024-01-09", None), ("http://bad.org", "2024-01-10", "bad.org"), ("http://bad.org", "2024-02-29", "bad.org"),
             ("http://bad.org", "2024-03-01", None), ("http://bad.org:80/", "2025-06-01", "bad.org"), ("https://u@b.a.bad.org./", "2024-04-01", "a.bad.org"),
             ("https://ok.org/p?q=1", "2024-04-01", "ok.org/p"), ("https://ok.org/q", "2024-04-01", None), ("http://tie.org", "2024-04-01", None),
             ("http://notbad.org", "2024-02-01", None), ("no address", "2024-02-01", None), ("", "2024-02-01", None), (None, "2024-02-01", None),
             ("http://bad.org", None, None), ("http://bad.org", "2024-01-10", "bad.org"), ("http://odd.org", "2024-02-01", None)]
    captures = spark.createDataFrame(asked, "url string, day string, key string").withColumn("fetched", F.to_date("day"))
    entries = entries.withColumn("date", F.to_date("date"))
    rows = urlfilter.judge(captures, entries).select("key", F.col("_verdict.key").alias("got")).collect()
    assert len(rows) == len(asked) and all(r.key == r.got for r in rows)
    assert urlfilter.judge(captures.limit(0), entries).count() == 0
    assert urlfilter.judge(captures, entries.limit(0)).filter("_verdict is not null").count() == 0


def test_verdicts_keep_clashing_columns(spark):
    captures = spark.sql("select 'http://a.org' as url, date'2024-01-02' as fetched, 1 as _url, 2 as _day, 3 as key, 4 as slice, 5 as row, 6 as since")
    entries = spark.sql("select 'a.org' as key, date'2024-01-01' as date, 'add' as action")
    row = urlfilter.judge(captures, entries).first()
    assert list(row[2:8]) == [1, 2, 3, 4, 5, 6] and row["_verdict"]["key"] == "a.org"


# -- languages

def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "bab"]
    p = np.random.default_rng(0).random((len(pieces), 2))
    model, lattice = langid.Model(["p", "q"], pieces, p, np.zeros(2)), langid.Lattice(pieces)

    def plain(word, at):
        sums = [1.0]
        for end in range(1, len(word) + 1):
            sums.append(sums[-1] * langid.UNKNOWN + sum(
                sums[s] * p[pieces.index(word[s:end]), at] for s in range(end) if word[s:end] in pieces))
        return np.log(sums[-1])
    chosen = ["▁", "▁ab", "▁abab", "▁xab", "▁bababab", "▁xxxa", "▁" + "abx" * 14]
    assert np.allclose(model.word_scores(lattice, chosen), [[plain(w, k) for k in (0, 1)] for w in chosen])


def test_languages(spark, docs, sf_dir):
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    train = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = langid.learn(train, held_out, langid.read_pieces(), limit=20)
    rows = langid.identify(docs, model).collect()
    texts = pairs(docs)
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 for r in rows)
    und = sum(1 for _, t in texts if not any(map(str.isalpha, t or "")))
    assert sum(r.lang_pred == "und" for r in rows) == und
    if docs.columns == train.columns:
        truth = {r.doc_id: r.lang for r in train.filter(held_out).collect()}
        assert sum(truth[r.doc_id] == r.lang_pred for r in rows if r.doc_id in truth) >= 0.97 * len(truth)
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} <= {"und"}


def test_the_longest_pieces_are_read():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=langid.vocabulary_path())
    longest = max((model.id_to_piece(i) for i in range(model.get_piece_size()) if not (
        model.is_control(i) or model.is_unknown(i) or model.is_byte(i))), key=len)
    assert len(longest) > 12 and longest in langid.read_pieces()


def test_nothing_to_learn(none):
    assert langid.learn(none, F.lit(False), ["a"]) is None


# -- near-duplicates

@pytest.mark.parametrize("block", [neardup.BLOCK, 2])
def test_components(docs, block):
    got = by_value(neardup.near_duplicates(docs, block).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == by_value((d, n, c, d == c) for d, n, c in brute.components(pairs(docs)))


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(9999)}" for _ in range(120)]
    rows = []
    for d in range(150):
        w = list(base)
        for _ in range(rng.randrange(5)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = neardup.near_duplicates(df, block=16).select("doc_id", "n_shingles", "component_id").collect()
    assert by_value(got) == by_value(brute.components(rows))


def test_a_large_group_shrinks_to_what_is_left(spark, monkeypatch):
    """Near copies of one text, some of them near only to each other: compared with the first, few rows are left."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for d in range(400):
        w = list(base)
        if d % 40 in (7, 8):  # far from the first, near to each other
            w[:30 + d % 40 - 7] = [f"y{i}" for i in range(30 + d % 40 - 7)]
        w[rng.randrange(40, 200)] = f"x{d}"
        rows.append((d, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = []
    groups, shrunk = neardup._groups, neardup._shrunk
    monkeypatch.setattr(neardup, "_shrunk", lambda members, *a: sizes.append(members.count()) or shrunk(members, *a))
    monkeypatch.setattr(neardup, "_groups", lambda members, block: sizes.append(groups(members, block).count()) or groups(members, block))
    got = neardup.near_duplicates(df, block=20).select("doc_id", "n_shingles", "component_id").collect()
    assert by_value(got) == by_value(brute.components(rows))
    assert sizes[-1] < 3 * sizes[0]


def test_near_copies_at_80_per_cent(spark):
    """Sets of 200 shingles: 182 shared of 218 are 0.83, 176 of 224 are 0.79."""
    def copy(text, changed):  # changes `changed` words at the end, one shingle each
        return text[:len(text) - changed] + [f"{text[0]}x{i}" for i in range(changed)]
    rows = []
    for d in range(20):
        text = [f"d{d}w{i}" for i in range(204)]
        rows += [(3 * d, " ".join(text)), (3 * d + 1, " ".join(copy(text, 18)))]
        far = [f"e{d}w{i}" for i in range(204)]
        rows += [(1000 + 2 * d, " ".join(far)), (1001 + 2 * d, " ".join(copy(far, 24)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = {r.doc_id for r in neardup.near_duplicates(docs, similarity=80).filter("kept").collect()}
    assert kept == {d for d, _ in rows} - {3 * d + 1 for d in range(20)}
    assert neardup.near_duplicates(docs).filter("kept").count() == len(rows)
    assert neardup.matches_for(85) == neardup.MATCHES > neardup.matches_for(80)


def test_components_of_a_chain(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 200), (200, 100), (7, 7)], "u bigint, v bigint")
    got = {r.id: r.component for r in neardup.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, n + 1)}, 200: 100}


# -- token output

@pytest.mark.parametrize("alphabet, lengths", [(49408, (0, 1, 63, 64, 127, 128, 129, 9000, 70001)), (1, (0, 5, 300)), (65536, (500,))])
def test_blocks_round_trip(alphabet, lengths):
    rng = np.random.default_rng(1)
    for n in lengths:
        for ids in (rng.integers(0, alphabet, n), np.minimum(rng.zipf(1.3, n), alphabet - 1), np.zeros(n, int)):
            block = coder.encode(ids, alphabet)
            assert (coder.decode(block) == ids).all()
    with pytest.raises(ValueError):
        coder.encode(np.array([alphabet]), alphabet)


def test_damage_is_noticed():
    ids = np.random.default_rng(1).integers(0, 900, 5000)
    block = coder.encode(ids, 1000)
    for at in (0, 5, 13, 17, len(block) // 2, len(block) // 3, len(block) - 1):
        hurt = bytearray(block)
        hurt[at] ^= 4
        try:
            assert (coder.decode(bytes(hurt)) == ids).all() and at > len(block) - 8  # the last bits may mean nothing
        except ValueError:
            pass
    for short in (b"", bytes(block[:30]), bytes(block[:-4])):
        with pytest.raises(ValueError):
            coder.decode(short)


def test_common_ids_take_few_bits():
    ids = np.tile(np.arange(50), 4000)
    assert len(coder.encode(ids, 49408)) < len(ids)


def test_chunks_give_the_ids_of_whole_texts():
    encoder = tokenio.TextEncoder(tokenio.tokenizer_path(), True)
    hard = ["a  b\tc\nd\r\ne", "<|endoftext|> x<|startoftext|>y", "É é ́a ΣΑΣ ς", "it's don't 've I'll 123 4a", "\x1cfoo\x85bar baz q",
            "!!a!! \x0b\x0c ", "", " ", "日本語 テキスト🙂🙂 ﬁ", "x" * 5000, "'s 's a's", "a 's", "́́ ́", "İstanbul ǅ"]
    for found, text in zip(encoder(pa.array(hard)), hard):
        assert found.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_thinned_out_chunks(monkeypatch):
    encoder = tokenio.TextEncoder(tokenio.tokenizer_path(), True)
    encoder.known.most = 20
    rng = random.Random(1)
    for _ in range(30):
        texts = [" ".join(f"w{int(rng.expovariate(0.1))}" for _ in range(30)) for _ in range(3)]
        for found, text in zip(encoder(pa.array(texts)), texts):
            assert found.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_signs_and_case_make_no_new_pieces():
    encoder = tokenio.TextEncoder(tokenio.tokenizer_path(), True)
    text = "Word word, WORD. word's Élan, élan. word. WORD, élan's"
    assert encoder(pa.array([text]))[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.lengths) == 6  # word, Élan, élan and , . 's


def test_fine_pieces_give_the_ids_of_whole_texts():
    encoder = tokenio.TextEncoder(tokenio.tokenizer_path(), True)
    rng = random.Random(1)
    letters = [*"aZJeESsT.,'-<|=>`^_ 1\n\t×÷ßÀéÿªİΣ“ç—字", "\u0301", "\u0338", "\u030c", "\u0130", "\u212a", "\u037e", "\u1680", "🙂", "'s", "'LL", "==="]
    added = ["<|endoftext|>", "<|ENDofText|>", "<|startoftext|>"]
    for n in range(300):
        texts = ["".join(rng.choices(letters + (added if n % 10 == 0 else []), k=rng.randrange(40))) for _ in range(20)]
        for found, text in zip(encoder(pa.array(["", *texts]).slice(1)), texts):
            assert found.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder(pa.array([], pa.string())) == [] and encoder(pa.array([""]))[0].tolist() == []


def test_ids_at_places_of_the_order_0_shares():
    rng = np.random.default_rng(1)
    for alphabet in (1, 300, 49408):
        model = coder._Model(alphabet, 10)
        for ids in (np.zeros(0, int), np.minimum(rng.zipf(1.3, 5000), alphabet - 1)):
            model.recent.append(ids)
            model._spread()
            places = np.unique(np.concatenate([rng.integers(0, model.sums[-1], 20_000), model.sums[:-1], model.sums[1:] - 1]))
            assert (model.found(places) == np.searchsorted(model.sums, places, side="right") - 1).all()


@pytest.mark.parametrize("parted, block_ids", [(True, 700), (False, 1 << 20)])
def test_token_table(spark, docs, tmp_path, parted, block_ids):
    tokenio.write_tokens(docs, f"{tmp_path}/t", parted=parted, block_ids=block_ids)
    encoder = tokenio.TextEncoder(tokenio.tokenizer_path(), False)
    got = tokenio.token_index(spark, f"{tmp_path}/t").select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert by_value(got) == by_value(brute.token_index(pairs(docs), encoder.tokenizer))


def test_pieces_encoded_in_groups(monkeypatch):
    """New pieces are encoded some at a time, with the same ids."""
    monkeypatch.setattr(tokenio, "NEW_PIECES", 3)
    encoder = tokenio.TextEncoder(tokenio.tokenizer_path(), True)
    sizes = []
    for name in ("_encoded", "_encoded_words"):
        monkeypatch.setattr(encoder, name, lambda new, f=getattr(encoder, name): (sizes.append(len(new)), f(new))[1])
    texts = ["One two three, four five's 12 six", "seven \u00c9lan x1y2 eight nine ten, two", ""]
    for text, found in zip(texts, encoder(pa.array(texts))):
        assert found.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert max(sizes) <= 3


# -- shards

def test_shards(docs):
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = sharding.assign(docs, "doc_id", 40, grown="grown").withColumn("crc", F.crc32(text))
    rows = sharding.slots(placed, "shard", ["doc_id", "crc"]).select("doc_id", "shard", "grown", "slot", "crc", "text").collect()
    assert len(rows) == docs.count()
    slots = collections.defaultdict(list)
    for r in rows:
        assert (r.shard, r.grown) == (brute.jump(r.doc_id or 0, 40), brute.jump(r.doc_id or 0, 41)) and r.grown in (r.shard, 40)
        assert r.crc == zlib.crc32((r.text or "").encode())
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_any_number_and_key(spark, tmp_path):
    keys = [-5, 0, 7, 2**62, -2**63, 2**63 - 1]
    df = spark.createDataFrame([(k, str(k)) for k in keys], "k bigint, s string")
    for n in (1, 2, 24, 25, 1000, 100_000):
        assert {r.k: r.shard for r in sharding.assign(df, "k", n).collect()} == {k: brute.jump(k, n) for k in keys}
    by_text = sharding.assign(df, "s", 10)
    sharding.write_shards(by_text, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == len(keys)


# -- pipeline

def test_pipeline(spark, sf_dir, labels):
    """Every stage against the plain versions, from what the stage before it kept."""
    docs, texts = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, columns = pairs(docs) if "text" in docs.columns else [], docs.columns
        docs = settle(stage(spark, docs, sf_dir))
        kept.append((name, before, docs))
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
    (_, raw, a), (_, in8, b), (_, in2, c), (_, in5, d), (_, in9, e) = kept
    assert not [t for _, t in pairs(a) if brute.base_failed(t)] and len(in8) > 0.7 * len(raw)
    assert by_value(pairs(b)) == by_value((k, t) for (k, t), (_, _, c_) in zip(in8, brute.components(in8, 80)) if k == c_)
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    gone = {k for k, _ in brute.leaked(in2, items)}
    assert by_value(pairs(c)) == by_value((k, t) for k, t in in2 if k not in gone)
    assert max(by_value(pairs(d)).values()) <= 3 and set(pairs(d)) <= set(in5)
    tokenizer = tokenio.TextEncoder(tokenio.tokenizer_path(), False).tokenizer
    assert by_value(e.collect()) == by_value(brute.token_index(in9, tokenizer))
    assert by_value(corpus_pipeline.run(spark, sf_dir).collect()) == by_value(e.collect())


def test_pipeline_stages_on_odd_rows(spark, odd, none, sf_dir):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), sf_dir).count()


def test_leaks_without_an_id_go(spark, sf_dir):
    """Of the documents without an id those that hold an item go, the others stay."""
    items = [r[0] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").limit(3).collect()]
    docs = spark.createDataFrame([(None, items[0]), (5, items[1]), (None, "some clean text of eight words or so"), (6, "clean too"),
                                  (None, None), (None, f"before {items[2]} after")], "doc_id bigint, text string")
    kept = corpus_pipeline.decontamination(spark, docs, sf_dir)
    assert by_value(kept.collect()) == by_value([(None, "some clean text of eight words or so"), (6, "clean too"), (None, None)])


def test_shared_folder_is_used(spark):
    assert shared_folder(spark)
