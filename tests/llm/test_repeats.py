"""Repeated passages against a plain version."""

import hashlib
import random

import numpy as np
import pytest

from wakeline.llm import queries, repeats


def plain_repeats(docs, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept) of distinct ids; rows with a null id stay whole."""
    seen, gone = {}, {}
    for d, t in sorted((x for x in docs if x[0] is not None), key=lambda x: x[0]):
        flags = gone.setdefault(d, np.zeros(len(t), bool))
        for i in range(len(t) - length + 1):
            if seen.setdefault(t[i:i + length], (d, i)) != (d, i):
                flags[i:i + length] = True
    out = []
    for d, t in docs:
        flags = gone[d] if d is not None else np.zeros(len(t), bool)
        spans = int(flags[:1].sum() + (flags[1:] & ~flags[:-1]).sum())
        out.append((d, len(t), int(flags.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~flags])))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


def encoded(rows):
    return [(d, (t or "").encode()) for d, t in rows]


@pytest.mark.parametrize("kind", ["table", "odd", "none"])
def test_query(spark, sf_dir, request, kind, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if kind == "table" else request.getfixturevalue(kind)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    found = queries.op12_merged_transforms(spark, sf_dir)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = plain_repeats(encoded([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        ((*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in want), key=repr)
    assert kind == "none" or any(r[2] for r in want)


def overlapping_texts(rng, n):
    """Texts glued of a few passages, periods and letters, so that much of them repeats at all offsets."""
    passages = ["".join(rng.choice("ab é") for _ in range(rng.choice([30, 99, 100, 101, 260]))) for _ in range(6)]
    pieces = lambda: rng.choice([rng.choice(passages), "ab" * rng.randint(1, 120), "".join(rng.choice("abcd") for _ in range(20)),
                                 "z" * rng.randint(50, 150)])
    return [(rng.choice([i, -i]) if i % 7 else i, "".join(pieces() for _ in range(rng.randint(0, 6)))) for i in range(1, n)]


@pytest.mark.parametrize("most,unit,chunk", [(10**6, 1 << 20, 1 << 20), (2, 1 << 20, 150), (1, 500, 1 << 20)])
def test_hot_anchors_and_small_units(spark, monkeypatch, most, unit, chunk):
    """Whatever the anchors' limit, the units' and the chunks' size, the result is the plain one."""
    monkeypatch.setattr(repeats, "UNIT", unit)
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    docs = overlapping_texts(random.Random(most), 60)
    found = repeats.dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), most=most)
    assert got(found) == plain_repeats(encoded(docs))


def test_strings_alone_with_their_anchor_are_not_compared(spark, monkeypatch):
    """Equal segments are one string, and a segment does not repeat a string of its own."""
    compared, merged = [], repeats._merged
    monkeypatch.setattr(repeats, "_merged", lambda strings, length: compared.append(strings.count()) or merged(strings, length))
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(700))
    docs = [(1, text), (2, text), (3, text[::-1])]
    for more, any_compared in (([], False), ([(4, text[50:300] + "!" + text[300:])], True)):
        found = repeats.dedup(spark.createDataFrame(docs + more, "doc_id bigint, text string"))
        assert got(found) == plain_repeats(encoded(docs + more))
        assert (compared[-1] > 1) == any_compared


def test_other_lengths(spark):
    docs = overlapping_texts(random.Random(9), 40)
    found = repeats.dedup(spark.createDataFrame(docs, "doc_id bigint, text string"), length=40, gram=9)
    assert got(found) == plain_repeats(encoded(docs), 40)


@pytest.mark.parametrize("seed", range(12))
@pytest.mark.parametrize("rounds", [7, 10, 16])
def test_interleave_is_the_order_of_all_suffixes(seed, rounds):
    """By rounds of 1, 5 and 4 characters; texts may be shorter than a round."""
    rng = random.Random(seed)
    texts = [bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(0, 9))) for _ in range(rng.randint(2, 9))]
    texts += [texts[0] + b"ab" * rounds, texts[0] + b"ab" * rounds]
    codes, half = repeats._codes(texts), len(texts) // 2
    a, b = repeats.Shard(codes[:half]), repeats.Shard(codes[half:])
    rows, group = repeats.interleave(a, b, rounds)
    places = [(k, i) for k, t in enumerate(texts) for i in range(len(t) + 1)]
    # Ends are smaller than all bytes, and ordered as the texts are.
    key = lambda p: [x + 1000 for x in texts[p[0]][p[1]:]] + [p[0]]
    cut = {p: tuple(key(p)[:rounds]) for p in places}
    found = []
    for r in rows.tolist():
        shard, first, r = (b, half, r - len(a.order)) if r >= len(a.order) else (a, 0, r)
        k = int(shard.owner[shard.order[r]])
        found.append((first + k, int(shard.order[r] - shard.begins[k])))
    assert sorted(found) == places
    assert [cut[p] for p in found] == sorted(cut.values())
    same = [cut[p] == cut[q] for p, q in zip(found, found[1:])]
    assert [x == y for x, y in zip(group.tolist(), group[1:].tolist())] == same and any(same)


@pytest.mark.parametrize("bits,head", [(2, 31), (3, 21), (7, 9), (21, 3), (31, 2), (63, 1)])
@pytest.mark.parametrize("rounds", [1, 9, 16, 35])
def test_groups_whatever_the_step(bits, head, rounds):
    """As many characters at a time as one number holds; rounds need not be whole steps."""
    rng = random.Random(bits + rounds)
    texts = [bytes(rng.choice(b"ab" if bits == 2 else b"abc") for _ in range(rng.randint(0, 70))) for _ in range(12)]
    texts += [texts[3] + b"ab" * 20, texts[4][5:] + b"ba" * 20, b"ab" * 40]
    codes, half = repeats._codes(texts), len(texts) // 2
    shards = repeats.Shard(codes[:half], bits), repeats.Shard(codes[half:], bits)
    assert all(x.head == head for x in shards)
    rows, group = repeats.interleave(*shards, rounds)
    found = [(k + (half if b else 0), i) for b, x in enumerate(shards) for k, i in zip(
        x.owner[x.order].tolist(), (x.order - x.begins[x.owner[x.order]]).tolist())]
    found = [found[r] for r in rows.tolist()]
    cut = [(list(texts[k][i:]) + [-len(texts) + k])[:rounds] for k, i in found]
    assert len(set(found)) == sum(len(t) + 1 for t in texts) and cut == sorted(cut)
    assert [x == y for x, y in zip(group.tolist(), group[1:].tolist())] == [x == y for x, y in zip(cut, cut[1:])]


def test_every_byte_value():
    every = bytes(range(256))
    assert repeats.repeated([every, every], [1, 2], [0, 50]) == [(2, 50, 306)]
