"""The prefix trie against a plain version."""

import collections
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wakeline.llm import prefixtrie, queries
from wakeline.operators import skew

SCHEMA = "conv_id bigint, turn int, role string, text string, depth int, node string, parent string, n int"


def plain_trie(rebuilt):
    """{conv_id: [(role, text), ...]} -> rows of the trie."""
    members, kids = collections.defaultdict(list), collections.defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    out = []

    def total(node):
        below = [total(k) for k in kids[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        leaves = sum(b[0] for b in below) if below else 1
        saved += sum(b[1] for b in below)
        ends = sorted(c for c in members[node] if len(rebuilt[c]) == len(node))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
                    len(kids[node]), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
        return leaves, saved
    if rebuilt:
        total(())
    return sorted(out, key=repr)


def rebuild(rows):
    """(conv_id, turn, role, text) -> {conv_id: turns}, as the query's contract has it."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names
    return sorted(map(tuple, df.collect()), key=repr)


def odd_conversations():
    rng = random.Random(3)
    says = ["hello", "", None, "ça va?", "x" * 3000, "no"]
    rows = [(c, t if rng.random() < 0.95 else None, rng.choice(["user", "assistant", None]) if c % 3 else "user",
             rng.choice(says) if c % 4 else f"turn {t}", 1, "n", "p", 2)
            for c in list(range(40)) + [-3, -7, 2**62] for t in range(rng.choice([1, 2, 3, 9, 25]))]
    rows += [(50 + c, t, "user", f"turn {t}", 1, "n", "p", 2) for c in range(12) for t in range(10)]  # copies
    return rows + rows[:30] + [(None, 1, "user", "nobody's", 1, "n", "p", 2)]


@pytest.mark.parametrize("kind", ["table", "odd", "none"])
def test_query(spark, sf_dir, kind, monkeypatch):
    if kind == "table":
        rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    else:
        rows = spark.createDataFrame(odd_conversations() if kind == "odd" else [], SCHEMA).repartition(3)
    monkeypatch.setattr(queries, "table", lambda *_: rows)
    found = queries.op11_prefix_bands(spark, sf_dir)
    plain = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert got(found) == plain_trie(rebuild(plain))


@pytest.mark.parametrize("height", [2, 3, 8])
def test_deep_conversations(spark, height):
    """Several levels of bands, runs of turns that are cut, many conversations that share all."""
    rng = random.Random(height)
    stem = [("user", f"t{i}") for i in range(300)]
    convs = {c: stem[:rng.choice([0, 1, 70, 150, 300])] + [("user", str(rng.random()))] * rng.choice([0, 2, 5])
             for c in range(60)}
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    placed = prefixtrie.turns(spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string"))
    every = spark.createDataFrame([(c,) for c in convs], "conv_id bigint")
    assert got(prefixtrie.trie(skew.settle(placed), every, height)) == plain_trie(convs)


def test_many_ends_are_hashed_in_order(spark):
    ids = random.Random(1).sample(range(-10**6, 10**6), 5000) + [2**62 + i for i in range(700)]
    placed = spark.createDataFrame([(c, 0, b"x", 1) for c in ids], "conv_id bigint, pos bigint, digest binary, bytes bigint")
    rows = prefixtrie.trie(placed, placed.select("conv_id")).collect()
    want = hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    assert {(r.depth, r.n_convs, r.ends_sha256) for r in rows} == {
        (0, 5700, hashlib.sha256(b"").hexdigest()), (1, 5700, want)}


def test_large_conversations_are_numbered_in_blocks(spark, monkeypatch):
    rows = spark.createDataFrame([(c, t, "user", f"{t}") for c in (1, 2) for t in range(900)], "conv_id bigint, turn int, role string, text string")
    whole = prefixtrie.turns(rows).orderBy("conv_id", "pos").collect()
    real = skew.positions
    monkeypatch.setattr(skew, "positions", lambda *a, **k: real(*a, **k, limit=100))
    assert prefixtrie.turns(rows).orderBy("conv_id", "pos").collect() == whole
    assert [r.pos for r in whole] == [*range(900)] * 2
