"""Spelling variants against a plain version."""

import collections
import random
import re
import zlib

import pytest

from wakeline.llm import queries, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def plain_counts(docs):
    n = collections.Counter()
    for d, t in docs:
        for run in RUN.findall(t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def one_edit(u, v):
    if abs(len(u) - len(v)) > 1 or u == v:
        return False
    i = next((i for i, (a, b) in enumerate(zip(u, v)) if a != b), min(len(u), len(v)))
    return u[i + (len(u) >= len(v)):] == v[i + (len(v) >= len(u)):]


def plain_variants(n):
    near = collections.defaultdict(list)
    by_size = collections.defaultdict(list)
    for w in n:
        by_size[len(w)].append(w)
    for w in n:
        for size in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [v for v in by_size[size] if one_edit(w, v)]
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def random_words(rng, n, letters="abé", sizes=(5, 8)):
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(n)})


@pytest.mark.parametrize("seed", range(6))
def test_scan_of_a_sorted_list(seed):
    rng = random.Random(seed)
    words = random_words(rng, 150, sizes=(1, 6))
    want = [(i, j) for i, u in enumerate(words) for j, v in enumerate(words) if i < j and one_edit(u, v)]
    assert sorted(variants.near_words(words)) == want
    for shared in ("é", "ab", "aba"):
        some = [w for w in words if w.startswith(shared)]
        want = [(i, j) for i, u in enumerate(some) for j, v in enumerate(some) if i < j and one_edit(u, v)]
        assert sorted(variants.near_words(some, len(shared))) == want


@pytest.mark.parametrize("kind", ["table", "odd", "none"])
def test_query(spark, sf_dir, request, kind, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if kind == "table" else request.getfixturevalue(kind)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = queries.op13_sorted_variants(spark, sf_dir)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain_variants(plain_counts([tuple(r) for r in docs.select("doc_id", "text").collect()]))
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert kind == "none" or any(r[1] for r in want)


@pytest.mark.parametrize("most", [3, 40, 10**6])
def test_large_groups_are_cut(spark, most):
    """Many words that share a beginning and an end, and few letters: no pair is lost however small the groups."""
    rng = random.Random(most)
    words = random_words(rng, 250) + [f"start{w}end" for w in random_words(rng, 150, "abcdefgh", (0, 3))]
    n = {w: rng.choice([3, 4, 7, 20, 300]) for w in words}
    rows = spark.createDataFrame(list(n.items()), "word string, n bigint")
    got = variants.group_variants(rows, most=most)
    assert sorted(map(tuple, got.collect()), key=str) == plain_variants(n)
