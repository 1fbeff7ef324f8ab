"""Plain Python versions of the operators, for small tables."""

import collections
import hashlib
import itertools
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({c: chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def line_dedup(docs):
    """{doc_id: (n_lines, n_dropped, kept text)} of distinct ids; a null id is smaller than all."""
    def key(line):
        return line.strip(BLANKS).translate(LOWER)
    holders = collections.defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(float("-inf") if d is None else d)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        own = float("-inf") if d is None else d
        stay = [x for x in lines if keeper.get(key(x), own) == own]
        out.append((d, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    w = words(text)
    windows = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = set(itertools.chain.from_iterable(
        range(i, i + 5) for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def base_failed(text):
    n, _, _, _, repeated = base_counts(text)
    return n < 10 or 100 * repeated > 20 * n


def targets(sizes, weights=(5, 2, 1), cap=3):
    """{source: target}: shares by weight, what passes the cap shared again until nothing does."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed.update({s: cap * sizes[s] for s in over})


def shingles(text):
    w = (text or "").translate(LOWER)
    w = words(w)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(docs, similarity=85):
    """[(doc_id, n_shingles, component)]; rows without an id stand alone."""
    sets = [shingles(t) for _, t in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    known = [i for i, (d, _) in enumerate(docs) if d is not None and sets[i]]
    for i, j in itertools.combinations(known, 2):
        if docs[i][0] == docs[j][0] or 100 * len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
            a, b = root(i), root(j)
            if a != b:
                up[a] = b
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), None if d is None else least[root(i)]) for i, (d, _) in enumerate(docs)]


def tokens(text):
    return bytes(b if b > 127 or chr(b).isalnum() else 32 for b in (text or "").lower().encode()).split()


def tiles(a, b, least=5):
    """Greedy string tiling by looking at all pairs of positions."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        free_a[i:i + n] = free_b[j:j + n] = [False] * n
        out.append((i, j, n))


def leaked(docs, items, coverage=0.8):
    """{(doc_id, item_id)} with enough of the item in tiles; items of five words or more."""
    out = set()
    for (d, t), (k, b) in itertools.product([(d, tokens(t)) for d, t in docs], [(k, tokens(b)) for k, b in items]):
        grams = {tuple(b[i:i + 5]) for i in range(len(b) - 4)}
        if any(tuple(t[i:i + 5]) in grams for i in range(len(t) - 4)):
            if sum(n for _, _, n in tiles(t, b)) >= coverage * len(b):
                out.add((d, k))
    return out


def jump(key, shards):
    key, b, j = key & (2**64 - 1), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def token_index(docs, tokenizer):
    """[(doc_id, start, n_tokens, crc)] in ascending order of id, null first, then text."""
    at, out = 0, []
    for d, t in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
