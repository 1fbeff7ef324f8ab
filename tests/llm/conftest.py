import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, key string, size int, n int, id int, "
          "hub int, shard int, target int, before int, digest string, n_words string, kept string, item_id int")


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows; clashing names come with the schema."""
    rng = random.Random(5)
    vocabulary = [a + b for a in ("sto", "li", "ven", "Qua", "ré", "mun", "x") for b in ("ra", "tion", "de", "ß", "ing", "lo", ".", ",")]

    def text(n):
        w = [rng.choice(vocabulary) for _ in range(n)]
        return "".join(x + (rng.choice("\n\n\t ") if i % 9 == 8 else " ") for i, x in enumerate(w))
    base, long = text(120), text(40_000)
    shared = "  This line of some forty characters is found in MANY documents  "
    near = base.split(" ")
    near[3] = "changed"
    rows = [(1, ""), (2, None), (None, text(30)), (None, base), (None, None), (3, long), (4, base), (5, base), (6, " ".join(near)),
            (7, "one two three"), (8, "one two three"), (9, "ONE two three"), (10, "a b c d e"), (11, " \n\t\x0b "), (12, "\n\n"),
            (13, "12 34 !! ?"), (14, "\x1c \x85 x"), (15, "word " * 400), (16, "x" * 5000), (17, "ab"), (-3, text(50)),
            (2**62, text(50)), (18, "<|endoftext|> is ordinary")]
    rows += [(100 + i, text(40) + "\n" + (shared.upper() if i % 2 else shared) + "\n" + text(20)) for i in range(7)]
    rows += [(300, text(60)), (301, text(60))]
    sources = ["s1", "s2", None, "", "ünder"]
    rows = [(d, t, ("en", "de", None)[i % 3], sources[i % 5 if i % 2 else 0], None, "k", 1, 2, 3, 4, 5, 6, 7, "d", "w", "kept", 8)
            for i, (d, t) in enumerate(rows)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
