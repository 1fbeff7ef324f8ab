"""Run the queries next to their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is None else "", v if v is not None else 0) for v in row)


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def differences(spark, con, name, build, sql, sf_dir):
    """None when equal, else a short text; also the Spark seconds."""
    start = time.time()
    df = build(spark, sf_dir)
    got_rows = df.collect()
    seconds = time.time() - start
    names, got = rows_of(df.columns, got_rows)
    result = con.execute(sql)
    want_names, want = rows_of([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"columns {set(names) ^ set(want_names)}", seconds
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}", seconds
    for g, w in zip(got, want):
        if g != w:
            bad = [(n, a, b) for n, a, b in zip(names, g, w) if a != b]
            return f"first difference {bad[:4]}", seconds
    return None, seconds
