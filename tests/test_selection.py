"""Quantiles by narrowing histograms, against numpy and the plain way."""

import math
import random

import numpy as np
import pytest

from wakeline.operators import selection, skew, stats
from wakeline.operators.stats import Stat

QS = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)


def shapes(rng):
    """Values by shape: even, piled up, with very different sizes, few, with infinities, with ends of the range."""
    return {
        1: [rng.uniform(-5, 5) for _ in range(700)],
        2: [0.0] * 400 + [rng.choice([1.0, 2.0, 2.5]) for _ in range(200)] + [None] * 20,
        3: [rng.choice([-1, 1]) * 2.0 ** rng.randint(-60, 60) * rng.random() for _ in range(500)],
        4: [3.25], 5: [], 6: [1.0, 2.0],
        7: [math.inf] * 50 + [-math.inf] * 30 + [rng.gauss(0, 1) for _ in range(90)],
        8: [math.inf, -math.inf, math.inf], 9: [8e307, -8e307, 0.5, 1.0, -1.0, 8.5e307],
        10: [round(rng.gauss(0, 30), 1) for _ in range(900)]}


@pytest.mark.parametrize("bins,most,some", [(1024, 10_000, None), (16, 5, (1, 2, 5, 7, 9, 10)), (5, 10_000, (3, 7, 8))])
def test_against_numpy(spark, monkeypatch, bins, most, some):
    monkeypatch.setattr(selection, "BINS", bins)
    monkeypatch.setattr(selection, "LIST", most)
    data = {k: v for k, v in shapes(random.Random(bins)).items() if some is None or k in some}
    rows = spark.createDataFrame([(k, v, -2 * v if v is not None else None) for k, x in data.items() for v in x],
                                 "id bigint, v double, w double").repartition(5)
    pairs = [("v", None), ("w", None)]
    bounds = skew.settle(rows.groupBy("id").agg(*selection.range_aggregates(pairs)))
    found = selection.quantiles(rows, bounds, "id", pairs, [QS, (0.3,)]).collect()
    got = {r["id"]: r["_quantiles"] for r in found}
    assert set(got) == {k for k, x in data.items() if any(v is not None for v in x)}
    for k, x in data.items():
        x = np.sort([v for v in x if v is not None])
        if not len(x):
            continue
        for pair, values, qs in ((0, x, QS), (1, np.sort(-2 * x), (0.3,))):
            for q, g in zip(qs, got[k][pair]):
                at = q * (len(values) - 1)
                low, high = values[math.floor(at)], values[math.ceil(at)]
                with np.errstate(invalid="ignore"):
                    want = low if low == high else low * (1 - (at - math.floor(at))) + high * (at - math.floor(at))
                assert g == want or (math.isnan(g) and math.isnan(want)), (k, pair, q)


def test_large_and_small_tracks_agree(spark):
    rng = random.Random(4)
    rows = [(i, rng.gauss(0, 1), rng.randint(0, 3), rng.random() < 0.3 and i != 2)
            for i, n in ((1, 3000), (2, 2500), (3, 40)) for _ in range(n)]
    p = spark.createDataFrame(rows, "id bigint, a double, b int, m boolean").repartition(4)
    wanted = [Stat(f"{c}_{q}_{m}", c, "q", q, m) for c in "ab" for q in (0.1, 0.5, 0.8) for m in (None, "m")]
    wanted += [Stat("n", "a", "nunique"), Stat("k", "b", "nunique", mask="m"), Stat("s", "a", "sum", mask="m"),
               Stat("rows", "id", "rows"), Stat("in_mask", "id", "rows", mask="m"), Stat("top", "b", "max")]
    plain = stats.stat_block(p, wanted, limit=10**6)
    split = stats.stat_block(p, wanted, limit=1000)
    assert plain.dtypes == split.dtypes
    for a, b in zip(plain.orderBy("id").collect(), split.orderBy("id").collect()):
        assert [x == pytest.approx(y, rel=1e-12) if isinstance(x, float) else x == y for x, y in zip(a, b)] == [True] * len(a)
    assert split.filter("id = 2").first()["a_0.5_m"] is None


def test_lists_of_one_track_at_a_time(spark):
    """Grouped by sorting, without another exchange where the rows are placed by track."""
    p = spark.range(1000).selectExpr("id % 7 AS id", "CAST(id AS DOUBLE) AS a").repartition(4, "id")
    plan = stats.stat_block(p, [Stat("q", "a", "q", 0.5)], large=None)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan
    assert plan.count("Exchange") == 1


def test_blocks_are_cut_inside_partitions(spark, monkeypatch):
    monkeypatch.setattr(skew, "MIN_BLOCK_ROWS", 10)
    monkeypatch.setattr(skew, "MAX_PARTITIONS", 3)
    df = spark.range(2000).selectExpr("id % 2 AS id", "id AS seq").repartition(4)
    large = skew.find_large(df, ["id"], 50)
    blocks = skew.split_blocks(df, large, ["seq"])
    sizes = {r["block"]: r["count"] for r in blocks.groupBy("block").count().collect()}
    assert max(sizes.values()) <= 50 and 40 <= len(sizes) <= 46
    spans = blocks.groupBy("id", "block").agg({"seq": "min"}).orderBy("id", "block").collect()
    assert all(x[2] < y[2] for x, y in zip(spans, spans[1:]) if x[0] == y[0])
    placed = skew.positions(df, ["id"], ["seq"], large=large)
    assert placed.filter("before <> seq div 2 OR group_total <> 1000").count() == 0
