"""Hand-made tracks for the rules that are easy to get wrong."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from wakeline.functions import scalars as S
from wakeline.operators import metrics, model, motion, places, stats, text
from wakeline.operators.stats import Stat
from wakeline.sources import tracks

SCHEMA = ("id bigint, seq bigint, ts timestamp_ntz, lat double, lon double, speed double, "
          "direction int, type string")
START = dt.datetime(2019, 1, 1)


def pings(spark, *rows):
    """Rows of (id, minutes, lat, lon, speed, direction)."""
    return spark.createDataFrame(
        [(i, n, START + dt.timedelta(minutes=m), lat, lon, speed, direction, "trawl")
         for n, (i, m, lat, lon, speed, direction) in enumerate(rows)], SCHEMA)


def test_single_ping(spark):
    p = pings(spark, (1, 0, 30.0, 120.0, 0.5, 10))
    c = motion.with_changes(motion.with_motion(p))
    row = c.select("lat_diff", "gap_minutes", "anchored", "position_changed",
                   motion.gradient("lat").alias("g")).first()
    assert row == (None, None, 0, True, None)
    assert motion.steps(motion.with_motion(p)).count() == 0
    out = stats.stat_block(p, [Stat("s", "lat", "std"), Stat("q", "lat", "q", 0.9)]).first()
    assert out["s"] is None and out["q"] == 30.0
    top = places.top_places(p).first()
    assert top["rank1_mode_cnt"] == 1 and top["rank2_mode_lat"] is None


def test_empty_mask_is_missing_not_zero(spark):
    p = stats.with_masks(pings(spark, (1, 0, 30.0, 120.0, 5.0, 1), (1, 1, 31.0, 121.0, 6.0, 1)))
    wanted = [Stat("n", "lat", "count", mask="stopped"), Stat("u", "lat", "nunique", mask="stopped"),
              Stat("q", "lat", "q", 0.5, "stopped"), Stat("all", "lat", "nunique")]
    for limit in (1, 100):
        row = stats.stat_block(p, wanted, limit=limit).first()
        assert (row["n"], row["u"], row["q"], row["all"]) == (None, None, None, 2)


def test_missing_values_are_skipped(spark):
    p = stats.with_masks(pings(spark, (1, 0, None, 120.0, 5.0, 1), (1, 1, 31.0, 121.0, 0.0, 1),
                               (1, 2, 33.0, 121.0, 0.0, 1)))
    wanted = [Stat("q", "lat", "q", 0.5), Stat("u", "lat", "nunique"), Stat("m", "lat", "q", 0.5, "moving"),
              Stat("mu", "lat", "nunique", mask="moving")]
    for limit in (1, 100):
        row = stats.stat_block(p, wanted, limit=limit).first()
        assert (row["q"], row["u"], row["m"], row["mu"]) == (32.0, 2, None, 0)


def test_infinite_values_in_quantiles(spark):
    p = pings(spark, (1, 0, 1.0, 1.0, 1.0, 1), (1, 1, 2.0, 1.0, math.inf, 1), (1, 2, 2.0, 1.0, math.inf, 1))
    for limit in (1, 100):
        row = stats.stat_block(p, [Stat("a", "speed", "q", 0.0), Stat("b", "speed", "q", 0.5),
                                   Stat("c", "speed", "q", 0.9)], limit=limit).first()
        assert (row["a"], row["b"], row["c"]) == (1.0, math.inf, math.inf)


def test_tied_modes(spark):
    p = stats.with_masks(pings(spark, *[(1, m, v, 1.0, v, 1) for m, v in enumerate([1.0, 1.0, 2.0, 2.0, 7.0])]))
    row = places.mode_block(p, [("mean", "lat", None, "mean"), ("small", "speed", "nonzero", "min")]).first()
    assert (row["mean"], row["small"]) == (1.5, 1.0)


def test_mode_of_nothing(spark):
    p = stats.with_masks(pings(spark, (1, 0, 1.0, 1.0, 0.0, 1)))
    assert places.mode_block(p, [("lat", "lat", None, "mean"), ("small", "speed", "nonzero", "min")]) \
        .first()["small"] is None


def test_gap_drops_whole_days(spark):
    p = pings(spark, (1, 0, 1.0, 1.0, 0.0, 0), (1, 24 * 60 + 5, 1.0, 1.0, 0.0, 0))
    rows = motion.with_changes(motion.with_motion(p)).orderBy("ts").collect()
    assert [r["gap_minutes"] for r in rows] == [None, 5]
    assert [r["anchored"] for r in rows] == [0, 1]


def test_anchor_uses_signed_differences(spark):
    p = pings(spark, (1, 0, 5.0, 1.0, 0.0, 0), (1, 1, 4.0, 1.0, 0.0, 0))
    assert motion.with_changes(motion.with_motion(p)).agg(F.sum("anchored")).first()[0] == 1


def test_position_mask_looks_at_latitude_only(spark):
    p = pings(spark, (1, 0, 5.0, 1.0, 0.0, 0), (1, 1, 5.0, 2.0, 0.0, 0))
    rows = motion.with_changes(motion.with_motion(p)).orderBy("ts").collect()
    assert [r["position_changed"] for r in rows] == [True, False]


def test_zero_denominators(spark):
    same = motion.steps(motion.with_motion(pings(spark, (1, 0, 5.0, 1.0, 1.0, 0), (1, 0, 5.0, 1.0, 1.0, 0)))).first()
    assert same["slope"] == 0.0 and same["step_speed"] is None
    jump = motion.with_motion(pings(spark, (1, 0, 5.0, 1.0, 1.0, 0), (1, 0, 6.0, 1.0, 1.0, 0)))
    assert motion.steps(jump).first()["step_speed"] == math.inf
    assert motion.steps(jump, infinite=False).first()["step_speed"] is None


def test_steps_need_complete_rows(spark):
    p = pings(spark, (1, 0, 1.0, 1.0, 1.0, 0), (1, 1, None, 1.0, 1.0, 0), (1, 2, 2.0, 1.0, 1.0, 0),
              (1, 3, 3.0, 1.0, 1.0, 0))
    assert [r["seq"] for r in motion.steps(motion.with_motion(p)).collect()] == [3]


def test_step_order_by_file_position(spark):
    p = pings(spark, (1, 10, 1.0, 1.0, 1.0, 10), (1, 0, 3.0, 1.0, 0.0, 50))
    by_file = motion.steps(motion.with_motion(p, ("seq",))).first()
    by_time = motion.steps(motion.with_motion(p)).first()
    assert (by_file["seq"], by_time["seq"]) == (1, 0)
    assert by_file["step_speed"] == pytest.approx(by_time["step_speed"]) == pytest.approx(12.0)


def test_negative_zero_in_gradient_text(spark):
    p = pings(spark, (1, 0, 1.0, 1.0, 1.0, 0), (1, 1, 1.0, 0.99998, 1.0, 0), (1, 2, 1.0, 0.99996, 1.0, 0))
    words = motion.with_motion(p).select("id", "ts", motion.gradient_text().alias("text"))
    assert {r["text"] for r in words.collect()} == {"0.0_-0.0"}
    assert [(r["token"], r["n"]) for r in text.token_counts(words).collect()] == [("0_", 3)]


def test_number_text(spark):
    values = [0.0, -0.0, 39.5, 118.0, 0.0001, 0.00025, 1e-05, 2.5e-07, 12345678.5, -0.0003, 123456789012345.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", S.float_text("v").alias("t"))
    assert [r["t"] for r in rows.collect()] == [repr(v) for v in values]


def test_rounding_on_the_binary_value(spark):
    values = [2.675, 1.0005, 0.0005, 0.0015, 0.0625, 39.1235, 118.4995, -2.6755, 7.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 3):
        got = rows.select("v", S.round_half_exact("v", digits).alias("r")).collect()
        assert [r["r"] for r in got] == [round(v, digits) for v in values]


def test_tokens(spark):
    row = spark.createDataFrame([("39.123_118.5 wtw3S0z a",)], "t string").select(S.col("t"), text.tokens("t").alias("k")).first()
    assert row["k"] == ["39", "123_118", "wtw3s0z"]


def test_bins(spark):
    rows = spark.createDataFrame([(v,) for v in (4.0, 4.1, 10.0, 18.0, 50.0, 50.1, None, math.nan)], "speed double")
    assert [r[0] for r in rows.select(S.speed_bin()).collect()] == [
        "low", "median-low", "median-low", "median", "high", "very-high", "very-high", "very-high"]
    turns = spark.createDataFrame([(v,) for v in (45, -90, 135, 180, 181)], "a int")
    assert [r[0] for r in turns.select(S.turn_bin("a")).collect()] == ["small", "medium", "large", "reverse", "other"]
    assert [r[0] for r in turns.select(S.angle_fold("a")).collect()] == [45, -90, 135, 180, 179]


def bisected(lat, lon, precision):
    """Reference geohash by halving intervals."""
    spans, bits = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}, ""
    for i in range(5 * precision):
        span, value = spans[i % 2], (lon, lat)[i % 2]
        middle = sum(span) / 2
        upper = value > middle
        span[0 if upper else 1] = middle
        bits += "1" if upper else "0"
    return "".join(S.GEOHASH_ALPHABET[int(bits[i:i + 5], 2)] for i in range(0, len(bits), 5))


def test_geohash_edges(spark):
    points = [(0.0, 0.0), (1e-18, 1e-18), (-1e-18, 0.0), (90.0, 180.0), (-90.0, -180.0), (200.0, -400.0),
              (math.nan, 5.0), (math.nextafter(11.25, 99), math.nextafter(22.5, 0)), (11.25, 22.5), (38.99, 121.6)]
    rows = spark.createDataFrame(points, "lat double, lon double")
    for precision in (1, 4, 7, 12):
        got = rows.select("lat", "lon", S.geohash(precision=precision).alias("g")).collect()
        assert [r["g"] for r in got] == [bisected(a, b, precision) for a, b in points]
    assert spark.createDataFrame([(None, 1.0)], "lat double, lon double").select(S.geohash()).first()[0] is None


def test_geohash_decodes_to_its_cell(spark):
    points = [(38.99, 121.6), (-33.9, 18.4), (0.1, -0.1)]
    rows = spark.createDataFrame(points, "lat double, lon double")
    for precision in (5, 8):
        cells = rows.withColumn("cell", S.geohash(precision=precision)).select("lat", "lon", "cell").withColumnsRenamed(
            {"lat": "y", "lon": "x"})
        for r in cells.select("y", "x", *[c.alias(n) for n, c in S.geohash_center("cell", precision).items()]).collect():
            assert abs(r["lat"] - r["y"]) <= r["lat_err"] and abs(r["lon"] - r["x"]) <= r["lon_err"]


def test_argmax_first_and_missing(spark):
    rows = spark.createDataFrame([(0.2, 0.4, 0.4), (None, 0.1, 0.9), (0.1, 0.2, 0.7)],
                                 "p_trawl double, p_gill double, p_seine double")
    assert [r["predicted"] for r in metrics.with_prediction(rows).collect()] == ["gill", "trawl", "seine"]


def test_tfidf_rows_have_unit_length(spark):
    p = pings(spark, *[(i % 3, i, 30 + i % 5 / 7, 110 + i % 4 / 9, 1.0, 1) for i in range(60)])
    words = text.CORPORA["place"].words(p)
    w = text.tfidf(text.token_counts(words), text.document_ids(words))
    norms = w.groupBy("id").agg(F.sum(F.col("weight") ** 2).alias("s")).collect()
    assert len(norms) == 3 and all(r["s"] == pytest.approx(1.0) for r in norms)


def test_sample_rounds_half_to_even(spark):
    sizes = {1: 4, 2: 5, 3: 15, 4: 25, 5: 40}
    p = pings(spark, *[(i, m, 1.0, 1.0, 1.0, 1) for i, n in sizes.items() for m in range(n)])
    got = {r["id"]: r["count"] for r in text.sample_rows(p).groupBy("id").count().collect()}
    assert got == {3: 2, 4: 2, 5: 4}


def test_folds_are_balanced(spark):
    ids = spark.range(1003).withColumn("type", F.when(F.col("id") % 3 == 0, "trawl").otherwise("gill"))
    sizes = [r["count"] for r in model.assign_folds(ids).groupBy("fold").count().collect()]
    assert sum(sizes) == 1003 and len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    per_class = model.assign_folds(ids, label="type").groupBy("type", "fold").count().collect()
    for t in ("trawl", "gill"):
        n = [r["count"] for r in per_class if r["type"] == t]
        assert len(n) == 5 and max(n) - min(n) <= 1


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "trawl")], "id int, type string")
    b = spark.createDataFrame([(2,)], "id int")
    assert {tuple(r) for r in tracks.union_tracks(a, b).collect()} == {(1, "trawl"), (2, None)}
