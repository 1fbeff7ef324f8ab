"""One track with a third of all rows: the same results by the other way."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wakeline.operators import motion, places, skew, stats, text
from wakeline.sources import tracks

LIMIT = 200


@pytest.fixture(scope="module")
def skewed(spark):
    """40 tracks of 60 rows and one of 1,300 rows, with repeated times and missing values."""
    sizes = [(i, 60) for i in range(40)] + [(99, 1300)]
    rng = np.random.default_rng(5)
    parts, seq = [], 0
    for i, n in sizes:
        parts.append(pd.DataFrame({
            "id": i, "seq": np.arange(seq, seq + n),
            "ts": pd.Timestamp("2019-03-01") + pd.to_timedelta(np.sort(rng.integers(0, 4 * n, n)) // 3, unit="m"),
            "lat": np.round(rng.uniform(30, 31, n), 2), "lon": np.round(rng.uniform(120, 121, n), 3),
            "speed": np.round(rng.exponential(3, n), 1), "direction": rng.integers(0, 360, n), "type": "trawl"}))
        seq += n
    pdf = pd.concat(parts)
    df = spark.createDataFrame(pdf).select(
        "id", "seq", F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.when(F.col("seq") % 17 != 0, F.col("lat")).alias("lat"), "lon", "speed",
        F.col("direction").cast("int").alias("direction"), "type")
    return skew.settle(df)


def frame(df, *by):
    pdf = df.toPandas()
    return pdf[sorted(pdf.columns)].sort_values(list(by)).reset_index(drop=True)


def same(a, b, *by):
    pd.testing.assert_frame_equal(frame(a, *by), frame(b, *by), check_dtype=False)


def test_large_group_is_found(skewed):
    large = skew.find_large(skewed, ["id"], LIMIT)
    assert [r["id"] for r in large.table.collect()] == [99] and large.rows == 1300
    assert skew.find_large(skewed, ["id"], 5000) is None


def test_blocks_are_bounded_and_ordered(skewed, monkeypatch):
    monkeypatch.setattr(skew, "MIN_BLOCK_ROWS", 100)
    blocks = skew.split_blocks(skewed, skew.find_large(skewed, ["id"], LIMIT), ["ts", "seq"])
    rows = blocks.groupBy("block").agg(F.count("*").alias("n"), F.min("seq").alias("a"), F.max("seq").alias("b"))
    rows = rows.orderBy("block").collect()
    assert len(rows) > 5 and max(r["n"] for r in rows) <= 2 * LIMIT
    assert all(x["b"] < y["a"] for x, y in zip(rows, rows[1:]))


def test_neighbours(skewed, monkeypatch):
    monkeypatch.setattr(skew, "MIN_BLOCK_ROWS", 20)
    pick = lambda df: motion.with_changes(df).select(
        "id", "seq", "lat_diff", "lon_diff", "gap_minutes", "anchored", "position_changed",
        motion.gradient("lon").alias("g"), motion.gradient_text().alias("t"))
    same(pick(motion.with_motion(skewed)), pick(motion.with_motion(skewed, limit=LIMIT)), "id", "seq")


def test_statistics(skewed, monkeypatch):
    monkeypatch.setattr(skew, "MIN_BLOCK_ROWS", 20)
    p = stats.with_masks(skewed)
    wanted = (stats.wide_stats(["lat", "lon", "speed"]) + stats.decile_stats(["lat"], "stopped", "s_")
              + stats.moving_stats() + stats.stop_share_stats())
    same(stats.stat_block(p, wanted), stats.stat_block(p, wanted, limit=LIMIT), "id")


def test_statistics_against_pandas(skewed):
    pdf = skewed.toPandas()
    got = frame(stats.stat_block(skewed, stats.wide_stats(["lat", "speed"]), limit=LIMIT), "id").set_index("id")
    for c in ("lat", "speed"):
        g = pdf.groupby("id")[c]
        np.testing.assert_allclose(got[f"{c}_q_30"], g.quantile(0.3), rtol=1e-12)
        np.testing.assert_allclose(got[f"{c}_median"], g.median(), rtol=1e-12)
        assert (got[f"{c}_nunique"] == g.nunique()).all()


def test_steps_and_modes_against_pandas(skewed):
    pdf = skewed.toPandas()
    modes = frame(places.mode_block(stats.with_masks(skewed), [("m", "lat", None, "mean")]), "id").set_index("id")["m"]
    np.testing.assert_allclose(modes, pdf.groupby("id")["lat"].agg(lambda x: x.mode().mean()), rtol=1e-12)


def test_sample_and_sequence(skewed, monkeypatch):
    monkeypatch.setattr(skew, "MIN_BLOCK_ROWS", 20)
    same(text.sample_rows(skewed), text.sample_rows(skewed, limit=LIMIT), "id", "seq")
    again = skewed.withColumnRenamed("seq", "old")
    same(tracks.with_seq(again, ("ts", "old")), tracks.with_seq(again, ("ts", "old"), LIMIT), "id", "old")


def test_documents_are_cut(skewed, monkeypatch):
    monkeypatch.setattr(skew, "MIN_BLOCK_ROWS", 20)
    words = skewed.select("id", "ts", "seq", F.col("speed").cast("string").alias("text"))
    a = text.token_documents(words, chunk=100)
    same(a, text.token_documents(words, chunk=100, limit=LIMIT), "id", "part")
    assert a.filter("id = 99").count() == 13


def test_results_do_not_depend_on_partitions(spark, skewed):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        two = frame(places.whole_track_profile(skewed), "id")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    pd.testing.assert_frame_equal(two, frame(places.whole_track_profile(skewed), "id"))
