"""The members' pings, written once by track, and what reads them."""

import pandas as pd
import pytest

from wakeline.operators import motion, prepared, skew, stats
from wakeline.plans import members
from wakeline.sources import tracks

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pings(spark):
    return skew.settle(tracks.from_events(spark, SF_DIR))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def frame(df):
    pdf = df.toPandas()
    return pdf[sorted(pdf.columns)].sort_values("id").reset_index(drop=True)


def test_small_tracks_are_read_without_an_exchange(pings):
    ready = prepared.prepare(pings, buckets=4)
    assert ready.large is None and "prev" in ready.pings.columns
    block = stats.stat_block(ready.pings, stats.wide_stats(["lat", "speed"], "position_changed"), large=ready.large)
    assert "Exchange" not in plan_of(block)
    assert "Exchange" not in plan_of(stats.stat_block(motion.steps(ready.pings), stats.step_stats(), large=None))


def test_one_exchange_of_the_pings(pings):
    """Whatever a member's numbers need, no plan but the preparation's moves pings."""
    ready = prepared.prepare(pings, buckets=4)
    for numbers in (members.numbers_a, members.numbers_b, members.numbers_c):
        plan = plan_of(numbers(ready))
        # The exchanges left are of groups already counted.
        assert plan.count("Exchange") <= plan.count("partial_") and "Exchange hashpartitioning(id" not in plan


@pytest.mark.parametrize("numbers", [members.numbers_a, members.numbers_b, members.numbers_c])
def test_large_tracks_give_the_same_numbers(pings, monkeypatch, numbers):
    monkeypatch.setattr(skew, "MIN_BLOCK_ROWS", 10)
    small = frame(numbers(prepared.prepare(pings)))
    split = prepared.prepare(pings, limit=65)
    assert 0 < split.large.count < small["id"].nunique()
    pd.testing.assert_frame_equal(small, frame(numbers(split)), check_dtype=False)


def test_nothing(spark, pings):
    assert members.numbers_c(prepared.prepare(pings.limit(0))).collect() == []
