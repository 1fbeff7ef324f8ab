"""The three feature tables: one wide row per vessel.

Each member's pings are prepared once; the numbers_* functions give the columns
that are statistics, the features_* functions add those learned from corpora.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from wakeline.functions import scalars as S
from wakeline.operators import factor, motion, places, stats
from wakeline.operators.prepared import Prepared, prepare
from wakeline.operators.skew import MAX_GROUP_ROWS
from wakeline.operators.stats import Stat
from wakeline.sources.tracks import track_labels

AXES = ["lat", "lon"]
SIGNALS = ["lat", "lon", "speed", "direction"]


def join_features(base: DataFrame, *blocks: DataFrame) -> DataFrame:
    """Left joins on id: a track without a block's rows has NULL there."""
    return reduce(lambda a, b: a.join(b, "id", "left"), blocks, base)


def numbers_a(prepared: Prepared) -> DataFrame:
    """The label and 168 features: counts, stat blocks under three masks, top places."""
    block = stats.stat_block(prepared.pings, [
        Stat("cnt", "id", "rows"), Stat("anchor_cnt", "anchored", "sum"),
        *stats.wide_stats(SIGNALS),
        *stats.wide_stats(SIGNALS, "position_changed", "pos_changed_"),
        *stats.wide_stats(SIGNALS, "speed_changed", "speed_changed_")], large=prepared.large)
    return join_features(
        track_labels(prepared.pings), block.withColumn("anchor_ratio", S.safe_ratio("anchor_cnt", "cnt")),
        places.top_places(prepared.pings))


def features_a(pings: DataFrame, k: int = 30, iterations: int = 20, w2v_rounds: int = 10,
               limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """318 features: numbers_a, geohash, gradient and sample corpora, Word2Vec means."""
    ready = prepare(pings, limit=limit)
    svd = lambda corpus, blocks: factor.svd_features(ready.pings, corpus, k, blocks, iterations, large=ready.large)
    return join_features(
        numbers_a(ready),
        svd("geohash", {"geohash_tfidf": "tfidf", "geohash_count": "count"}),
        svd("gradient", {"gradient_tfidf": "tfidf"}),
        svd("sample", {"sample_tfidf": "tfidf"}),
        factor.word2vec_means(ready.pings, size=30, iterations=w2v_rounds, large=ready.large))


def numbers_b(prepared: Prepared) -> DataFrame:
    """The label and 131 features: deciles under five masks, place diversity."""
    block = stats.stat_block(prepared.pings, [
        *stats.decile_stats(AXES),
        *stats.decile_stats(["speed"], "moving"),
        *stats.decile_stats(AXES, "stopped", "stop_"),
        *stats.direction_stats(),
        *stats.decile_stats(AXES, "north", "direction0_"),
        *stats.decile_stats(AXES, "fast", "speed_high_")], large=prepared.large)
    return join_features(track_labels(prepared.pings), block, places.place_diversity(prepared.pings))


def prepare_b(pings: DataFrame, limit: int = MAX_GROUP_ROWS) -> Prepared:
    """The second member leaves out pings without a valid position before all else."""
    return prepare(pings.filter(S.valid_position()), limit=limit)


def features_b(pings: DataFrame, k: int = 10, iterations: int = 20,
               limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """181 features of the pings with a valid position: numbers_b, coordinate, geohash, slow-speed
    and gradient corpora."""
    ready = prepare_b(pings, limit)
    svd = lambda corpus, prefix: factor.svd_features(
        ready.pings, corpus, k, {prefix: "tfidf"}, iterations, large=ready.large)
    return join_features(
        numbers_b(ready), svd("lat", "svd_lat"), svd("lon", "svd_lon"), svd("geohash", "svd_geohash7"),
        svd("slow_geohash", "low_speed_svd_geohash7"), svd("gradient", "gradient_svd"))


def numbers_c(prepared: Prepared) -> DataFrame:
    """The label and 139 features: whole-track profile, stopped and moving blocks, steps and
    deltas, top places, speed bins."""
    pings, large = prepared.pings, prepared.large
    block = stats.stat_block(pings, [
        *places.whole_track_stats(), *stats.stopped_stats(), *stats.moving_stats(),
        *stats.stop_share_stats()], large=large)
    moves = stats.stat_block(motion.steps(pings), [*stats.step_stats(), *stats.delta_stats()], large=large)
    return join_features(
        track_labels(pings),
        places.with_spreads(block)
        .withColumn("stopped_share", S.safe_ratio("stopped_count", "cnt")).drop("cnt"),
        places.mode_block(pings, places.WHOLE_TRACK_MODES + places.STOPPED_MODES, profiles=["lon"],
                          large=large, by_track=True),
        moves.drop("slope_mean"), places.top_places(pings), stats.speed_bin_pivot(pings))


def features_c(pings: DataFrame, k: int = 30, iterations: int = 20, order=("seq",),
               limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """199 features: numbers_c with steps in file order, place and geohash corpora."""
    ready = prepare(pings, order, limit)
    svd = lambda corpus, blocks: factor.svd_features(ready.pings, corpus, k, blocks, iterations, large=ready.large)
    return join_features(
        numbers_c(ready), svd("place", {"svd_place": "tfidf"}), svd("geohash", {"geohash_count": "count"}))


# Column name parts the second member leaves out of its model.
DROPPED_B = ("lat_lon_cnt", "speed_high")
