"""Modes, place frequencies and geohash cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wakeline.functions import scalars as S
from wakeline.operators.skew import MAX_GROUP_ROWS, TAG, find_large
from wakeline.operators.stats import Stat, stat_block, value_counts, with_masks


def mode_block(pings: DataFrame, modes, key: str = "id", profiles=(),
               limit: int = MAX_GROUP_ROWS, large="find", by_track: bool = False) -> DataFrame:
    """Modes of several (column, mask) pairs: `modes` is a list of (out, column, mask, how).

    how = 'mean' averages all tied modes, 'min' takes the smallest. Each column
    in `profiles` adds its frequency profile: largest, mean and population
    deviation of how often a value occurs.

    Tracks of at most `limit` pings are shuffled once, as plain rows, and
    counted where they are. The values of larger tracks are counted before the
    shuffle and spread by value, so that none has to be in one task.
    """
    modes = list(modes)
    if large == "find":
        large = find_large(pings, [key], limit)
    pairs = list(dict.fromkeys([(c, m) for _, c, m, _ in modes] + [(c, None) for c in profiles]))
    needed = dict.fromkeys([key, *(c for c, _ in pairs), *(m for _, m in pairs if m)])

    def build(rows):
        # All values with the same frequency fold into one row: no ranking.
        folded = (value_counts(rows, pairs, key).groupBy(key, "pair", "n")
                  .agg(F.avg("value").alias("mean"), F.min("value").alias("min"),
                       F.count(F.lit(1)).alias("vals")))
        texts = []
        for out, c, m, how in modes:
            here = f"pair = {pairs.index((c, m))}"
            texts.append(f"max_by(CASE WHEN {here} THEN {how} END, CASE WHEN {here} THEN n END) AS `{out}`")
        for c in profiles:
            here = f"FILTER (WHERE pair = {pairs.index((c, None))})"
            size, total = f"sum(vals) {here}", f"sum(n * vals) {here}"
            # The sums of whole numbers are exact, so their difference is too.
            dec = "CAST({} AS DECIMAL(12,0))".format
            squares = f"sum({dec('vals')} * {dec('n')} * {dec('n')}) {here}"
            spread = f"{dec(size)} * {squares} - {dec(total)} * {dec(total)}"
            texts += [f"max(n) {here} AS `{c}_freq_max`", f"({total}) / ({size}) AS `{c}_freq_mean`",
                      f"sqrt(CAST({spread} AS DOUBLE)) / ({size}) AS `{c}_freq_std`"]
        return folded.groupBy(key).agg(*[F.expr(t) for t in texts])

    rows = pings.select(*needed)
    if large is not None and TAG in pings.columns:
        rows = pings.select(*needed, TAG)
    together = lambda small: small if by_track else small.repartition(key)
    if large is None:
        return build(together(rows))
    return build(together(large.without(rows))).unionByName(build(large.only(rows)))


def frequency_profile(pings: DataFrame, column: str = "lon", key: str = "id",
                      limit: int = MAX_GROUP_ROWS, large="find") -> DataFrame:
    return mode_block(pings, [], key, [column], limit, large)


def place_counts(pings: DataFrame) -> DataFrame:
    """Pings per exact position of each track."""
    return (pings.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
            .groupBy("id", "lat", "lon").agg(F.count(F.lit(1)).alias("cnt")))


def top_places(pings: DataFrame, k: int = 3) -> DataFrame:
    """The k most frequent positions per track as columns; ties by (lat, lon) ascending.

    The rank filter lets Spark keep k rows per track before the shuffle.
    """
    w = Window.partitionBy("id").orderBy(F.desc("cnt"), "lat", "lon")
    ranked = (place_counts(pings).withColumn("rank", F.row_number().over(w))
              .filter(F.col("rank") <= k))
    cells = [F.max(F.when(F.col("rank") == i, F.col(c))).alias(f"rank{i}_mode_{c}")
             for i in range(1, k + 1) for c in ("lat", "lon", "cnt")]
    return ranked.groupBy("id").agg(*cells)


def place_diversity(pings: DataFrame) -> DataFrame:
    """How many rounded places a track visits, in all and while stopped."""
    per_place = (pings.withColumn("place", S.place_key())
                 .groupBy("id", "place")
                 .agg(F.count("place").alias("n"), F.count_if(S.stopped()).alias("n_stop")))
    seen = F.col("place").isNotNull()
    out = per_place.groupBy("id").agg(
        F.sum("n").alias("destination_cnt"), F.count_if(seen).alias("destination_nuniq"),
        F.nullif(F.sum(F.when(seen, F.col("n_stop"))), F.lit(0)).alias("stop_destination_cnt"),
        F.nullif(F.count_if(seen & (F.col("n_stop") > 0)), F.lit(0)).alias("stop_destination_nuniq"))
    ratio = S.safe_ratio
    return out.withColumns({
        "destination_ratio": ratio("destination_nuniq", "destination_cnt"),
        "destination_freq": ratio("destination_cnt", "destination_nuniq"),
        "stop_destination_ratio": ratio("stop_destination_nuniq", "stop_destination_cnt"),
        "stop_destination_freq": ratio("stop_destination_cnt", "stop_destination_nuniq"),
        "stop_ratio1": ratio("stop_destination_cnt", "destination_cnt"),
        "stop_ratio2": ratio("stop_destination_nuniq", "destination_nuniq")})


def cell_centers(pings: DataFrame, precision: int = 7) -> DataFrame:
    """Pings per geohash cell with the decoded centre, its error and its short text."""
    # Filtering on the inputs: a filter on the cell would compute it twice.
    cells = (pings.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
             .withColumn("cell", S.geohash(precision=precision))
             .groupBy("cell").agg(F.count(F.lit(1)).alias("cnt")))
    parts = S.geohash_center("cell", precision)
    return cells.select("cell", "cnt", *[c.alias(n) for n, c in parts.items()])


def whole_track_stats() -> list[Stat]:
    """The plain statistics of a whole track (input: stats.with_masks)."""
    q = lambda out, c, at, mask=None: Stat(out, c, "q", at, mask)
    out = [q("nonzero_speed_q80", "speed", 0.8, "nonzero"), q("nonzero_speed_q20", "speed", 0.2, "nonzero"),
           q("nonzero_direction_median", "direction", 0.5, "nonzero")]
    for c in ("lat", "lon"):
        out += [Stat(f"{c}_mean", c, "mean"), q(f"{c}_q90", c, 0.9), q(f"{c}_q10", c, 0.1),
                Stat(f"{c}_max", c, "max"), Stat(f"{c}_min", c, "min"), q(f"{c}_median", c, 0.5),
                q(f"{c}_q40", c, 0.4), q(f"{c}_q60", c, 0.6), Stat(f"{c}_nunique", c, "nunique")]
    return out + [
        Stat("dis_mean", "dis", "mean"), Stat("dis_max", "dis", "max"), Stat("dis_min", "dis", "min"),
        q("dis_median", "dis", 0.5), Stat("speed_max", "speed", "max"), Stat("speed_std", "speed", "std"),
        q("speed_q40", "speed", 0.4), q("speed_q60", "speed", 0.6), q("speed_median", "speed", 0.5),
        Stat("direction_max", "direction", "max"), q("direction_median", "direction", 0.5),
        q("direction_q40", "direction", 0.4), q("direction_q60", "direction", 0.6)]


WHOLE_TRACK_MODES = [
    ("nonzero_speed_mode", "speed", "nonzero", "min"), ("lat_mode_mean", "lat", None, "mean"),
    ("lon_mode_mean", "lon", None, "mean"), ("dis_mode_mean", "dis", None, "mean")]
STOPPED_MODES = [("stopped_lat_mode_mean", "lat", "stopped", "mean"),
                 ("stopped_lon_mode_mean", "lon", "stopped", "mean"),
                 ("stopped_dis_mode_mean", "dis", "stopped", "mean")]


def bbox_aspect():
    """Width over height of the bounding box, from lat/lon min and max columns."""
    return ((F.col("lon_max") - F.col("lon_min"))
            / (F.col("lat_max") - F.col("lat_min") + F.lit(0.0001)))


def with_spreads(block: DataFrame) -> DataFrame:
    """Quantile spreads and the bounding-box aspect from the whole-track statistics."""
    spread = {f"{c}_spread": F.col(f"{c}_q60") - F.col(f"{c}_q40")
              for c in ("lat", "lon", "speed", "direction")}
    spread["nonzero_speed_spread"] = F.col("nonzero_speed_q80") - F.col("nonzero_speed_q20")
    return block.withColumns({**spread, "aspect": bbox_aspect()})


def whole_track_profile(pings: DataFrame, limit: int = MAX_GROUP_ROWS, large="find") -> DataFrame:
    """47 statistics of a whole track: modes, quantiles, spreads, frequency profile, aspect."""
    p = with_masks(pings)
    if large == "find":
        large = find_large(pings, ["id"], limit)
    return (with_spreads(stat_block(p, whole_track_stats(), limit=limit, large=large))
            .join(mode_block(p, WHOLE_TRACK_MODES, profiles=["lon"], large=large), "id", "left"))
