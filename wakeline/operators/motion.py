"""Kinematics of consecutive pings: differences, gaps, gradients, steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wakeline.functions import scalars as S
from wakeline.operators.skew import MAX_GROUP_ROWS, with_neighbours

NEIGHBOUR_COLUMNS = ("ts", "lat", "lon", "speed", "direction")


def with_motion(pings: DataFrame, order=("ts", "seq"), limit: int = MAX_GROUP_ROWS,
                large="find") -> DataFrame:
    """Pings with `prev`/`next` structs, all expressions below read from these."""
    return with_neighbours(pings, NEIGHBOUR_COLUMNS, order, limit=limit, large=large)


def diff(column: str) -> Column:
    return F.col(column) - F.col(f"prev.{column}")


def gap_minutes() -> Column:
    return S.whole_minutes(S.epoch_micros("ts") - S.epoch_micros("prev.ts"))


def with_changes(moved: DataFrame) -> DataFrame:
    """First differences, the gap, the anchor flag and the two change masks."""
    return (moved
            .withColumns({"lat_diff": diff("lat"), "lon_diff": diff("lon"),
                          "speed_diff": diff("speed"), "gap_minutes": gap_minutes()})
            .withColumns({"anchored": S.anchored(), "position_changed": S.changed("lat_diff"),
                          "speed_changed": S.changed("speed_diff")}))


def gradient(column: str) -> Column:
    """Central difference inside the track, one-sided at its ends, NULL for a single ping."""
    before, after, here = F.col(f"prev.{column}"), F.col(f"next.{column}"), F.col(column)
    first, last = F.col("prev").isNull(), F.col("next").isNull()
    return (F.when(first & last, F.lit(None).cast("double"))
            .when(first, after - here).when(last, here - before)
            .otherwise((after - before) / F.lit(2.0)))


def gradient_text(digits: int = 4) -> Column:
    """'{lat}_{lon}' text of the rounded gradients (a negative zero keeps its sign)."""
    lat, lon = (S.float_text(S.round_product(gradient(c), digits)) for c in ("lat", "lon"))
    return F.concat(lat, F.lit("_"), lon)


def steps(moved: DataFrame, infinite: bool = True) -> DataFrame:
    """One row per step: length, slope and speed of the move to this ping, and abs deltas.

    Only complete rows are kept, so a track's first ping has no step. With
    `infinite` a zero denominator gives an infinity as in float division,
    otherwise it gives NULL.
    """
    needed = ["id", *NEIGHBOUR_COLUMNS, *(f"prev.{c}" for c in NEIGHBOUR_COLUMNS)]
    ratio = S.ieee_ratio if infinite else S.safe_ratio
    dlat, dlon = F.col("prev.lat") - F.col("lat"), F.col("prev.lon") - F.col("lon")
    return (moved.filter(" AND ".join(f"{c} IS NOT NULL" for c in needed))
            .withColumns({
                "step_distance": F.sqrt(dlat * dlat + dlon * dlon),
                "slope": F.abs(ratio(dlon, dlat + F.lit(0.001))),
                "step_hours": F.abs(S.calendar_hours("prev.ts") - S.calendar_hours("ts")),
                "direction_delta": F.abs(F.col("prev.direction") - F.col("direction")),
                "speed_delta": F.abs(F.col("prev.speed") - F.col("speed"))})
            .withColumn("step_speed", ratio(F.col("step_distance"), F.col("step_hours")))
            .drop("prev", "next"))
