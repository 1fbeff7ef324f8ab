"""Masked per-track statistics in one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from wakeline.functions import scalars as S
from wakeline.operators import selection
from wakeline.operators.skew import MAX_GROUP_ROWS, find_large, settle

ALGEBRAIC = {"min": "min", "max": "max", "mean": "avg", "sum": "sum",
             "std": "stddev_samp", "count": "count"}


@dataclass(frozen=True)
class Stat:
    """One output column: a statistic of `column` over the rows where `mask` holds.

    kind: min max mean sum std count rows nunique, or 'q' with the quantile q
    (median is q 0.5, linear interpolation, exact).
    """

    out: str
    column: str
    kind: str
    q: float | None = None
    mask: str | None = None

    @property
    def holistic(self) -> bool:
        return self.kind in ("q", "nunique")


QUANTILES = (0.1, 0.2, 0.3, 0.4, 0.6, 0.7, 0.8, 0.9)


def wide_stats(columns, mask: str | None = None, prefix: str = "") -> list[Stat]:
    """min, max, mean, median, nunique and eight quantiles of each column."""
    out = []
    for c in columns:
        name = f"{prefix}{c}"
        out += [Stat(f"{name}_{k}", c, k, mask=mask) for k in ("min", "max", "mean")]
        out.append(Stat(f"{name}_median", c, "q", 0.5, mask))
        out.append(Stat(f"{name}_nunique", c, "nunique", mask=mask))
        out += [Stat(f"{name}_q_{round(q * 100)}", c, "q", q, mask) for q in QUANTILES]
    return out


def decile_stats(columns, mask: str | None = None, prefix: str = "") -> list[Stat]:
    """mean, max, min, nunique and the nine deciles of each column."""
    out = []
    for c in columns:
        name = f"{prefix}{c}"
        out += [Stat(f"{name}_{k}", c, k, mask=mask) for k in ("mean", "max", "min")]
        out.append(Stat(f"{name}_nuniq", c, "nunique", mask=mask))
        out += [Stat(f"{name}_q{d}", c, "q", d / 10, mask) for d in range(1, 10)]
    return out


# Wide blocks are written as SQL text: building hundreds of columns call by call
# would take longer than running them.

def _masked(column: str, mask: str | None) -> str:
    return f"`{column}`" if mask is None else f"CASE WHEN `{mask}` THEN `{column}` END"


def _algebraic(stat: Stat) -> Column:
    if stat.kind == "rows":
        text = "count(*)" if stat.mask is None else f"count_if(`{stat.mask}`)"
    else:
        text = f"{ALGEBRAIC[stat.kind]}({_masked(stat.column, stat.mask)})"
    if stat.mask is not None and stat.kind in ("count", "rows"):
        # A count under a mask no row passes is missing, not 0.
        text = f"CASE WHEN count_if(`{stat.mask}`) > 0 THEN {text} END"
    return F.expr(text).alias(stat.out)


def _groups(stats) -> list[tuple[str, str | None]]:
    """Distinct (column, mask) pairs in order of appearance."""
    return list(dict.fromkeys((s.column, s.mask) for s in stats))


def stat_block(pings: DataFrame, stats, key: str = "id", limit: int = MAX_GROUP_ROWS,
               large="find") -> DataFrame:
    """One row per key with every Stat, computed in a single aggregation.

    Quantiles and distinct counts need a track's values in one task, one track
    at a time. That plan serves the tracks of at most `limit` pings; quantiles
    of larger tracks are selected by narrowing histograms and their distinct
    values counted by value, with the same results. `large` is what find_large
    gives for that limit.
    """
    stats = list(stats)
    if not any(s.holistic for s in stats):
        large = None  # the others are pre-aggregated before the shuffle anyway
    elif large == "find":
        large = find_large(pings, [key], limit)
    if large is None:
        return _fused(pings, stats, key)
    return _fused(large.without(pings), stats, key).unionByName(_spread(large.only(pings), stats, key))


def _quantiles(values: str, qs) -> Column:
    """The quantiles of a sorted array column, as an array."""
    low, high = (f"get({values}, CAST({f}(at) AS INT))" for f in ("floor", "ceil"))
    places = f"transform(array({', '.join(f'{q}D' for q in qs)}), q -> q * (size({values}) - 1))"
    return F.expr(f"""transform({places}, at -> CASE WHEN {low} = {high} THEN {low}
        ELSE {low} * (1D - (at - floor(at))) + {high} * (at - floor(at)) END)""")


def _fused(pings: DataFrame, stats, key: str) -> DataFrame:
    """All statistics in one aggregation, for groups known to fit one task.

    Each (column, mask) pair is collected and sorted once; its quantiles and
    distinct count are read off that list. On wide blocks this takes a third
    of the time of a percentile and a set per pair.

    Grouped by hash, Spark holds the lists of up to 128 tracks at once. A key
    under a collation can only be grouped by sorting, and then it holds those
    of one track, so a task's memory does not depend on how many it has.
    """
    pairs = _groups([s for s in stats if s.holistic])
    marks = {m: f"_mark{i}" for i, m in enumerate(dict.fromkeys(m for _, m in pairs if m))}
    aggs = [F.expr(f"count_if(`{m}`)").alias(name) for m, name in marks.items()]
    aggs += [F.expr(f"sort_array(collect_list(CAST({_masked(*pair)} AS DOUBLE)))").alias(f"_list{i}")
             for i, pair in enumerate(pairs)]
    aggs += [_algebraic(s) for s in stats if not s.holistic]
    read, qs_of = [], {}
    for i, pair in enumerate(pairs):
        same = [s for s in stats if s.holistic and (s.column, s.mask) == pair]
        qs_of[i] = sorted({s.q for s in same if s.kind == "q"})
        if qs_of[i]:
            read.append(_quantiles(f"_list{i}", qs_of[i]).alias(f"_q{i}"))
        if any(s.kind == "nunique" for s in same):
            read.append(F.expr(f"CAST(size(array_distinct(_list{i})) AS BIGINT)").alias(f"_n{i}"))
    by = [key, F.expr(f"collate(substr(CAST(`{key}` AS STRING), 1, 0), 'UTF8_LCASE')").alias("_one_by_one")] if pairs else [key]
    grouped = pings.groupBy(*by).agg(*aggs)
    kept = [c for c in grouped.columns if not c.startswith("_list")]
    outs = []
    for s in stats:
        text = f"`{s.out}`"
        if s.holistic:
            i = pairs.index((s.column, s.mask))
            text = f"get(_q{i}, {qs_of[i].index(s.q)})" if s.kind == "q" else f"_n{i}"
            if s.kind == "nunique" and s.mask is not None:
                text = f"CASE WHEN {marks[s.mask]} > 0 THEN {text} END"
        outs.append(f"{text} AS `{s.out}`")
    return grouped.select(*kept, *read).selectExpr(f"`{key}`", *outs)


def value_counts(pings: DataFrame, pairs, key: str = "id") -> DataFrame:
    """(key, pair, value, n): how often each value occurs, per (column, mask) pair.

    Pre-aggregated before the shuffle and spread over (key, pair, value), so a
    large track is never in one task.
    """
    if len(pairs) == 1:
        column, mask = pairs[0]
        rows = pings if mask is None else pings.filter(F.col(mask))
        return (rows.filter(F.col(column).isNotNull())
                .groupBy(key, F.lit(0).alias("pair"), F.col(column).cast("double").alias("value"))
                .agg(F.count(F.lit(1)).alias("n")))
    cells = []
    for i, (column, mask) in enumerate(pairs):
        keep = F.col(column).isNotNull()
        keep = keep if mask is None else keep & F.col(mask)
        cells.append(F.when(keep, F.struct(
            F.lit(i).alias("pair"), F.col(column).cast("double").alias("value"))))
    return (pings.select(key, F.inline(F.array_compact(F.array(*cells))))
            .groupBy(key, "pair", "value").agg(F.count(F.lit(1)).alias("n")))


def _spread(pings: DataFrame, stats, key: str) -> DataFrame:
    """The same columns for tracks of any size; the pings are written once and read in a few passes."""
    holistic = [s for s in stats if s.holistic]
    qs = {pair: sorted({s.q for s in holistic if s.kind == "q" and (s.column, s.mask) == pair}) for pair in _groups(holistic)}
    qs = {pair: q for pair, q in qs.items() if q}
    counted = _groups([s for s in holistic if s.kind == "nunique"])
    marks = {m: f"_mark{i}" for i, m in enumerate(dict.fromkeys(s.mask for s in holistic if s.mask))}
    needed = dict.fromkeys([key, *(s.column for s in stats if s.kind != "rows"), *(s.mask for s in stats if s.mask)])
    rows = settle(pings.select(*needed))
    base = settle(rows.groupBy(key).agg(
        *[F.expr(f"count_if(`{m}`)").alias(name) for m, name in marks.items()],
        *[_algebraic(s) for s in stats if not s.holistic], *selection.range_aggregates(qs)))
    out = base
    if qs:
        bounds = base.select(key, *[c for c in base.columns if c.startswith(("_lo", "_hi"))])
        out = out.join(selection.quantiles(rows, bounds, key, list(qs), list(qs.values())), key, "left")
    if counted:
        out = out.join(selection.distinct_counts(rows, key, counted), key, "left")
    texts = []
    for s in stats:
        text = f"`{s.out}`"
        if s.kind == "q":
            pair = (s.column, s.mask)
            text = f"_quantiles[{list(qs).index(pair)}][{qs[pair].index(s.q)}]"
        elif s.kind == "nunique":
            text = f"coalesce(_distinct[{counted.index((s.column, s.mask))}], 0L)"
            if s.mask is not None:
                text = f"CASE WHEN {marks[s.mask]} > 0 THEN {text} END"
        texts.append(f"{text} AS `{s.out}`")
    return out.selectExpr(f"`{key}`", *texts)


# -- ready-made blocks -------------------------------------------------------

def direction_stats() -> list[Stat]:
    return [Stat("direction_mean", "direction", "mean"), Stat("direction_max", "direction", "max"),
            Stat("direction_min", "direction", "min"), Stat("direction_nuniq", "direction", "nunique")]


def step_stats() -> list[Stat]:
    """Over all steps, and over the steps that arrive moving."""
    out = [Stat(f"step_distance_{k}", "step_distance", k) for k in ("max", "mean", "sum")]
    out.append(Stat("step_distance_median", "step_distance", "q", 0.5))
    out += [Stat(f"slope_{k}", "slope", k) for k in ("max", "mean", "min")]
    out.append(Stat("slope_median", "slope", "q", 0.5))
    for c in ("step_distance", "slope"):
        out += [Stat(f"moving_{c}_{k}", c, k, mask="moving") for k in ("min", "std", "mean")]
        out.append(Stat(f"moving_{c}_median", c, "q", 0.5, "moving"))
    out += [Stat("step_speed_mean", "step_speed", "mean"), Stat("step_speed_median", "step_speed", "q", 0.5)]
    return out


def delta_stats() -> list[Stat]:
    """Over all steps, and over the steps that arrive moving."""
    out = []
    for c in ("direction_delta", "speed_delta"):
        out += [Stat(f"{c}_{k}", c, k) for k in ("max", "mean", "min", "std")]
        out.append(Stat(f"{c}_median", c, "q", 0.5))
        out += [Stat(f"moving_{c}_{k}", c, k, mask="moving") for k in ("min", "std", "mean")]
        out.append(Stat(f"moving_{c}_median", c, "q", 0.5, "moving"))
    return out


def stopped_stats() -> list[Stat]:
    out = []
    for c in ("lat", "lon"):
        out.append(Stat(f"stopped_{c}_median", c, "q", 0.5, "stopped"))
        out += [Stat(f"stopped_{c}_q{round(q * 100)}", c, "q", q, "stopped")
                for q in (0.1, 0.2, 0.3, 0.7, 0.8, 0.9)]
    out.append(Stat("stopped_lat_mean", "lat", "mean", mask="stopped"))
    out += [Stat("stopped_dis_median", "dis", "q", 0.5, "stopped"),
            Stat("stopped_dis_mean", "dis", "mean", mask="stopped"),
            Stat("stopped_dis_q20", "dis", "q", 0.2, "stopped"),
            Stat("stopped_dis_q80", "dis", "q", 0.8, "stopped")]
    return out


def moving_stats() -> list[Stat]:
    out = []
    for c in ("lat", "lon"):
        out += [Stat(f"moving_{c}_mean", c, "mean", mask="moving"),
                Stat(f"moving_{c}_median", c, "q", 0.5, "moving"),
                Stat(f"moving_{c}_std", c, "std", mask="moving")]
    out += [Stat(f"moving_speed_q{round(q * 100)}", "speed", "q", q, "moving")
            for q in (0.15, 0.3, 0.7, 0.85)]
    out += [Stat("moving_speed_min", "speed", "min", mask="moving"),
            Stat("moving_direction_nunique", "direction", "nunique", mask="moving")]
    return out


def stop_share_stats() -> list[Stat]:
    """Count and distinct positions of the stopped pings; `cnt` counts all pings."""
    return [Stat("stopped_count", "id", "rows", mask="stopped"),
            Stat("stopped_lat_nunique", "lat", "nunique", mask="stopped"),
            Stat("stopped_lon_nunique", "lon", "nunique", mask="stopped"), Stat("cnt", "id", "rows")]


def stop_share(pings: DataFrame, limit: int = MAX_GROUP_ROWS, large="find") -> DataFrame:
    """The stopped counts and their share of all pings (input: with_masks)."""
    block = stat_block(pings, stop_share_stats(), limit=limit, large=large)
    return block.withColumn("stopped_share", S.safe_ratio("stopped_count", "cnt"))


def with_masks(pings: DataFrame) -> DataFrame:
    """Boolean activity columns and the distance from the origin."""
    return pings.withColumns({
        "stopped": S.stopped(), "moving": S.moving(), "nonzero": S.nonzero(),
        "north": S.heading_north(), "fast": S.speed_bin() == "high", "dis": S.origin_distance()})


def anchor_ratio(changed: DataFrame) -> DataFrame:
    """Ping count, anchored pings and their ratio (input: with_changes)."""
    return (changed.groupBy("id")
            .agg(F.count(F.lit(1)).alias("cnt"), F.sum("anchored").alias("anchor_cnt"))
            .withColumn("anchor_ratio", S.safe_ratio("anchor_cnt", "cnt")))


def speed_bin_pivot(pings: DataFrame) -> DataFrame:
    """Pings per speed bin (0 where there are none) and each bin's share."""
    names = {b: f"speed_{b.replace('-', '_')}" for b in S.SPEED_BIN_NAMES}
    wide = (pings.withColumn("bin", S.speed_bin())
            .groupBy("id").pivot("bin", list(names)).count().na.fill(0))
    total = sum((F.col(f"`{b}`") for b in names), F.lit(0))
    return wide.select(
        "id", *[F.col(f"`{b}`").alias(f"{n}_cnt") for b, n in names.items()],
        *[S.safe_ratio(F.col(f"`{b}`"), total).alias(f"{n}_ratio") for b, n in names.items()])
