"""Exact quantiles of groups too large for one task, by narrowing histograms.

The values of a group are counted in BINS equal ranges between its smallest and
its largest; only the counts are shuffled. The bin that holds a wanted rank is
known from their running totals. A bin of one value, or a rank at a bin's end,
is settled by the bin's own smallest and largest. The values of the other bins
that are wanted, a few per cent, are read off a sorted list where the bin is
small and counted again in finer bins where it is not. Nothing is sorted or
shuffled as a whole, and no value is written down but those of large bins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from wakeline.operators.skew import settle

BINS = 1024
# Values of a bin that are put into one list.
LIST = 10_000
# Groups whose bounds are broadcast, a few hundred bytes each; more are joined by a shuffle.
MAX_BROADCAST_GROUPS = 50_000

FINITE = "abs({v}) < double('infinity')"


def _by_column(pairs) -> dict[str, list[tuple[int, str | None]]]:
    """The pairs (column, mask) as column -> (pair's number, mask)."""
    out: dict[str, list[tuple[int, str | None]]] = {}
    for i, (column, mask) in enumerate(pairs):
        out.setdefault(column, []).append((i, mask))
    return out


def range_aggregates(pairs) -> list:
    """The finite ends of each column of the pairs, `_lo` and `_hi` with its place among the columns."""
    out = []
    for j, column in enumerate(_by_column(pairs)):
        value = f"CAST(`{column}` AS DOUBLE)"
        out += [F.expr(f"{how}({value}) FILTER (WHERE {FINITE.format(v=value)})").alias(f"_{end}{j}")
                for how, end in (("min", "lo"), ("max", "hi"))]
    return out


def _bin(v: str, lo: str, hi: str) -> str:
    """The bin of a value, 0 and BINS - 1 being for the infinities; the ends fall into different bins."""
    return (f"CASE WHEN {v} = double('-infinity') THEN 0 WHEN {v} = double('infinity') THEN {BINS - 1} WHEN {hi} = {lo} THEN 1 "
            f"WHEN {hi} - {lo} = double('infinity') THEN IF({v} < 0, 1, {BINS - 2}) "
            f"ELSE 1 + least({BINS - 3}, CAST(floor(({v} - {lo}) / ({hi} - {lo}) * {BINS - 2}) AS INT)) END")


def _binned(rows: DataFrame, bounds: DataFrame, few: bool, key: str, column: str, j: int, masks, extra=()) -> DataFrame:
    """(key, bin, value, masks, extra) of a column's values; `extra` are columns of the bounds."""
    ends = bounds.select(key, F.col(f"_lo{j}").alias("_lo"), F.col(f"_hi{j}").alias("_hi"), *extra)
    held = rows.selectExpr(f"`{key}`", f"CAST(`{column}` AS DOUBLE) AS value", *[f"`{m}`" for m in masks]).filter("value IS NOT NULL")
    return held.join(F.broadcast(ends) if few else ends, key).selectExpr(
        f"`{key}`", f"{_bin('value', '_lo', '_hi')} AS bin", "value", *[f"`{m}`" for m in masks], *extra)


def _masks(parts) -> list[str]:
    return list(dict.fromkeys(m for _, m in parts if m is not None))


def _first_histogram(rows: DataFrame, bounds: DataFrame, few: bool, key: str, pairs) -> DataFrame:
    """(key, pair, bin, n, lo, hi) of all pairs: one pass over the rows per column, for all of its masks."""
    parts = []
    for j, (column, own) in enumerate(_by_column(pairs).items()):
        cells = _binned(rows, bounds, few, key, column, j, _masks(own))
        where = {i: "" if m is None else f" FILTER (WHERE `{m}`)" for i, m in own}
        counted = cells.groupBy(key, "bin").agg(*[F.expr(f"{how}{where[i]}").alias(f"{name}{i}") for i, _ in own
                                                  for how, name in (("count(*)", "n"), ("min(value)", "lo"), ("max(value)", "hi"))])
        structs = ", ".join(f"named_struct('pair', {i}, 'n', n{i}, 'lo', lo{i}, 'hi', hi{i})" for i, _ in own)
        parts.append(counted.selectExpr(f"`{key}`", "bin", f"inline(array({structs}))").filter("n > 0"))
    return reduce(DataFrame.unionByName, parts)


def _wanted_cells(rows: DataFrame, narrow: DataFrame, few: bool, key: str, pairs) -> DataFrame:
    """(key, pair, bin, value) of the values in each pair's wanted bins, `_bins` with its number in `narrow`."""
    parts = []
    for j, (column, own) in enumerate(_by_column(pairs).items()):
        cells = _binned(rows, narrow, few, key, column, j, _masks(own), [f"_bins{i}" for i, _ in own])
        hit = {i: f"array_contains(_bins{i}, bin)" + ("" if m is None else f" AND `{m}`") for i, m in own}
        picked = ", ".join(f"CASE WHEN {h} THEN named_struct('pair', {i}) END" for i, h in hit.items())
        parts.append(cells.filter(" OR ".join(f"({h})" for h in hit.values())).selectExpr(
            f"`{key}`", "bin", "value", f"inline(array_compact(array({picked})))"))
    return reduce(DataFrame.unionByName, parts)


def distinct_counts(rows: DataFrame, key: str, pairs) -> DataFrame:
    """(key, _distinct): for each key a map from a pair's number to how many different values it has.

    Values are counted once per column, with a mark for each mask, before and after the shuffle.
    """
    parts = []
    for column, own in _by_column(pairs).items():
        marks = [F.expr("true" if m is None else f"coalesce(max(`{m}`), false)").alias(f"in{i}") for i, m in own]
        values = rows.filter(F.col(column).isNotNull()).groupBy(key, F.col(column).alias("value")).agg(*marks)
        counted = values.groupBy(key).agg(*[F.count_if(f"in{i}").alias(f"n{i}") for i, _ in own])
        structs = ", ".join(f"named_struct('pair', {i}, 'n', n{i})" for i, _ in own)
        parts.append(counted.selectExpr(f"`{key}`", f"inline(array({structs}))"))
    return reduce(DataFrame.unionByName, parts).groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct("pair", "n"))).alias("_distinct"))


def _histogram(cells: DataFrame, *group: str) -> DataFrame:
    return cells.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def _placed(histogram: DataFrame, *group: str) -> DataFrame:
    """Adds `before`, the values in the lower bins of the group; a group has BINS rows at most."""
    lower = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    return histogram.withColumn("before", F.coalesce(F.sum("n").over(lower), F.lit(0)))


# What is settled by a bin's ends, for `offset` counted from the bin's first value.
_SETTLED = "CASE WHEN lo = hi OR offset = 0 THEN lo WHEN offset = n - 1 THEN hi END"


def _listed(cells: DataFrame, open_ranks: DataFrame, *group: str) -> DataFrame:
    """The values of open ranks in small bins, from sorted lists."""
    lists = cells.groupBy(*group, "bin").agg(F.sort_array(F.collect_list("value")).alias("list"))
    return open_ranks.join(lists, [*group, "bin"]).withColumn("value", F.expr("get(list, CAST(offset AS INT))")).drop("list")


def _narrowed(cells: DataFrame, open_ranks: DataFrame, key: str) -> list[DataFrame]:
    """The values of open ranks in large bins: each bin is a group of its own, counted in finer bins."""
    group, found = [key, "pair", "part"], []
    part = F.concat_ws(".", "part", "bin").alias("part")
    values = cells.select(key, "pair", part, "value")
    ranks = open_ranks.select(key, "pair", part, "rank", "offset")
    while True:
        values, ranks = settle(values), settle(ranks)
        if ranks.isEmpty():
            return found
        ends = values.groupBy(*group).agg(
            F.expr(f"min(value) FILTER (WHERE {FINITE.format(v='value')})").alias("_lo"),
            F.expr(f"max(value) FILTER (WHERE {FINITE.format(v='value')})").alias("_hi"))
        finer = settle(values.join(ends, group).selectExpr(*group, f"{_bin('value', '_lo', '_hi')} AS bin", "value"))
        placed = _placed(_histogram(finer, *group), *group)
        hit = settle(ranks.join(placed, group).filter("offset >= before AND offset < before + n")
                     .withColumn("offset", F.col("offset") - F.col("before")).withColumn("value", F.expr(_SETTLED)))
        left = hit.filter("value IS NULL").drop("value")
        found += [hit.filter("value IS NOT NULL").select(key, "pair", "rank", "value")]
        small, large = left.filter(F.col("n") <= LIST), left.filter(F.col("n") > LIST)
        wanted = [*group, "bin"]
        found.append(_listed(finer.join(small.select(*wanted).distinct(), wanted, "left_semi"), small, *group)
                     .select(key, "pair", "rank", "value"))
        values = finer.join(large.select(*wanted).distinct(), wanted, "left_semi").select(*group[:2], part, "value")
        ranks = large.select(*group[:2], part, "rank", "offset")


def quantiles(rows: DataFrame, bounds: DataFrame, key: str, pairs, qs) -> DataFrame:
    """(key, _quantiles): for each key a map from the number of a pair to its quantiles.

    A pair is (column, mask or None). `rows` is a written table; `bounds` has
    the range_aggregates of the pairs by key, written too. `qs` lists for each
    pair the quantiles wanted, linear between the two values around them. A pair
    without values has no entry.
    """
    few = bounds.limit(MAX_BROADCAST_GROUPS + 1).count() <= MAX_BROADCAST_GROUPS
    wanted = "get(array({}), pair)".format(", ".join(f"array({', '.join(f'{q}D' for q in x)})" for x in qs))
    first = settle(_first_histogram(rows, bounds, few, key, pairs))
    total = F.sum("n").over(Window.partitionBy(key, "pair"))
    both = f"flatten(transform({wanted}, q -> array(floor(q * (total - 1)), ceil(q * (total - 1)))))"
    hit = settle(_placed(first, key, "pair").withColumn("total", total).selectExpr(
        "*", f"explode(array_distinct(filter({both}, r -> r >= before AND r < before + n))) AS rank")
        .withColumn("offset", F.col("rank") - F.col("before")).withColumn("value", F.expr(_SETTLED)))
    found = [hit.filter("value IS NOT NULL").select(key, "pair", "rank", "value")]
    left = hit.filter("value IS NULL").select(key, "pair", "bin", "n", "rank", "offset")
    if not left.isEmpty():
        lists = [F.expr(f"collect_set(bin) FILTER (WHERE pair = {i})").alias(f"_bins{i}") for i in range(len(qs))]
        narrow = settle(bounds.join(left.groupBy(key).agg(*lists), key))
        cells = _wanted_cells(rows, narrow, few, key, pairs)
        small, large = left.filter(F.col("n") <= LIST), left.filter(F.col("n") > LIST)
        bin_key = [key, "pair", "bin"]
        if large.isEmpty():
            found.append(_listed(cells, small, key, "pair").select(key, "pair", "rank", "value"))
        else:
            cells = settle(cells)
            in_large = large.select(*bin_key).distinct()
            found.append(_listed(cells.join(in_large, bin_key, "left_anti"), small, key, "pair").select(key, "pair", "rank", "value"))
            found += _narrowed(cells.join(in_large, bin_key, "left_semi").withColumn("part", F.lit("")),
                               large.withColumn("part", F.lit("")), key)
    totals = first.groupBy(key, "pair").agg(F.sum("n").alias("total"))
    ranked = (reduce(DataFrame.unionByName, found).groupBy(key, "pair")
              .agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at")))  # two ranks a quantile
    low, high = "at[floor(p)]", "at[ceil(p)]"
    return (ranked.join(totals, [key, "pair"]).selectExpr(f"`{key}`", "pair", f"""transform(transform({wanted}, q -> q * (total - 1)),
        p -> CASE WHEN {low} = {high} THEN {low} ELSE {low} * (1D - (p - floor(p))) + {high} * (p - floor(p)) END) AS q""")
            .groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("pair", "q"))).alias("_quantiles")))
