"""URL filters by a temporal list join, in SQL functions only.

A list is a log of dated entries: a key is added or removed on a date. Entries
become validity intervals, one at a time per key. A capture is judged by the
entries that were active when it was fetched: its own address and each domain
above its host are looked up as of that time, and the most specific one decides.
Intervals and captures meet by key and time slice, so that a key with a long
history or very many captures is spread over its slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Days in a time slice.
SLICE_DAYS = 64


def host(url: Column) -> Column:
    """The lower-case host of an address, without user, port and final dot; empty if there is none."""
    return F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*[^/:?#.])", 1)


def address(url: Column) -> Column:
    """Host and path of an address, without a query: the key of entries for single pages."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.concat(host(url), F.when(path == "", F.lit("/")).otherwise(path))


def lookup_keys(url: Column) -> Column:
    """The keys that can decide on an address, most specific last: domains of two labels and more, the page."""
    labels = F.split(host(url), r"\.")
    first = F.greatest(F.size(labels) - 1, F.lit(1))
    domains = F.transform(F.sequence(first, F.lit(1)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.when(host(url) != "", F.concat(domains, F.array(address(url)))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, date, action) entries as intervals (key, since, until): until is null while an entry stands.

    Of several entries for a key on one date a removal counts. Entries with a
    null key or date are ignored, and so is every action but add and remove.
    """
    known = entries.filter(F.col("key").isNotNull() & F.col("date").isNotNull() & F.col("action").isin("add", "remove"))
    daily = known.groupBy("key", "date").agg(F.max("action").alias("action"))
    following = F.lead("date").over(Window.partitionBy("key").orderBy("date"))
    return (daily.withColumn("until", following).filter(F.col("action") == "add")
            .select("key", F.col("date").alias("since"), "until"))


def _slice(date: Column) -> Column:
    return F.floor(F.unix_date(date) / SLICE_DAYS)


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """Adds `_verdict` to every capture: struct(key, since) of the deciding entry, null if none is active.

    The entry must have been added on or before the fetch date and not been
    removed by then. A null address or fetch date, or an address without a host,
    is never listed. Equal captures get equal verdicts. All columns are kept,
    but for one of that name.
    """
    asked = (captures.select(F.col(url).alias("_url"), F.col(fetched).cast("date").alias("_day"))
             .filter("_url is not null and _day is not null").distinct())
    looked = asked.select("_url", "_day", F.posexplode(lookup_keys(F.col("_url"))).alias("_rank", "key"),
                          _slice(F.col("_day")).alias("slice"))
    bounds = asked.agg(F.min("_day"), F.max("_day")).first()
    listed = intervals(entries)
    if bounds[0] is None:
        return captures.withColumn("_verdict", F.lit(None).cast("struct<key:string,since:date>"))
    first, last = F.lit(bounds[0]), F.lit(bounds[1])
    # Intervals are cut to the days that were asked for, then put into each slice they touch.
    cut = (listed.filter((F.col("since") <= last) & (F.col("until").isNull() | (F.col("until") > first)))
           .withColumn("slice", F.explode(F.sequence(_slice(F.greatest("since", first)),
                                                     _slice(F.least(F.coalesce("until", last), last))))))
    active = (F.col("since") <= F.col("_day")) & (F.col("until").isNull() | (F.col("until") > F.col("_day")))
    best = (looked.join(cut, ["key", "slice"]).filter(active).groupBy("_url", "_day")
            .agg(F.max(F.struct("_rank", "key", "since")).alias("b"))
            .select("_url", "_day", F.struct("b.key", "b.since").alias("_verdict")))
    # The capture is kept in one column, so that none of its names can clash.
    rows = captures.select(F.struct(*[F.col(f"`{c}`") for c in captures.columns if c != "_verdict"]).alias("row"),
                           F.col(url).alias("_address"), F.col(fetched).cast("date").alias("_date"))
    return rows.join(best, (F.col("_address") == F.col("_url")) & (F.col("_date") == F.col("_day")), "left").select("row.*", "_verdict")
