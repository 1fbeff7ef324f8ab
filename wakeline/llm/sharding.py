"""Sharding by jump consistent hashing, in SQL functions only.

A key's shard follows from the key and the number of shards alone; there is no
ring or table to keep. When a shard is appended, a key either stays or moves to
the new shard, so 1 / (n + 1) of the keys move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wakeline.operators import skew

LOW = (1 << 32) - 1
# Fixed value: the multiplier of the generator in the published algorithm.
MULTIPLIER = 2862933555777941757
# Jumps made for every key; the few keys that need more go on, see jump_state.
JUMPS = 24


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _step(state: Column, shards: int) -> Column:
    """One jump of the state (shard, next, high, low), where the generator is high * 2^32 + low.

    Spark's bigint product may not overflow, so the product modulo 2^64 is put
    together from parts of 16 and 32 bits.
    """
    high, low = state["high"], state["low"]
    m1, m0 = _long(MULTIPLIER >> 32), _long(MULTIPLIER & LOW)
    p0 = low.bitwiseAND(_long(0xFFFF)) * m0
    p1 = F.shiftright(low, 16) * m0
    bottom = p0 + F.shiftleft(p1.bitwiseAND(_long(0xFFFF)), 16) + 1
    q0 = high.bitwiseAND(_long(0xFFFF)) * m0
    q1 = F.shiftright(high, 16) * m0
    top = (F.shiftright(bottom, 32) + F.shiftright(p1, 16) + low * m1
           + q0 + F.shiftleft(q1.bitwiseAND(_long(0xFFFF)), 16)).bitwiseAND(_long(LOW))
    after = F.floor((state["next"] + 1).cast("double")
                    * (F.lit(float(1 << 31)) / (F.shiftright(top, 1) + 1).cast("double")))
    moved = F.struct(state["next"].alias("shard"), after.cast("bigint").alias("next"),
                     top.alias("high"), bottom.bitwiseAND(_long(LOW)).alias("low"))
    return F.when(state["next"] < shards, moved).otherwise(state)


def jump_state(key: Column, shards: int) -> Column:
    """The state after the last jump: `shard`, and `next`, the shard count at which the key moves.

    A key makes about ln(shards) jumps. JUMPS of them are folded for every key;
    a key that is not done goes on, with as many jumps as there are shards,
    which is the most there can be.
    """
    start = F.struct(_long(-1).alias("shard"), _long(0).alias("next"),
                     F.shiftrightunsigned(key, 32).alias("high"),
                     key.bitwiseAND(_long(LOW)).alias("low"))

    def fold(state, jumps):
        return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), state, lambda s, _: _step(s, shards))

    first = fold(start, min(JUMPS, shards))
    if shards <= JUMPS:
        return first
    return F.transform(F.array(first), lambda s: F.when(s["next"] < shards, fold(s, shards))
                       .otherwise(s)).getItem(0)


def stable_key(df: DataFrame, column: str) -> Column:
    """The 64-bit key of a column: integers are their own, others are hashed; null is key 0."""
    kind = dict(df.dtypes)[column]
    key = F.col(column).cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(column)
    return F.coalesce(key, _long(0))


def assign(df: DataFrame, key: str, shards: int, shard: str = "shard", grown: str | None = None) -> DataFrame:
    """Adds the shard (int, from 0) of every row; `grown` names a column for one shard more.

    Rows of one key share a shard, also when the key is null (it counts as 0).
    Columns of the same names are replaced.
    """
    names = [c for c in df.columns if c not in (shard, grown)]
    state = df.select(*names, jump_state(stable_key(df, key), shards).alias("_jump"))
    columns = [F.col("_jump.shard").cast("int").alias(shard)]
    if grown:
        columns.append(F.when(F.col("_jump.next") == shards, F.lit(shards)).otherwise(F.col("_jump.shard"))
                       .cast("int").alias(grown))
    return state.select(*names, *columns)


def slots(df: DataFrame, shard: str, order) -> DataFrame:
    """Adds `slot`, the gapless number from 0 of a row within its shard along `order`.

    Shards too large for one task are cut into ranges whose row counts are
    summed first. Rows equal in all of `order` are interchangeable. Columns
    called before, group_total or slot are not kept.
    """
    placed = skew.positions(df, [shard], order)
    return placed.withColumn("slot", F.col("before").cast("bigint")).drop("before", "group_total")


def write_shards(df: DataFrame, path: str, shard: str = "shard") -> None:
    """One folder per shard; a hot shard is written by several tasks, each row once."""
    df.write.partitionBy(shard).parquet(path)
