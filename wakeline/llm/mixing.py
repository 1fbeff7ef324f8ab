"""Mixing sources to target weights: hash-random order, prefix sums, one cut per source.

Every row gets a random key from a hash of its identity. Within a source the
rows in key order are taken until the source's budget of words is used up;
budgets above the source repeat it in whole epochs first. Prefix sums run over
ranges of the key and then inside the one range that holds the cut, so a source
is described by one threshold key, and no row has to be moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wakeline.llm.common import broadcast_if, words
from wakeline.operators import skew

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
# Ranges of the 63-bit key for the first level of prefix sums.
RANGE_BITS = 14
# Sources up to this number are joined by broadcast (some 10 MB); more by a shuffle.
MAX_BROADCAST_SOURCES = 100_000


def text_size(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.size(words(text)).cast("bigint")


def random_key(*columns, seed: int = 0) -> Column:
    """A non-negative 63-bit hash of the columns; equal rows have equal keys."""
    return F.xxhash64(*columns, F.lit(seed)).bitwiseAND(F.lit((1 << 63) - 1).cast("bigint"))


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS, share: float = 1.0) -> DataFrame:
    """The word budget of each source: (source, source_size) -> + weight, target.

    Sources in code point order, null last, take the weights in turn and share
    `share` of all words. No target passes max_epochs times its source; what is
    over is shared again by weight. Only three numbers a step reach the driver.
    """
    ranked = skew.positions(sizes.withColumn("_all", F.lit(0)), ["_all"],
                            [F.col("source").isNull(), "source"])
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("before") % len(weights) + 1).cast("int"))
    table = skew.settle(ranked.select("source", "source_size", turn.cast("bigint").alias("weight"),
                                      (F.col("source_size") * max_epochs).alias("_cap")))
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("_cap")
        capped, free, count = table.agg(
            F.sum(F.when(over, F.col("_cap")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))),
            F.sum(over.cast("int"))).first()
        if not free or count == full:
            break
        level, full = (total - capped) / free, count
    target = F.when(over, F.col("_cap").cast("double")).otherwise(F.col("weight") * F.lit(level))
    return table.select("source", "source_size", "weight", target.cast("double").alias("target"))


def plan(rows: DataFrame, **settings) -> DataFrame:
    """One row per source of (source, size, key) rows: source_size, target, epochs, cut_key.

    A row is taken `epochs` times, and once more if its key is at most cut_key.
    The row over the budget is taken if more than half of it fits, so a source
    misses its target by half a row at most. Rows of equal key go together.
    """
    sized = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), **settings)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sized = skew.settle(sized.withColumn("epochs", epochs.cast("bigint")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    shift = 63 - RANGE_BITS
    ranged = rows.withColumn("range", F.shiftright("key", shift))
    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (ranged.groupBy("source", "range").agg(F.sum("size").alias("mass"))
            .withColumn("before", F.coalesce(F.sum("mass").over(ahead), F.lit(0))))
    some = broadcast_if(sized.select(F.col("source").alias("_source"), "rest"), MAX_BROADCAST_SOURCES)
    cut = skew.settle(sums.join(some, F.col("source").eqNullSafe(F.col("_source")))
                      .filter((F.col("rest") > 0) & (F.col("before") <= F.col("rest")) & (F.col("before") + F.col("mass") > F.col("rest")))
                      .select("_source", F.col("range").alias("_range"), "before", "rest"))
    inside = (ranged.join(broadcast_if(cut, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("_source"))
                          & (F.col("range") == F.col("_range")))
              .groupBy("source", "before", "rest", "key").agg(F.sum("size").alias("mass")))
    earlier = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = (inside.withColumn("start", F.col("before") + F.coalesce(F.sum("mass").over(earlier), F.lit(0)))
            .filter(F.col("start") * 2 + F.col("mass") <= F.col("rest") * 2)
            .groupBy("source").agg(F.max("key").alias("last_key")))
    edges = (cut.join(last, cut["_source"].eqNullSafe(last["source"]), "left")
             .select("_source", F.coalesce("last_key", F.shiftleft("_range", shift) - 1).alias("cut_key")))
    return skew.settle(sized.join(edges, F.col("source").eqNullSafe(F.col("_source")), "left")
                       .select("source", "source_size", "target", "epochs",
                               F.coalesce("cut_key", F.lit(-1).cast("bigint")).alias("cut_key")))


def mix(df: DataFrame, text: str = "text", source: str = "source", identity=("doc_id",), seed: int = 0,
        **settings) -> DataFrame:
    """Adds `_mix`: struct(size, source_size, target, times), times being how often the mix takes a row.

    A null source is a source of its own; a null or empty text has size 0. Rows
    equal in identity and text are taken or left together. Any other columns
    are carried along, but for one of that name.
    """
    identity = list(identity)
    key, size = random_key(*identity, text, seed=seed), text_size(F.col(text))
    narrow = skew.settle(df.select(F.col(source).alias("source"), size.alias("size"), key.alias("key")))
    chosen = broadcast_if(plan(narrow, **settings).withColumnRenamed("source", "planned"), MAX_BROADCAST_SOURCES)
    # The row is kept in one column, so that none of its names can clash.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "_mix"]).alias("row"),
                     F.col(source).alias("source"), size.alias("size"), key.alias("key"))
    times = F.col("epochs") + F.when(F.col("key") <= F.col("cut_key"), 1).otherwise(0)
    return rows.join(chosen, F.col("source").eqNullSafe(F.col("planned")), "left").select(
        "row.*", F.struct("size", "source_size", "target", times.cast("bigint").alias("times")).alias("_mix"))


def repeat(mixed: DataFrame, columns) -> DataFrame:
    """The mix itself: every row as often as it is taken."""
    copies = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("_mix.times")), lambda _: F.lit(0))
    return mixed.filter(F.col("_mix.times") > 0).select(*columns, F.explode(copies).alias("_mix")).drop("_mix")
