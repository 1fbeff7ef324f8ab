"""Groups too large for one task.

Per-track windows and exact quantiles need a whole group in one place. That is
the cheapest plan while every group is small, so each group is counted first.
Groups above the limit take another way: they are range-partitioned on
(key, order) into blocks of bounded size, written once to the shared folder so
that every reader sees the same blocks, and blocks exchange only their edges
or their totals.
"""

from __future__ import annotations

import math
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

MAX_GROUP_ROWS = 500_000
# Up to this many large keys are broadcast (some 10 MB); more are joined by a shuffle.
MAX_LARGE_GROUPS = 1_000_000
# Blocks below this size would cost more in tasks than they save.
MIN_BLOCK_ROWS = 10_000
# Range partitions of one split; the driver must hold their bounds and the shuffle's sizes.
MAX_PARTITIONS = 4_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else a local one for local runs."""
    sc = spark.sparkContext
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir())
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="wakeline-"))
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: fixed rows, short lineage."""
    path = f"{shared_folder(df.sparkSession)}/wakeline-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Set by with_neighbours on both of its parts, as a constant: a filter on it
# lets Spark drop the other part instead of computing it and joining.
TAG = "_large"


@dataclass(frozen=True)
class LargeGroups:
    """Keys of the groups above the limit, and how many rows they hold together."""

    keys: tuple[str, ...]
    table: DataFrame
    rows: int
    limit: int
    count: int

    def _side(self) -> DataFrame:
        return F.broadcast(self.table) if self.count <= MAX_LARGE_GROUPS else self.table

    def only(self, df: DataFrame) -> DataFrame:
        if TAG in df.columns:
            return df.filter(F.col(TAG))
        return df.join(self._side(), list(self.keys), "left_semi")

    def without(self, df: DataFrame) -> DataFrame:
        if TAG in df.columns:
            return df.filter(~F.col(TAG))
        return df.join(self._side(), list(self.keys), "left_anti")


def find_large(df: DataFrame, keys, limit: int = MAX_GROUP_ROWS) -> LargeGroups | None:
    """Count every group; None when all of them fit one task."""
    keys = tuple(keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"))
    largest = sizes.agg(F.max("group_rows")).first()[0]
    if largest is None or largest <= limit:
        return None
    found = settle(sizes.filter(F.col("group_rows") > limit))
    rows, count = found.agg(F.sum("group_rows"), F.count(F.lit(1))).first()
    return LargeGroups(keys, found.drop("group_rows"), rows, limit, count)


def split_blocks(df: DataFrame, large: LargeGroups, order) -> DataFrame:
    """Cut the large groups into ordered blocks: adds `block`, ascending along the order.

    Rows are range-partitioned and sorted, and each partition is cut by row
    number, so a block holds at most `limit` rows (MIN_BLOCK_ROWS if that is
    more) however the values are spread and however few partitions there are.
    """
    size = max(large.limit, MIN_BLOCK_ROWS)
    partitions = min(max(2, math.ceil(large.rows / size) * 2), MAX_PARTITIONS)
    ranged = (large.only(df).repartitionByRange(partitions, *large.keys, *order)
              .sortWithinPartitions(*large.keys, *order))
    # The id holds the partition's number above 33 bits for the row's. No column of that name may be replaced.
    row = f"_row_{uuid.uuid4().hex}"
    cut = f"shiftright({row}, 33) * {1 << 33} + ({row} & {(1 << 33) - 1}) div {size}"
    return settle(ranged.withColumn(row, F.monotonically_increasing_id()).withColumn("block", F.expr(cut)).drop(row))


def positions(df: DataFrame, keys, order, weight=None, limit: int = MAX_GROUP_ROWS,
              large: LargeGroups | None | str = "find") -> DataFrame:
    """Adds `before` (weight of the rows earlier in the group) and `group_total`.

    With the default weight of 1 per row, before + 1 is the row number.
    """
    keys, order = list(keys), list(order)
    if large == "find":
        large = find_large(df, keys, limit)
    weight = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")

    def running(rows, part):
        ahead = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(weight).over(ahead), F.lit(0))

    def small(rows):
        return (rows.withColumn("before", running(rows, keys))
                .withColumn("group_total", F.sum(weight).over(Window.partitionBy(*keys))))

    if large is None:
        return small(df)
    blocks = split_blocks(df, large, order)
    part = Window.partitionBy(*keys)
    totals = (blocks.groupBy(*keys, "block").agg(F.sum(weight).alias("block_total"))
              .withColumn("offset", F.coalesce(F.sum("block_total").over(
                  part.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("group_total", F.sum("block_total").over(part))
              .drop("block_total"))
    placed = (blocks.withColumn("inside", running(blocks, [*keys, "block"]))
              .join(totals, [*keys, "block"])
              .withColumn("before", F.col("inside") + F.col("offset"))
              .drop("inside", "offset", "block"))
    return small(large.without(df)).unionByName(placed.select(*df.columns, "before", "group_total"))


def with_neighbours(df: DataFrame, columns, order=("ts", "seq"), key: str = "id",
                    limit: int = MAX_GROUP_ROWS,
                    large: LargeGroups | None | str = "find") -> DataFrame:
    """Adds `prev` and `next`: structs of `columns` from the adjacent pings of the track.

    The struct itself is NULL at the ends of a track. One exchange on the key
    serves both sides; large tracks pass block edges instead, and then a
    column `_large` tells the two kinds apart.
    """
    if large == "find":
        large = find_large(df, [key], limit)
    here = F.struct(*columns)

    def windowed(rows, *part):
        w = Window.partitionBy(*part).orderBy(*order)
        return rows.withColumn("prev", F.lag(here).over(w)).withColumn("next", F.lead(here).over(w))

    if large is None:
        return windowed(df, key)
    blocks = split_blocks(df, large, order)
    place = F.struct(*order)
    along = Window.partitionBy(key).orderBy("block")
    edges = (blocks.groupBy(key, "block")
             .agg(F.min_by(here, place).alias("first"), F.max_by(here, place).alias("last"))
             .select(key, "block", F.lag("last").over(along).alias("edge_prev"),
                     F.lead("first").over(along).alias("edge_next")))
    stitched = (windowed(blocks, key, "block").join(edges, [key, "block"])
                .withColumn("prev", F.coalesce("prev", "edge_prev"))
                .withColumn("next", F.coalesce("next", "edge_next")))
    return (windowed(large.without(df), key).withColumn(TAG, F.lit(False)).unionByName(
        stitched.select(*df.columns, "prev", "next", F.lit(True).alias(TAG))))
