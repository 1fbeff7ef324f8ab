"""Pings with all that a member's features read, written once by track.

The small tracks stand in a table bucketed by track, so windows, aggregations
and joins by track read it without an exchange. The pings of large tracks stand
in a plain table beside it, as a bucket could not be split among tasks.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from wakeline.operators import motion, stats
from wakeline.operators.skew import MAX_GROUP_ROWS, TAG, LargeGroups, find_large, settle, shared_folder


@dataclass(frozen=True)
class Prepared:
    """Pings with neighbours, changes and masks, and the tracks among them that are too large for one task."""

    pings: DataFrame
    large: LargeGroups | None


def bucketed(df: DataFrame, buckets: int, key: str = "id") -> DataFrame:
    """Write a table bucketed by key to the shared folder and read it back.

    The table's entry in the session's catalog and its files are left behind.
    """
    name = f"wakeline_{uuid.uuid4().hex}"
    (df.write.bucketBy(buckets, key).option("path", f"{shared_folder(df.sparkSession)}/{name}").format("parquet")
     .saveAsTable(name))
    return df.sparkSession.table(name)


def prepare(pings: DataFrame, order=("ts", "seq"), limit: int = MAX_GROUP_ROWS, buckets: int | None = None) -> Prepared:
    """Lags, leads, changes and masks of every ping; one exchange of the pings for all that follows.

    `buckets` is the number of tasks that read the table, the number of shuffle
    partitions if not given.
    """
    buckets = buckets or int(pings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = find_large(pings, ["id"], limit)

    def enriched(rows, large):
        return stats.with_masks(motion.with_changes(motion.with_motion(rows, order, limit, large)))

    small = pings if large is None else large.without(pings)
    table = bucketed(enriched(small.repartition(buckets, "id"), None), buckets)
    if large is None:
        return Prepared(table, None)
    rest = settle(enriched(pings, large).filter(F.col(TAG)).drop(TAG))
    # The tag is a constant on either side, so that a filter on it drops the other side.
    return Prepared(table.withColumn(TAG, F.lit(False)).unionByName(rest.withColumn(TAG, F.lit(True))), large)
