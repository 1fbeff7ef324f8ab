"""Ping tables: readers, the canonical schema, and the view over `events`."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline.functions import scalars as S
from wakeline.operators.skew import MAX_GROUP_ROWS, positions, settle

PING_COLUMNS = ("id", "seq", "ts", "lat", "lon", "speed", "direction", "type")

# The header of a labelled source file, in file order.
FILE_COLUMNS = {"渔船ID": "bigint", "lat": "double", "lon": "double", "速度": "double",
                "方向": "int", "time": "string", "type": "string"}


# What opening a file counts as when files are packed into tasks, in bytes. It takes as long as parsing 15 KB of CSV
# on a local disk, and longer elsewhere; Spark's 4 MB makes a task, and a written file, of every 32 vessels.
OPEN_COST = 64 << 10

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, value double, props string"


def _file_schema(labelled: bool) -> str:
    names = list(FILE_COLUMNS)[: None if labelled else -1]
    return ", ".join(f"`{n}` {FILE_COLUMNS[n]}" for n in names)


def _settle_files(raw: DataFrame) -> DataFrame:
    """settle, with files packed into tasks by OPEN_COST unless the session's cost is lower."""
    conf, name = raw.sparkSession.conf, "spark.sql.files.openCostInBytes"
    old = conf.get(name, None)
    cost = raw.sparkSession._jsparkSession.sessionState().conf().filesOpenCostInBytes()
    conf.set(name, str(min(cost, OPEN_COST)))
    try:
        return settle(raw)
    finally:
        conf.set(name, old) if old is not None else conf.unset(name)


def read_tracks(spark: SparkSession, path: str, labelled: bool = True, year: int = 2019,
                id_from_file: bool = False, limit: int = MAX_GROUP_ROWS) -> DataFrame:
    """Every CSV under `path` (one file per vessel, header row) as canonical pings.

    Columns are taken by position. `seq` is the number of the row in its file,
    from 0: rows are numbered along the offset of their split and their place
    in the task that reads it, so it doesn't depend on how files are split or
    packed into tasks. Files of over `limit` rows are numbered in blocks. The
    files are opened once: what is parsed is written to the shared folder, and
    counted and numbered from there.
    """
    raw = (spark.read.schema(_file_schema(labelled)).option("header", True)
           .option("enforceSchema", True).csv(path)
           .withColumn("_row", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
           .withColumn("_start", F.col("_metadata.file_block_start"))
           .withColumn("_path", F.col("_metadata.file_path"))
           .withColumn("_file", F.col("_metadata.file_name")))
    raw = positions(_settle_files(raw), ["_path"], ["_start", "_row"], limit=limit)
    name = F.regexp_extract("_file", r"^(\d+)", 1).cast("bigint")
    label = F.coalesce(*[F.when(F.col("type") == t, n) for t, n in S.CLASS_TEXT.items()],
                       F.col("type")) if labelled else F.lit(None).cast("string")
    return raw.select(
        (name if id_from_file else F.col("渔船ID")).alias("id"),
        F.col("before").cast("bigint").alias("seq"),
        S.parse_time("time", year).alias("ts"),
        S.nan_to_null("lat").alias("lat"), S.nan_to_null("lon").alias("lon"),
        S.nan_to_null("速度").alias("speed"), F.col("方向").alias("direction"),
        label.alias("type"))


def read_track_text(spark: SparkSession, path: str, labelled: bool = True, year: int = 2019) -> DataFrame:
    """The same table with unlabelled rows marked 'unknown' instead of NULL."""
    return read_tracks(spark, path, labelled, year).fillna({"type": S.UNLABELLED})


def with_seq(df: DataFrame, order=("ts",), limit: int | None = None) -> DataFrame:
    """Number the rows of each track along `order`, where no file position is known.

    Rows that tie in `order` are numbered by a hash of all their columns; rows
    equal in every column are interchangeable.
    """
    order = (*order, "_tie")
    df = df.withColumn("_tie", F.xxhash64(*df.columns))
    placed = positions(df, ["id"], order, limit=limit or MAX_GROUP_ROWS)
    return placed.withColumn("seq", F.col("before")).drop("before", "group_total", "_tie")


def union_tracks(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def track_labels(pings: DataFrame) -> DataFrame:
    """The label on the first ping of each track."""
    return pings.groupBy("id").agg(F.min_by("type", F.struct("ts", "seq")).alias("type"))


def distinct_tracks(pings: DataFrame) -> DataFrame:
    return pings.select("id", "type").distinct()


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type").isNotNull() & (F.col("type") != S.UNLABELLED))


def unlabelled(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type").isNull() | (F.col("type") == S.UNLABELLED))


def from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `events` table read as pings: dyadic positions and speeds, every fourth user unlabelled."""
    e = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    eighth = lambda factor, base: (
        F.pmod(F.col("event_id") * factor, F.lit(100)).cast("double") / F.lit(8.0) + F.lit(base))
    return e.select(
        F.col("user_id").alias("id"), F.col("event_id").alias("seq"),
        "ts",
        eighth(37, 25.0).alias("lat"), eighth(91, 108.0).alias("lon"),
        (F.floor("value").cast("double") / F.lit(4.0)).alias("speed"),
        (F.get_json_object("props", "$.k").cast("int") * 7 % 360).alias("direction"),
        S.name_at(F.when(F.col("user_id") % 4 < 3, (F.col("user_id") % 4).cast("int"))).alias("type"))
