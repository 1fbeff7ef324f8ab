"""A file per vessel: written, and read in few tasks."""

import os

import pytest
from pyspark.sql import functions as F

from wakeline.operators.skew import shared_folder
from wakeline.plans import catalog
from wakeline.sources import sinks, tracks

SF_DIR = "/root/testdata/sf0.001"


def test_vessels_are_written_without_hadoop(spark, tmp_path, monkeypatch):
    """In a local folder: one file a vessel and no checksum beside it, with the bytes that Spark's own writer has."""
    rows = (spark.range(700).withColumn("rank", F.col("id")).selectExpr(
        "nullif(cast(sqrt(rank) as bigint), 3) as `渔船ID`", "if(rank % 7 = 0, null, rank / 8) as lat", "120.0 as lon",
        "if(rank % 5 = 0, double('nan'), 0.25) as `速度`", "cast(rank % 360 as int) as `方向`",
        "'0101 00:00:00' as time", "if(rank % 2 = 0, '拖网', null) as type", "rank")
        .repartition(3, "渔船ID").sortWithinPartitions("渔船ID", "rank").drop("rank"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")  # most vessels lie in several batches
    try:
        sinks.write_vessels(rows, str(tmp_path / "ours"))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    monkeypatch.setattr(sinks, "_local_path", lambda *_: None)
    sinks.write_vessels(rows, str(tmp_path / "spark"))
    ours = {f.stem: f.read_bytes() for f in (tmp_path / "ours").rglob("*") if f.is_file()}
    theirs = {f.parent.name.removeprefix("_vessel="): f.read_bytes() for f in (tmp_path / "spark").rglob("*.csv")}
    theirs["none"] = theirs.pop("__HIVE_DEFAULT_PARTITION__")
    assert len(ours) == 27 and ours == theirs
    back = [tracks.read_tracks(spark, str(tmp_path / n)).orderBy("id", "seq").toPandas() for n in ("ours", "spark")]
    assert len(back[0]) == 700 and back[0].equals(back[1])


def test_rows_of_a_vessel_must_stand_together(spark, tmp_path):
    rows = spark.createDataFrame([(1, 30.0), (2, 30.0), (1, 31.0)], "id bigint, lat double").coalesce(1)
    with pytest.raises(Exception, match="do not stand together"):
        sinks.write_vessels(rows, str(tmp_path / "vessels"))


def test_no_vessels_make_an_empty_table(spark, tmp_path):
    rows = spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in tracks.FILE_COLUMNS.items()))
    sinks.write_vessels(rows, str(tmp_path / "none"))
    assert tracks.read_tracks(spark, str(tmp_path / "none")).count() == 0


def test_row_numbers_of_files_asks_hadoop_for_no_vessel(spark, tmp_path):
    """Each file that Hadoop makes in a local folder costs it two processes and has a checksum file."""
    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert catalog.QUERIES["row_numbers_of_files"](spark, SF_DIR).count() > 0
    made, = [n for n in set(os.listdir(folder)) - before if n.startswith("wakeline-csv-")]
    names = [n for _, _, found in os.walk(f"{folder}/{made}") for n in found]
    vessels = spark.read.parquet(f"{SF_DIR}/events.parquet").select("user_id").distinct().count()
    assert len(names) == vessels and all(n.endswith(".csv") for n in names)


def test_small_files_share_tasks(spark, tmp_path):
    """What is parsed from many small files is written by a task a core, not by one for every 32 files."""
    for vessel in range(600):
        (tmp_path / f"{vessel}.csv").write_text(
            ",".join(tracks.FILE_COLUMNS) + f"\n{vessel},30.0,120.0,1.0,3,0101 00:00:00,拖网\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.openCostInBytes", None)
    df = tracks.read_tracks(spark, str(tmp_path))
    assert len(df.inputFiles()) <= spark.sparkContext.defaultParallelism
    assert spark.conf.get("spark.sql.files.openCostInBytes", None) == old
    assert sorted((r["id"], r["seq"]) for r in df.collect()) == [(i, 0) for i in range(600)]
