"""Feature, probability and label tables on disk."""

from __future__ import annotations

import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from wakeline.functions import scalars as S


def write_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_probabilities(df: DataFrame, path: str) -> None:
    """(id, p_<class>...) as CSV with a header."""
    df.select("id", *[f"p_{c}" for c in S.CLASSES]).write.mode("overwrite").option("header", True).csv(path)


def read_probabilities(spark: SparkSession, path: str) -> DataFrame:
    fields = ", ".join(["id bigint", *[f"p_{c} double" for c in S.CLASSES]])
    return spark.read.schema(fields).option("header", True).csv(path)


def write_labels(df: DataFrame, path: str, native: bool = True) -> None:
    """(id, label) as CSV without a header; `native` writes the labels as the source files have them."""
    label = F.col("label")
    if native:
        label = F.coalesce(*[F.when(label == n, t) for t, n in S.CLASS_TEXT.items()], label)
    df.select("id", label.alias("label")).write.mode("overwrite").option("header", False).csv(path)


def _local_path(spark: SparkSession, path: str) -> str | None:
    """Where a folder lies in the machines' own file tree; None if it lies in another file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def write_vessels(rows: DataFrame, path: str) -> None:
    """A new folder with one CSV file, with a header, per number in the first column.

    All rows of a number stand together in one partition, in the order they
    have in the file. In a local folder Hadoop starts a `chmod` for every file
    it creates and for its checksum, which takes far longer than the writing.
    So there the tasks write the lines, as Spark formats them, themselves, and
    name a file once it is whole: a task that runs again makes the same files.
    """
    key = rows.columns[0]
    folder = _local_path(rows.sparkSession, path)
    if folder is None:
        rows.withColumn("_vessel", F.col(key)).write.partitionBy("_vessel").option("header", True).csv(path)
        return
    os.makedirs(folder)
    header = (",".join(rows.columns) + "\n").encode()

    def runs(batches):
        """The lines of neighbouring rows of one name, as (name, bytes)."""
        for batch in batches:
            if batch.num_rows:
                names, lines = batch.column(0), batch.column(1).cast(pa.large_binary())
                ends = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset:lines.offset + len(lines) + 1]
                starts = np.flatnonzero(pc.not_equal(names[1:], names[:-1]).to_numpy(zero_copy_only=False)) + 1
                starts = np.concatenate([[0], starts])
                places = ends[np.concatenate([starts, [len(lines)]])].tolist()
                data = memoryview(lines.buffers()[2])
                for name, start, end in zip(names.take(pa.array(starts)).to_pylist(), places, places[1:]):
                    yield name, data[start:end]

    def write(batches):
        task = TaskContext.get()
        part = f"{folder}/part={task.partitionId()}"
        unnamed = f"{part}/.{task.taskAttemptId()}"
        os.makedirs(part, exist_ok=True)
        done = set()
        for name, texts in itertools.groupby(runs(batches), lambda run: run[0]):
            if name in done:
                raise ValueError(f"the rows of {name} do not stand together")
            with open(unnamed, "wb") as file:
                file.write(header)
                file.writelines(text for _, text in texts)
            os.replace(unnamed, f"{part}/{name}.csv")
            done.add(name)
        yield pa.RecordBatch.from_pydict({"files": pa.array([len(done)], pa.int64())})

    lines = F.to_csv(F.struct(*[F.col(f"`{n}`") for n in rows.columns]))
    (rows.select(F.coalesce(F.col(key).cast("string"), F.lit("none")).alias("name"),
                 F.concat(lines, F.lit("\n")).alias("line"))
     .mapInArrow(write, "files bigint").agg(F.sum("files")).collect())
