"""Folders for what jobs write on their way, shared by driver and executors."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: Folders that `work_dir` has given and `clear` hasn't deleted.
_MADE: list[str] = []


def work_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share.

    Without that setting a local session (tests) takes a folder of this machine; any other raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        import tempfile

        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    _MADE.append(f"{base.rstrip('/')}/urbanflow-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear(spark: SparkSession) -> None:
    """Deletes the folders of `work_dir`: for when the results of the queries so far have been used."""
    while _MADE:
        delete(spark, _MADE.pop())


def materialized(df: DataFrame) -> DataFrame:
    """df written once and read back, for several uses; nothing above it runs again, and lost executors lose none of it."""
    path = f"{work_dir(df.sparkSession)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written_once(df: DataFrame) -> Iterator[DataFrame]:
    """df as a table that goes at the end of the block: a source that is used several times gives the same rows each time."""
    path = work_dir(df.sparkSession)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)
        if path in _MADE:
            _MADE.remove(path)
