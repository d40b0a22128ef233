"""Plain Parquet tables, shared folders and what several versioned tables hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.sources import versioned
from urbanflow.sources.work import clear, exists, materialized, work_dir  # noqa: F401  for users of tables


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_optional(spark: SparkSession, path: str, required: bool = False) -> DataFrame | None:
    """The table, or None where an optional one isn't there."""
    if not required and not exists(spark, path):
        return None
    return spark.read.parquet(path)


def capture_versions(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """table, newest version."""
    return spark.createDataFrame([(name, versioned.newest(spark, path)) for name, path in paths.items()], "table string, version int")


def latest_snapshot_reference(first: DataFrame, second: DataFrame, column: str = "snapshot_id") -> DataFrame:
    """The one snapshot that both tables hold; no row if either holds several or they differ."""
    ids = first.select(column).distinct().withColumn("side", F.lit(1)).unionByName(second.select(column).distinct().withColumn("side", F.lit(2)))
    one = ids.agg(F.countDistinct(column).alias("n"), F.countDistinct("side").alias("sides"), F.max(column).alias(column))
    return one.where("n = 1 and sides = 2").select(column)
