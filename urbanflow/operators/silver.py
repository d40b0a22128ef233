"""The Silver step: what is new, cleaned, of the newest file, stamped and written by a strategy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from urbanflow.operators import columns, dedup, sinks
from urbanflow.sources import versioned


def increment(source: DataFrame, target: DataFrame | None, steps: list[tuple[str, dict]], watermark: str | None = None, snapshot: str | None = None, partitions: list[str] | None = None, stamp: str | None = "_processed_at") -> DataFrame:
    """Rows of source later than target's newest `watermark`, through the chain, of the newest `snapshot` date (of each partition)."""
    rows = dedup.after_watermark(source, target, watermark) if watermark else source
    rows = columns.transform_chain(rows, steps)
    if snapshot and partitions:
        rows = dedup.latest_partition_snapshot(rows, partitions, snapshot)
    elif snapshot:
        rows = dedup.latest_file_snapshot(rows, snapshot)
    return columns.add_processing_time(rows, stamp) if stamp else rows


def run(source: DataFrame, path: str, steps: list[tuple[str, dict]], strategy: str, keys: list[str] | None = None, partition_by: list[str] | None = None, **options) -> DataFrame:
    """One increment, written to path by its strategy; the table afterwards."""
    spark = source.sparkSession
    target = versioned.read(spark, path) if versioned.exists(spark, path) else None
    rows = increment(source, target, steps, **options)
    return versioned.read(spark, path, sinks.write(rows, path, strategy, keys=keys, partition_by=partition_by))
