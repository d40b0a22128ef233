"""One row per key, newest snapshots and increments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflow.operators.columns import REGISTRY


def deduplicate(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_partition_snapshot(df: DataFrame, partitions: list[str], date: str) -> DataFrame:
    """Rows of each partition's newest date, ties included.  One aggregated row per partition joins back."""
    if not df.where(F.col(date).isNull()).isEmpty():
        raise ValueError(f"{date} has nulls")
    newest = df.groupBy(*partitions).agg(F.max(date).alias("_newest"))
    same = [df[p].eqNullSafe(newest[p]) for p in partitions]
    return df.join(newest, [*same, df[date] == newest["_newest"]], "left_semi")


def latest_file_snapshot(df: DataFrame, date: str) -> DataFrame:
    """Rows of the newest date of all; the maximum is a broadcast row, not a window without partitions.

    Rows without any date are an error: no file would be the newest.
    """
    newest = df.agg(F.max(date).alias("_newest"))
    if newest.first()[0] is None and not df.isEmpty():
        raise ValueError(f"all rows have a null {date}")
    return df.join(F.broadcast(newest), F.col(date) == F.col("_newest")).drop("_newest")


def after_watermark(df: DataFrame, target: DataFrame | None, column: str) -> DataFrame:
    """Rows later than the newest of target; all rows if there is no target or it has none.

    The mark is one value, so the scan of df skips what lies before it.
    """
    if target is None:
        return df
    mark = target.agg(F.max(column)).first()[0]
    return df if mark is None else df.where(F.col(column) > F.lit(mark).cast(df.schema[column].dataType))


def latest_per_entity(df: DataFrame, keys: list[str], time: str, cutoff: Column, ties: list[str], max_age: Column | None = None) -> DataFrame:
    """Each entity's newest row up to the cutoff (ties by the other columns, descending)."""
    rows = df.where(F.col(time) <= cutoff)
    if max_age is not None:
        rows = rows.where(F.col(time) >= max_age)
    return deduplicate(rows, keys, [F.col(time).desc_nulls_last(), *(F.col(t).desc_nulls_last() for t in ties)])


#: In a chain an order is a column name, with a minus before it for descending.
REGISTRY["deduplicate"] = lambda df, keys, order: deduplicate(df, keys, [F.desc(o[1:]) if o.startswith("-") else F.asc(o) for o in order])
