"""Write strategies: versioned tables (overwrite, append, upsert, replacement of partitions) and managed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanflow.operators.columns import check_names
from urbanflow.sources import versioned


def insert_overwrite(df: DataFrame, table: str) -> None:
    """The rows of df in place of all rows of a managed table, in the table's own columns and types, which stay as they are."""
    schema = df.sparkSession.table(table).schema
    gone, more = [f.name for f in schema if f.name not in df.columns], [c for c in df.columns if c not in schema.names]
    if gone or more:
        raise ValueError(f"{table} wants {gone} and knows no {more}")
    df.select(*(F.col(f.name).cast(f.dataType) for f in schema)).write.mode("overwrite").insertInto(table)


def managed(df: DataFrame, table: str, partition_by: list[str] | None = None) -> None:
    """df as a managed table of the catalog."""
    check_names(df).write.mode("overwrite").option("overwriteSchema", "true").partitionBy(*(partition_by or [])).format("parquet").saveAsTable(table)


def write(df: DataFrame, path: str, strategy: str, keys: list[str] | None = None, partition_by: list[str] | None = None, token: str | None = None) -> int:
    """The next version of the table at path, by one of four strategies; its number.

    A token (append and merge) makes repeated writes of one batch a single one.
    """
    check_names(df)
    if strategy == "overwrite":
        return versioned.overwrite(df, path, partition_by)
    if strategy == "append":
        return versioned.append(df, path, partition_by, token)
    if strategy == "merge" and keys:
        return versioned.upsert(df, path, keys, partition_by, token)
    if strategy == "replace_partitions" and partition_by:
        return versioned.replace_partitions(df, path, partition_by)
    raise ValueError(f"no write strategy {strategy!r} with keys {keys} and partitions {partition_by}")
