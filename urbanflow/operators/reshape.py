"""Wide and long forms, nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.operators.columns import require_columns, safe_labels


def hourly_wide_to_long(df: DataFrame, year: str, month: str, day: str, value_prefix: str = "h", valid_prefix: str = "v", hours: range = range(1, 25), hour_offset: int = -1, out: tuple[str, str, str] = ("value", "valid", "ts")) -> DataFrame:
    """Columns h01.., v01.. of a day as rows (value, validity, timestamp of the hour plus hour_offset)."""
    pairs = {h: (f"{value_prefix}{h:02d}", f"{valid_prefix}{h:02d}") for h in hours}
    wide = [c for p in pairs.values() for c in p]
    require_columns(df, [year, month, day, *wide], "hourly_wide_to_long")
    kept = [c for c in df.columns if c not in wide]
    if clash := sorted(set(out) & set(kept)):
        raise ValueError(f"columns exist already: {clash}")
    rows = F.array(*(F.struct(F.lit(h + hour_offset).alias("h"), F.col(a).alias("a"), F.col(b).alias("b")) for h, (a, b) in pairs.items()))
    long = df.select(*kept, F.explode(rows).alias("_r"))
    at = F.make_timestamp_ntz(F.col(year).cast("int"), F.col(month).cast("int"), F.col(day).cast("int"), F.col("_r.h"), F.lit(0), F.lit(0))
    return long.select(*kept, F.col("_r.a").alias(out[0]), F.col("_r.b").alias(out[1]), at.alias(out[2]))


def pivot_wide(df: DataFrame, keys: list[str], label: str, value: str, labels: list[str]) -> DataFrame:
    """A column with the mean for each label; the labels are given, so no job looks for them."""
    return df.groupBy(*keys).pivot(label, labels).agg(F.avg(value))


def pivot_first(df: DataFrame, keys: list[str], label: str, value: str, order: list[Column], prefix: str = "", max_labels: int = 1000) -> DataFrame:
    """A column for each label that df has, with the first non-null value by `order`, under a name that a column may have.

    The labels are looked for by one job and may be max_labels at the most, since each becomes a column.
    """
    found = [r[0] for r in df.where(F.col(label).isNotNull()).select(F.col(label).cast("string")).distinct().limit(max_labels + 1).collect()]
    if len(found) > max_labels:
        raise ValueError(f"{label} has more than {max_labels} values")
    names = safe_labels(sorted(found), prefix)
    if clash := sorted(set(names.values()) & set(keys)):
        raise ValueError(f"columns exist already: {clash}")
    rank = F.struct(*order)
    return df.groupBy(*keys).agg(*(F.min_by(value, F.when((F.col(label).cast("string") == x) & F.col(value).isNotNull(), rank)).alias(n) for x, n in names.items()))


def conditional_pivot(df: DataFrame, keys: list[str], label: str, value: str, labels: list[str], required: bool = False) -> DataFrame:
    """<label>_mean and <label>_n (non-null values) for each label; required: a label without any row is an error."""
    if required:
        there = {r[0] for r in df.where(F.col(label).isin(*labels)).select(label).distinct().collect()}  # as many as labels
        if gone := [x for x in labels if x not in there]:
            raise ValueError(f"no rows with {label} = {gone}")
    at = lambda x: F.when(F.col(label) == x, F.col(value))
    aggs = [a for x in labels for a in (F.avg(at(x)).alias(f"{x}_mean"), F.count(at(x)).alias(f"{x}_n"))]
    return df.where(F.col(label).isin(*labels)).groupBy(*keys).agg(*aggs)


def explode_nested_records(df: DataFrame, records: str, parents: list[str]) -> DataFrame:
    """A row per record with its parent's columns; a parent without records keeps one row."""
    return df.select(*parents, F.explode_outer(records).alias("_r")).select(*parents, "_r.*")
