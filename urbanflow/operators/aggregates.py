"""Aggregates over entities and hours, dense grids and lead labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.functions.temporal import hour_bucket
from urbanflow.operators.joins import densify


def hourly_aggregate(df: DataFrame, keys: list[str], ts: str, value: str, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """n, mean, highest and total by key and hour; null keys and times are left out, the last hour counts whole."""
    rows = df.withColumn("hour_ts", hour_bucket(ts)).dropna(subset=[*keys, "hour_ts"])
    if start is not None:
        rows = rows.where(F.col("hour_ts").between(start, end))
    return rows.groupBy(*keys, "hour_ts").agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("highest"), F.sum(value).alias("total"))


def hour_bounds(df: DataFrame, ts: str) -> DataFrame:
    """One row: the first and the last hour of df, or no row if it has none."""
    return df.agg(F.min(hour_bucket(ts)).alias("first_hour"), F.max(hour_bucket(ts)).alias("last_hour")).where("first_hour is not null")


def dense_grid(keys: DataFrame, bounds: DataFrame) -> DataFrame:
    """Every key with every hour of `hour_bounds`.

    The bounds, one row, are all that is broadcast; each key makes its own hours where it is, so keys may be any number.
    """
    hours = F.explode(F.sequence("first_hour", "last_hour", F.expr("INTERVAL 1 HOUR"))).alias("hour_ts")
    return keys.crossJoin(F.broadcast(bounds)).select(*keys.columns, hours)


def dense_counts(facts: DataFrame, keys: list[str], ts: str, entities: DataFrame, bounds: DataFrame) -> DataFrame:
    counts = facts.withColumn("hour_ts", hour_bucket(ts)).groupBy(*keys, "hour_ts").agg(F.count("*").alias("n"))
    return densify(dense_grid(entities, bounds), counts, [*keys, "hour_ts"], ["n"])


def lead_hour_label(grid: DataFrame, events: DataFrame, entity: str, event: str, ts: str, required: list[str]) -> DataFrame:
    """For each entity and hour the number of valid events in the hour after it, and whether there is one.

    An event with a null in a required column of any row is left out whole; one with several entities or hours fails.
    """
    invalid = F.lit(False)
    for c in required:
        invalid = invalid | F.col(c).isNull()
    rows = events.withColumn("_hour", hour_bucket(ts))
    bad = rows.where(invalid).select(event).distinct()
    valid = rows.join(bad, event, "left_anti").select(event, entity, "_hour").distinct()
    if not valid.groupBy(event).count().where("count > 1").isEmpty():
        raise ValueError("events with several entities or hours")
    if not valid.join(grid.select(entity).distinct(), entity, "left_anti").isEmpty():
        raise ValueError("events of entities that the grid lacks")
    counts = valid.groupBy(entity, F.expr("_hour - INTERVAL 1 HOUR").alias("hour_ts")).agg(F.count("*").alias("n_next_hour"))
    out = densify(grid.select(entity, "hour_ts"), counts, [entity, "hour_ts"], ["n_next_hour"])
    return out.withColumns({"next_hour_ts": F.expr("hour_ts + INTERVAL 1 HOUR"), "target_next_hour": (F.col("n_next_hour") > 0).cast("int")})


def rolling_window(df: DataFrame, ts: str, cutoff: str, hours: int = 1) -> DataFrame:
    """Rows of [cutoff - hours, cutoff + 1 minute): the cutoff's own minute counts."""
    at = F.lit(cutoff).cast("timestamp_ntz")
    return df.where((F.col(ts) >= at - F.expr(f"INTERVAL {hours} HOUR")) & (F.col(ts) < at + F.expr("INTERVAL 1 MINUTE")))


def half_open(ts: str, start: str | None, end: str | None) -> Column:
    """[start, end) with either end open."""
    t, out = F.col(ts), F.lit(True)
    if start is not None:
        out = out & (t >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        out = out & (t < F.lit(end).cast("timestamp_ntz"))
    return F.coalesce(out, F.lit(False))


def split_name(ts: str, splits: dict[str, tuple[str | None, str | None]]) -> Column:
    """The split whose range holds the time, else 'excluded'."""
    out = F.lit("excluded")
    for name, (a, b) in splits.items():
        out = F.when(half_open(ts, a, b), name).otherwise(out)
    return out
