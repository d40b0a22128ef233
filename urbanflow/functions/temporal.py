"""Time expressions on timestamps without zone: nothing depends on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_bucket(ts: str | Column) -> Column:
    """Start of the hour, still without zone (date_trunc would pass through the session's zone)."""
    t = _col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.lit(0), F.lit(0))


def parse_timestamp(parts: list[str], fmt: str, on_error: str = "fail") -> Column:
    """A timestamp from columns joined by a space; on_error="null" makes bad values null instead of failing."""
    joined = F.concat_ws(" ", *parts) if len(parts) > 1 else F.col(parts[0])
    if on_error == "fail":
        return F.to_timestamp_ntz(joined, F.lit(fmt))
    # The value itself is parsed without zone; whether it parses is asked of the date, which no zone skips.
    return F.when(F.call_function("try_to_date", joined, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(joined, F.lit(fmt)))


def parse_date(column: str, fmt: str) -> Column:
    return F.to_date(F.col(column), fmt)


def day_part(hour: str | Column) -> Column:
    """night 0-5, morning 6-11, midday 12-15, afternoon 16-19, evening 20-23."""
    h = _col(hour)
    return F.when(h.between(0, 5), "night").when(h.between(6, 11), "morning").when(h.between(12, 15), "midday").when(h.between(16, 19), "afternoon").when(h.between(20, 23), "evening")


def normalize_time(df: DataFrame, timestamp: str | None = None, date: str | None = None, hour: str | None = None) -> DataFrame:
    """Adds hour_ts, date, hour, year and month from a timestamp, or from a date and an hour where that is missing."""
    built = F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date), F.coalesce(F.col(hour).cast("int"), F.lit(0)) if hour else F.lit(0), F.lit(0), F.lit(0)) if date else None
    whole = hour_bucket(timestamp) if timestamp else None
    at = F.coalesce(*(c for c in (whole, built) if c is not None))
    df = df.withColumn("hour_ts", at)
    return df.withColumns({"date": F.to_date("hour_ts"), "hour": F.hour("hour_ts"), "year": F.year("hour_ts"), "month": F.month("hour_ts")})


def time_labels(df: DataFrame, ts: str) -> DataFrame:
    """Adds weekday (1 = Sunday), day_name and day_part."""
    return df.withColumns({"weekday": F.dayofweek(ts), "day_name": F.date_format(ts, "EEEE"), "day_part": day_part(F.hour(ts))})


def floor_minutes(ts: str | Column, zone: str, minutes: int = 10) -> Column:
    """A UTC wall clock as one of `zone`, floored to a multiple of `minutes` within the hour."""
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))
    minute = F.minute(local) - F.minute(local) % minutes
    return F.make_timestamp_ntz(F.year(local), F.month(local), F.dayofmonth(local), F.hour(local), minute, F.lit(0))


def hour_dimension(spark: SparkSession) -> DataFrame:
    h = F.col("id").cast("int")
    order = F.when(h <= 5, 1).when(h <= 11, 2).when(h <= 15, 3).when(h <= 19, 4).otherwise(5)
    return spark.range(24).select(h.alias("hour"), day_part(h).alias("day_part"), order.alias("day_part_order"))


def date_dimension(dates: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last; the bounds stay in the plan as one row."""
    bounds = dates.agg(F.to_date(F.min(column)).alias("a"), F.to_date(F.max(column)).alias("b"))
    days = bounds.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("date"))
    return days.select(
        "date", F.year("date").alias("year"), F.quarter("date").alias("quarter"), F.month("date").alias("month"), F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("iso_week"), F.dayofweek("date").alias("weekday"), F.date_format("date", "EEEE").alias("day_name"), F.dayofweek("date").isin(1, 7).alias("is_weekend"))
