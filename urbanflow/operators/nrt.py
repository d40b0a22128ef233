"""Scoring batches: features of the last hour, completeness, publication and the current batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.operators import aggregates, dedup, quality, sinks
from urbanflow.sources import versioned


def batch_features(entities: DataFrame, flows: DataFrame, stations: DataFrame, entity: str, station: str, ts: str, value: str, cutoff: str, flow_hours: int = 1, max_age: Column | None = None) -> DataFrame:
    """One row per entity at the cutoff: rolling means and counts of `flows`, and the mean of the newest value of each of its stations.

    Entities without rows keep a count of 0 and null means; the newest times of both sources are those of all entities.
    """
    at = F.lit(cutoff).cast("timestamp_ntz")
    rolling = aggregates.rolling_window(flows, ts, cutoff, flow_hours).groupBy(entity).agg(F.count(value).alias("n_flow"), F.avg(value).alias("mean_flow"), F.max(ts).alias("_flow_at"))
    newest = dedup.latest_per_entity(stations, [entity, station], ts, at, [value], max_age)
    latest = newest.groupBy(entity).agg(F.count(value).alias("n_stations"), F.avg(value).alias("mean_station"), F.max(ts).alias("_station_at"))
    out = entities.select(entity).join(rolling, entity, "left").join(latest, entity, "left").fillna(0, ["n_flow", "n_stations"])
    times = out.agg(F.max("_flow_at").alias("flow_at"), F.max("_station_at").alias("station_at"))
    return out.drop("_flow_at", "_station_at").join(F.broadcast(times)).withColumn("cutoff", at)


def batch_problems(batch: DataFrame, entities: DataFrame, entity: str, score: str) -> DataFrame:
    """One row: entities that are missing, repeated or unknown, and scores outside 0 to 1."""
    known = entities.select(F.col(entity).alias("_known")).distinct()
    own = batch.groupBy(entity).agg(F.count("*").alias("n"), F.sum((~F.coalesce(F.col(score).between(0, 1), F.lit(False))).cast("bigint")).alias("bad"))
    both = own.join(known, F.col(entity) == F.col("_known"), "full")
    return both.agg(
        quality.count_if(F.col("n").isNull(), "n_missing"), quality.count_if(F.col("n") > 1, "n_repeated"),
        quality.count_if(F.col("_known").isNull(), "n_unknown"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_out_of_range"))


def publish(batch: DataFrame, entities: DataFrame, path: str, entity: str, window: str, score: str) -> None:
    """Upsert a whole batch; an incomplete one is an error, and nothing is written."""
    quality.require(batch_problems(batch, entities, entity, score), "the batch")
    sinks.write(batch, path, "merge", keys=[entity, window])


def current(df: DataFrame, window: str) -> DataFrame:
    """The rows of the newest window."""
    return df.join(F.broadcast(df.agg(F.max(window).alias("_newest"))), F.col(window) == F.col("_newest")).drop("_newest")


def published(batch: DataFrame, path: str) -> DataFrame:
    return versioned.read(batch.sparkSession, path)
