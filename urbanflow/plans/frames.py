"""How the standard tables stand in for measurements, incidents, grids and scored frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.functions.temporal import hour_bucket
from urbanflow.operators import aggregates
from urbanflow.sources.tables import read

DISTRICTS = 21
TYPES = ["click", "error", "purchase", "signup", "view"]


def measured(raw: DataFrame) -> DataFrame:
    """Measurements: point (user_id), district, hour, label (event_type) and value."""
    return raw.drop("props").withColumns({"dist": (F.col("user_id") % DISTRICTS + 1).cast("int"), "hour_ts": hour_bucket("ts")})


def incidents_of(ev: DataFrame) -> DataFrame:
    return ev.where("event_type = 'error'")


def districts_of(ev: DataFrame) -> DataFrame:
    return ev.select("dist").where("dist is not null").distinct()


def grid_of(ev: DataFrame) -> DataFrame:
    """Every district with every hour from the first to the last of the measurements."""
    return aggregates.dense_grid(districts_of(ev), aggregates.hour_bounds(ev, "ts"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(read(spark, sf_dir, "events"))


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents_of(events(spark, sf_dir))


def districts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return districts_of(events(spark, sf_dir))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid_of(events(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, score with ties, and segments."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    score = F.round(((F.col("n_chars") * 7919) % 1000) / 1000.0, 3)
    return docs.join(read(spark, sf_dir, "labels"), "doc_id").select("doc_id", "lang", "source", F.col("quality").alias("label"), score.alias("score"))


#: The same in SQL.
EV = "ev AS (SELECT event_id, ts, date_trunc('hour', ts) AS hour_ts, user_id, CAST(user_id % 21 + 1 AS INT) AS dist, event_type, value FROM events)"
GRID = "hrs AS (SELECT unnest(generate_series(min(hour_ts), max(hour_ts), INTERVAL 1 HOUR)) AS hour_ts FROM ev), grid AS (SELECT dist, hour_ts FROM (SELECT DISTINCT dist FROM ev), hrs)"
SCORED = "scored AS (SELECT doc_id, lang, source, quality AS label, round(((n_chars * 7919) % 1000) / 1000.0::DOUBLE, 3) AS score FROM documents JOIN labels USING (doc_id))"
PART = "CASE WHEN {h} <= 5 THEN 'night' WHEN {h} <= 11 THEN 'morning' WHEN {h} <= 15 THEN 'midday' WHEN {h} <= 19 THEN 'afternoon' ELSE 'evening' END"
