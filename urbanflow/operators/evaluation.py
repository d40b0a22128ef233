"""Ranking metrics that treat tied scores as one, curves, calibration and baseline rates.

Rows collapse to distinct scores first; running sums go over score buckets and then within each bucket, so no window
runs over everything in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 200


def checked(scored: DataFrame, label: str, score: str) -> DataFrame:
    """scored, whose rows fail as they are read if the label isn't 0 or 1 or the score isn't within 0 and 1 (null and NaN aren't)."""
    y, s = F.col(label), F.col(score)
    ok = F.coalesce(y.isin(0, 1) & s.between(0, 1) & ~F.isnan(s.cast("double")), F.lit(False))
    return scored.withColumn(score, F.when(ok, s).otherwise(F.raise_error(F.lit(f"{label} must be 0 or 1 and {score} within 0 and 1")).cast("double")))


def by_score(scored: DataFrame, label: str, score: str, segments: list[str]) -> DataFrame:
    y = F.col(label).cast("double")
    return scored.groupBy(*segments, F.col(score).alias("score")).agg(F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("pos"), F.sum(F.pow(F.col(score) - y, 2)).alias("sq"))


def running_frames(scored: DataFrame, label: str, score: str, segments: list[str] | None = None) -> DataFrame:
    """Per distinct score: n, pos, and above it (higher scores) n_above, pos_above; with it n_to, pos_to."""
    segments = segments or []
    rows = by_score(checked(scored, label, score), label, score, segments)
    # Bounds at quantiles, so rare-event scores close to 0 fall into many buckets; one row of at most BUCKETS numbers.
    edges = rows.agg(F.array_distinct(F.percentile_approx("score", F.array(*(F.lit(k / BUCKETS) for k in range(1, BUCKETS))), F.lit(10 * BUCKETS))).alias("edges"))
    rows = rows.join(F.broadcast(edges)).withColumn("bucket", F.when(F.col("edges").isNull(), 0).otherwise(F.expr("size(filter(edges, e -> e < score))"))).drop("edges")
    totals = rows.groupBy(*segments, "bucket").agg(F.sum("n").alias("bn"), F.sum("pos").alias("bp"))
    # The number of buckets is fixed, so this window's input doesn't grow with the data.
    w = Window.partitionBy(*segments).orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*segments, "bucket", F.coalesce(F.sum("bn").over(w), F.lit(0)).alias("n0"), F.coalesce(F.sum("bp").over(w), F.lit(0)).alias("p0"))
    inside = Window.partitionBy(*segments, "bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.join(before, [*segments, "bucket"])
    n_to, pos_to = F.col("n0") + F.sum("n").over(inside), F.col("p0") + F.sum("pos").over(inside)
    out = out.withColumns({"n_to": n_to, "pos_to": pos_to})
    return out.select(*segments, "score", "n", "pos", "sq", (F.col("n_to") - F.col("n")).alias("n_above"), (F.col("pos_to") - F.col("pos")).alias("pos_above"), "n_to", "pos_to")


def binary_metrics(scored: DataFrame, label: str, score: str, segments: list[str] | None = None) -> DataFrame:
    """n, positives, prevalence, average precision, ROC AUC (half ties), Brier score; nulls where one class is absent."""
    segments = segments or []
    rows = running_frames(scored, label, score, segments)
    neg = F.col("n") - F.col("pos")
    sums = rows.groupBy(*segments).agg(
        F.sum("n").alias("n"), F.sum("pos").alias("positives"), F.sum("sq").alias("sq"),
        F.sum(F.col("pos") * F.try_divide("pos_to", "n_to")).alias("ap"), F.sum(neg * (F.col("pos_above") + F.col("pos") / 2)).alias("u"))
    both = (F.col("positives") > 0) & (F.col("positives") < F.col("n"))
    return sums.select(
        *segments, "n", "positives", (F.col("positives") / F.col("n")).alias("prevalence"),
        F.when(both, F.col("ap") / F.col("positives")).alias("average_precision"),
        F.when(both, F.col("u") / (F.col("positives") * (F.col("n") - F.col("positives")))).alias("roc_auc"),
        (F.col("sq") / F.col("n")).alias("brier"), both.alias("evaluable"))


def curve_points(scored: DataFrame, label: str, score: str, steps: int = 100) -> DataFrame:
    """Precision, recall and false-positive rate at the observed percentiles of the score."""
    rows = running_frames(scored, label, score)
    whole = rows.agg(F.sum("n").alias("all"), F.sum("pos").alias("all_pos"))
    rows = rows.join(F.broadcast(whole)).withColumn("below_to", F.col("all") - F.col("n_above"))  # rows up to and with this score
    # The percentile k / steps lies in this row if k * all / steps, rounded up and at least 1, is a rank of it: the last such k is enough.
    need = F.greatest(F.expr(f"((below_to * {steps} div all) * all + {steps - 1}) div {steps}"), F.lit(1))
    points = rows.where(need > F.col("below_to") - F.col("n"))
    return points.select(
        F.col("score").alias("threshold"), (F.col("pos_to") / F.col("n_to")).alias("precision"), F.try_divide(F.col("pos_to"), F.col("all_pos")).alias("recall"),
        F.try_divide(F.col("n_to") - F.col("pos_to"), F.col("all") - F.col("all_pos")).alias("false_positive_rate"))


def calibration_bins(scored: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("rate"))


def report(scored: DataFrame, label: str, score: str, segments: list[str]) -> dict[str, DataFrame]:
    """All that is said of one period: metrics of the whole and by each segment, the curve and the calibration."""
    parts = {"global": binary_metrics(scored, label, score)} | {s: binary_metrics(scored, label, score, [s]) for s in segments}
    return parts | {"curve": curve_points(scored, label, score), "calibration": calibration_bins(scored, label, score)}


def baseline_rates(train: DataFrame, label: str, entity: str, group: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rates of all rows, by entity, and by entity and group."""
    rate = F.avg(F.col(label).cast("double"))
    return train.agg(rate.alias("global_rate")), train.groupBy(entity).agg(rate.alias("entity_rate")), train.groupBy(entity, *group).agg(rate.alias("group_rate"))


def baseline_fallback(frame: DataFrame, rates: tuple[DataFrame, DataFrame, DataFrame], entity: str, group: list[str]) -> DataFrame:
    """The rate of the row's group, else of its entity, else of all."""
    whole, by_entity, by_group = rates
    out = frame.join(by_group, [entity, *group], "left").join(by_entity, entity, "left").join(F.broadcast(whole))
    return out.withColumn("baseline", F.coalesce("group_rate", "entity_rate", "global_rate"))
