"""Splits, metrics, baselines and Spark ML over the standard tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from urbanflow.operators import aggregates, evaluation, ml, nrt, quality
from urbanflow.plans.frames import SCORED, districts, scored
from urbanflow.plans.jobs import FEATURES, feature_snapshot
from urbanflow.plans.registry import query
from urbanflow.sources.tables import materialized, read, work_dir

SPLITS = {"train": (None, "1998-01-01"), "validation": ("1998-01-01", "1999-01-01"), "evaluation": ("1999-01-01", "2000-01-01")}
SPLIT_SQL = "CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'validation' WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'evaluation' ELSE 'excluded' END"


@query(f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM orders")
def temporal_split(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", aggregates.split_name("o_orderdate", SPLITS).alias("split"))


@query(f"SELECT count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'validation') AS validation, count(*) FILTER (s = 'evaluation') AS evaluation, count(*) FILTER (s = 'excluded') AS excluded, count(*) AS total, count(*) FILTER (s NOT IN ('train', 'validation', 'evaluation', 'excluded')) AS difference FROM (SELECT {SPLIT_SQL} AS s FROM orders)")
def temporal_split_counts(spark, sf):
    rows = temporal_split(spark, sf)
    sums = rows.agg(*(quality.count_if(F.col("split") == s, s) for s in (*SPLITS, "excluded")), F.count("*").alias("total"))
    return quality.reconciled(sums, [*SPLITS, "excluded"], "total")


FOLDS = {"fold1": ("1997-01-01", "1998-01-01"), "fold2": ("1998-01-01", "1999-01-01")}


@query(" UNION ALL ".join(f"SELECT '{k}' AS fold, CASE WHEN o_orderdate < TIMESTAMP '{a}' THEN 'train' ELSE 'validation' END AS part, count(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '{b}' GROUP BY 2" for k, (a, b) in FOLDS.items()))
def expanding_folds(spark, sf):
    df, out = read(spark, sf, "orders"), None
    for name, (a, b) in FOLDS.items():
        part = aggregates.split_name("o_orderdate", {"train": (None, a), "validation": (a, b)})
        rows = df.select(part.alias("part")).where("part <> 'excluded'").groupBy("part").agg(F.count("*").alias("n")).select(F.lit(name).alias("fold"), "part", "n")
        out = rows if out is None else out.unionByName(rows)
    return out


RUN = f"{SCORED}, g AS (SELECT score, count(*) AS n, sum(label)::BIGINT AS pos FROM scored GROUP BY score), w AS (SELECT score, n, pos, sum(n) OVER (ORDER BY score DESC)::BIGINT AS n_to, sum(pos) OVER (ORDER BY score DESC)::BIGINT AS pos_to FROM g)"


@query(f"WITH {RUN} SELECT score, n, pos, n_to - n AS n_above, pos_to - pos AS pos_above, n_to, pos_to FROM w")
def running_frames(spark, sf):
    return evaluation.running_frames(scored(spark, sf), "label", "score").drop("sq")


def metrics_sql(seg: str) -> str:
    p = f"PARTITION BY {seg} " if seg else ""
    s, g = (f"{seg}, ", f" GROUP BY {seg}") if seg else ("", "")
    return f"""WITH {SCORED}, g AS (SELECT {s}score, count(*) AS n, sum(label) AS pos, sum((score - label) ** 2) AS sq FROM scored GROUP BY {s}score),
w AS (SELECT {s}score, n, pos, sq, sum(n) OVER ({p}ORDER BY score DESC) AS n_to, sum(pos) OVER ({p}ORDER BY score DESC) AS pos_to FROM g), t AS (SELECT {s}sum(n) AS n, sum(pos) AS p, sum(sq) AS sq, sum(pos * pos_to / n_to) AS ap, sum((n - pos) * (pos_to - pos + pos / 2.0)) AS u FROM w{g})
SELECT {s}n::BIGINT AS n, p::BIGINT AS positives, round(p / n, 4) AS prevalence, CASE WHEN p > 0 AND p < n THEN round(ap / p, 4) END AS average_precision, CASE WHEN p > 0 AND p < n THEN round(u / (p * (n - p)), 4) END AS roc_auc, round(sq / n, 4) AS brier, p > 0 AND p < n AS evaluable FROM t"""


def rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in ("prevalence", "average_precision", "roc_auc", "brier")})


@query(metrics_sql(""))
def binary_metrics(spark, sf):
    return rounded(evaluation.binary_metrics(scored(spark, sf), "label", "score"))


@query(metrics_sql("lang"))
def segmented_binary_metrics(spark, sf):
    return rounded(evaluation.binary_metrics(scored(spark, sf), "label", "score", ["lang"])).orderBy("lang")


STEPS = ", ".join(str(k / 100) for k in range(101))


@query(f"""WITH {RUN}, a AS (SELECT sum(n) AS n, sum(pos) AS p FROM g), q AS (SELECT DISTINCT score FROM (SELECT unnest(quantile_disc(score, [{STEPS}])) AS score FROM scored))
SELECT score AS threshold, round(pos_to / n_to, 4) AS precision, round(pos_to / a.p, 4) AS recall, round((n_to - pos_to) / (a.n - a.p), 4) AS false_positive_rate FROM w JOIN q USING (score), a""")
def curve_points(spark, sf):
    out = evaluation.curve_points(scored(spark, sf), "label", "score")
    return out.withColumns({c: F.round(c, 4) for c in ("precision", "recall", "false_positive_rate")})


@query(f"WITH {SCORED} SELECT CAST(least(floor(score * 10), 9) AS INT) AS bin, count(*) AS n, round(avg(score), 4) AS mean_score, round(avg(label), 4) AS rate FROM scored GROUP BY 1")
def calibration_bins(spark, sf):
    return evaluation.calibration_bins(scored(spark, sf), "label", "score").withColumns({c: F.round(c, 4) for c in ("mean_score", "rate")})


EDGE = "2024-01-20 00:00:00"
BASE = f"{FEATURES}, f AS (SELECT dist, hour_ts, target_next_hour AS y, hour(hour_ts)::INT AS hour, (dayofweek(hour_ts) + 1)::INT AS weekday FROM labels1), tr AS (SELECT * FROM f WHERE hour_ts < TIMESTAMP '{EDGE}' AND NOT (dist = 5 AND hour < 6))"


def baseline_frames(spark, sf):
    df = feature_snapshot(spark, sf).select("dist", "hour_ts", F.col("target_next_hour").alias("y"), "hour", "weekday")
    edge = F.lit(EDGE).cast("timestamp_ntz")
    return df.where((F.col("hour_ts") < edge) & ~((F.col("dist") == 5) & (F.col("hour") < 6))), df.where(F.col("hour_ts") >= edge)


@query(f"WITH {BASE} SELECT dist, hour, weekday, round(avg(y), 4) AS group_rate, round(first(entity_rate), 4) AS entity_rate, round(first(global_rate), 4) AS global_rate FROM tr JOIN (SELECT dist, avg(y) AS entity_rate FROM tr GROUP BY dist) USING (dist), (SELECT avg(y) AS global_rate FROM tr) GROUP BY dist, hour, weekday")
def baseline_rates(spark, sf):
    train, _ = baseline_frames(spark, sf)
    whole, by_entity, by_group = evaluation.baseline_rates(train, "y", "dist", ["hour", "weekday"])
    out = by_group.join(by_entity, "dist").join(F.broadcast(whole))
    return out.withColumns({c: F.round(c, 4) for c in ("group_rate", "entity_rate", "global_rate")})


@query(f"""WITH {BASE}, gr AS (SELECT dist, hour, weekday, avg(y) AS r FROM tr GROUP BY ALL), er AS (SELECT dist, avg(y) AS r FROM tr GROUP BY ALL)
SELECT f.dist, f.hour_ts, round(coalesce(gr.r, er.r, (SELECT avg(y) FROM tr)), 4) AS baseline FROM f LEFT JOIN gr USING (dist, hour, weekday) LEFT JOIN er USING (dist) WHERE f.hour_ts >= TIMESTAMP '{EDGE}'""")
def baseline_fallback(spark, sf):
    train, rest = baseline_frames(spark, sf)
    out = evaluation.baseline_fallback(rest, evaluation.baseline_rates(train, "y", "dist", ["hour", "weekday"]), "dist", ["hour", "weekday"])
    return out.select("dist", "hour_ts", F.round("baseline", 4).alias("baseline"))


# Spark ML

NUMERIC, FLAGS, CATEGORIES = ["mean", "click_mean", "n"], ["mean_available", "click_mean_available"], ["dist_cat", "hour_cat", "weekday_cat"]


def feature_frame(spark, sf):
    """Written once: every fit and fold reads it, none makes it again."""
    df = feature_snapshot(spark, sf).withColumn("n", F.col("n").cast("double"))
    df = quality.sanitize_ranges(df, {"mean": (0.0, True, None, False), "click_mean": (0.0, True, None, False)})
    return materialized(ml.category_strings(df, ["dist", "hour", "weekday"]))


def early(date):
    return F.col("hour_ts") < F.lit(date).cast("timestamp_ntz")


SIZE = 3 + 2 + 20 + 23 + 6


@query(f"WITH {FEATURES} SELECT count(*) AS n_rows, count(*) AS n_wrong_size, count(*) FILTER (dist = 3) AS n_not_finite, count(DISTINCT dist) AS n_dists FROM labels1")
def vector_checks(spark, sf):
    """Vectors held to a size that is one too large, with an infinite value in one district."""
    df = feature_frame(spark, sf)
    model = ml.fit_preprocess(df.where(early("2024-01-25 00:00:00")), NUMERIC, FLAGS, CATEGORIES)
    dists = read(spark, sf, "events").agg(F.countDistinct(F.col("user_id") % 21).alias("n_dists"))
    from pyspark.ml.functions import array_to_vector, vector_to_array

    odd = F.transform(vector_to_array("features"), lambda x, i: F.when((i == 0) & (F.col("dist") == 3), float("inf")).otherwise(x))
    return ml.vector_checks(model.transform(df).select(array_to_vector(odd).alias("features")), "features", SIZE + 1).join(F.broadcast(dists))


def preprocessed(spark, sf):
    """The frame with its vectors, and the number of labels of each category."""
    df = feature_frame(spark, sf)
    model = ml.fit_preprocess(df.where(early("2024-01-25 00:00:00")), NUMERIC, FLAGS, CATEGORIES, median_error=0.0)
    from pyspark.ml.functions import vector_to_array

    sizes = [len(s.labels) for s in model.stages if type(s).__name__ == "StringIndexerModel"]
    return model.transform(df).select("dist", "hour_ts", vector_to_array("features").alias("features")), sizes


FRAME = f"{FEATURES}, f AS (SELECT dist, hour_ts, target_next_hour, mean, coalesce(n, 0)::DOUBLE AS n, click_mean, hour(hour_ts)::INT AS hour, (dayofweek(hour_ts) + 1)::INT AS weekday FROM labels1 LEFT JOIN h USING (dist, hour_ts) LEFT JOIN p USING (dist, hour_ts))"
TRAINED = "(SELECT quantile_disc({c}, 0.5) FROM f WHERE {c} IS NOT NULL AND hour_ts < TIMESTAMP '2024-01-25')"
SCALED = "round((x.{c} - s.m{c}) / s.s{c}, 4)"


@query(f"""WITH {FRAME}, x AS (SELECT *, coalesce(mean, {TRAINED.format(c='mean')}) AS a, coalesce(click_mean, {TRAINED.format(c='click_mean')}) AS b, n AS c FROM f),
tr AS (SELECT * FROM x WHERE hour_ts < TIMESTAMP '2024-01-25'), s AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb, avg(c) AS mc, stddev_samp(c) AS sc FROM tr),
d AS (SELECT dist, row_number() OVER (ORDER BY dist) - 1 AS i, count(*) OVER () AS k FROM (SELECT DISTINCT dist FROM tr))
SELECT dist, hour_ts, {SCALED.format(c='a')} AS mean_scaled, {SCALED.format(c='b')} AS click_scaled, {SCALED.format(c='c')} AS n_scaled, CAST(mean IS NOT NULL AS INT) AS has_mean, CAST(click_mean IS NOT NULL AS INT) AS has_click,
CAST(CASE WHEN i < k - 1 THEN i END AS INT) AS dist_hot, CAST(CASE WHEN hour < 23 THEN hour END AS INT) AS hour_hot, CAST(CASE WHEN weekday < 7 THEN weekday - 1 END AS INT) AS weekday_hot, CAST(3 + 2 + k - 1 + 23 + 6 AS INT) AS size FROM x JOIN d USING (dist), s""")
def ml_preprocess(spark, sf):
    """What each vector holds: scaled numbers, flags, and the place of the one in the part of each category (null: the last label)."""
    rows, sizes = preprocessed(spark, sf)
    x, at, out = F.col("features"), 6, {}
    for name, k in zip(("dist", "hour", "weekday"), sizes, strict=True):
        place = F.array_position(F.slice(x, at, k - 1), F.lit(1.0))
        out[f"{name}_hot"], at = F.when(place > 0, place - 1).cast("int"), at + k - 1
    numbers = {n: F.round(x[i], 4) for i, n in enumerate(("mean_scaled", "click_scaled", "n_scaled"))} | {"has_mean": x[3].cast("int"), "has_click": x[4].cast("int")}
    return rows.withColumns(numbers | out | {"size": F.size(x)}).drop("features")


MEDIANS = ", ".join(f"('{c}', {i})" for i, c in enumerate(sorted(("mean", "click_mean", "n"))))
HALF = "(SELECT quantile_disc({c}, 0.5) FROM f WHERE {c} IS NOT NULL)"


@query(f"""WITH {FEATURES}, f AS (SELECT dist, hour_ts, mean, coalesce(n, 0)::DOUBLE AS n, click_mean FROM labels1 LEFT JOIN h USING (dist, hour_ts) LEFT JOIN p USING (dist, hour_ts)),
x AS (SELECT coalesce(mean, {HALF.format(c='mean')}) AS a, coalesce(click_mean, {HALF.format(c='click_mean')}) AS b, n AS c FROM f)
SELECT 'median' AS stage, m AS name, CAST(i AS INT) AS position, round(CASE m WHEN 'mean' THEN {HALF.format(c='mean')} WHEN 'click_mean' THEN {HALF.format(c='click_mean')} ELSE {HALF.format(c='n')} END, 4) AS value FROM (VALUES {MEDIANS}) AS t(m, i)
UNION ALL SELECT s, 'scaled', CAST(i AS INT), round(v, 4) FROM (SELECT 'mean' AS s, 0 AS i, avg(a) AS v FROM x UNION ALL SELECT 'mean', 1, avg(b) FROM x UNION ALL SELECT 'mean', 2, avg(c) FROM x UNION ALL SELECT 'std', 0, stddev_samp(a) FROM x UNION ALL SELECT 'std', 1, stddev_samp(b) FROM x UNION ALL SELECT 'std', 2, stddev_samp(c) FROM x)
UNION ALL SELECT 'label', 'dist_cat=' || lpad(CAST(dist AS VARCHAR), 2, '0'), CAST(row_number() OVER (ORDER BY dist) - 1 AS INT), row_number() OVER (ORDER BY dist) - 1.0 FROM (SELECT DISTINCT dist FROM f)
UNION ALL SELECT 'label', 'hour_cat=' || lpad(CAST(k AS VARCHAR), 2, '0'), CAST(k AS INT), CAST(k AS DOUBLE) FROM (SELECT DISTINCT hour(hour_ts) AS k FROM f)
UNION ALL SELECT 'label', 'weekday_cat=' || lpad(CAST(k AS VARCHAR), 2, '0'), CAST(k - 1 AS INT), k - 1.0 FROM (SELECT DISTINCT dayofweek(hour_ts) + 1 AS k FROM f)""")
def ml_fitted_state(spark, sf):
    return ml.fitted_state(ml.fit_preprocess(feature_frame(spark, sf), NUMERIC, FLAGS, CATEGORIES, median_error=0.0)).withColumn("value", F.round("value", 4))


def fitted(spark, sf):
    df = feature_frame(spark, sf)
    return df, ml.fit_logistic(df.where(early("2024-01-25 00:00:00")), "target_next_hour", NUMERIC, FLAGS, CATEGORIES)


#: Scores of the pipeline and of its learned numbers may differ by so much; the gradient at the optimum is below GRADIENT.
SAME, GRADIENT = 1e-9, 1e-4


def both_scores(model, df, keep):
    """score of the pipeline, and whether the learned numbers alone give the same."""
    rows = model.transform(df)
    own = ml.score_by_state(rows.withColumn("whole", ml.probability()), ml.fitted_state(model), NUMERIC, FLAGS, CATEGORIES, [*keep, "whole"])
    return own.select(*keep, F.col("whole").alias("score"), (F.abs(F.col("score") - F.col("whole")) < SAME).alias("agrees"))


@query(f"WITH {FRAME} SELECT dist, hour_ts, target_next_hour, TRUE AS agrees, TRUE AS within, TRUE AS optimal FROM f WHERE hour_ts >= TIMESTAMP '2024-01-25'")
def ml_logistic(spark, sf):
    """Held-out rows, each scored by the pipeline and by SQL from its coefficients; the coefficients are the optimum of the penalised loss."""
    df, model = fitted(spark, sf)
    worst = ml.gradient(model, df.where(early("2024-01-25 00:00:00")), "target_next_hour").agg((F.max(F.abs("value")) < GRADIENT).alias("optimal"))
    rows = both_scores(model, df.where(~early("2024-01-25 00:00:00")), ["dist", "hour_ts", "target_next_hour"])
    return rows.join(F.broadcast(worst)).select("dist", "hour_ts", "target_next_hour", "agrees", F.col("score").between(0, 1).alias("within"), "optimal")


def scored_batch(spark, sf):
    """The newest hour of the grid, scored, stamped and published twice; what is read back is the current batch."""
    df, model = fitted(spark, sf)
    newest = df.agg(F.max("hour_ts").alias("newest"))
    batch = df.join(F.broadcast(newest), F.col("hour_ts") == F.col("newest")).drop("newest")
    scores = both_scores(model, batch, ["dist", "hour_ts"]).withColumns({"model": F.lit("logistic"), "window_end": F.expr("hour_ts + INTERVAL 1 HOUR")})
    path = f"{work_dir(spark)}/predictions"
    for rows in (scores.withColumn("hour_ts", F.expr("hour_ts - INTERVAL 1 HOUR")), scores, scores):
        nrt.publish(rows, districts(spark, sf), path, "dist", "hour_ts", "score")
    return nrt.current(nrt.published(scores, path), "hour_ts")


@query(f"WITH {FRAME} SELECT dist, hour_ts, TRUE AS agrees, 'logistic' AS model, hour_ts + INTERVAL 1 HOUR AS window_end, TRUE AS within FROM f WHERE hour_ts = (SELECT max(hour_ts) FROM f)")
def score_batch(spark, sf):
    return scored_batch(spark, sf).withColumn("within", F.col("score").between(0, 1)).drop("score")


FOLD_HOURS = {"fold1": ("2024-01-11 00:00:00", "2024-01-18 00:00:00"), "fold2": ("2024-01-18 00:00:00", "2024-01-25 00:00:00")}


def backtest(spark, sf):
    folds = {name: (early(a), ~early(a) & early(b)) for name, (a, b) in FOLD_HOURS.items()}
    return ml.backtest(feature_frame(spark, sf), folds, "target_next_hour", NUMERIC, FLAGS, CATEGORIES)


@query(f"WITH {FRAME} " + " UNION ALL ".join(f"SELECT '{k}' AS fold, count(*) AS n, sum(target_next_hour)::BIGINT AS positives, round(avg(target_next_hour), 4) AS prevalence, sum(target_next_hour) BETWEEN 1 AND count(*) - 1 AS evaluable, sum(target_next_hour) BETWEEN 1 AND count(*) - 1 AS scored FROM f WHERE hour_ts >= TIMESTAMP '{a}' AND hour_ts < TIMESTAMP '{b}'" for k, (a, b) in FOLD_HOURS.items()))
def backtest_scores(spark, sf):
    """Folds with their sizes, and whether each has metrics within their ranges."""
    within = F.coalesce(F.col("average_precision").between(0, 1) & F.col("roc_auc").between(0, 1) & F.col("brier").between(0, 1), F.lit(False))
    return backtest(spark, sf).select("fold", "n", "positives", F.round("prevalence", 4).alias("prevalence"), "evaluable", within.alias("scored"))


PERIODS = {"validation": ("2024-01-20 00:00:00", "2024-01-25 00:00:00"), "evaluation": ("2024-01-25 00:00:00", None)}


def trained_reports(spark, sf):
    """A model of the hours before all periods, and what is said of it in each: the whole, weekdays, curve and calibration."""
    df = feature_frame(spark, sf)
    model = ml.fit_logistic(df.where(early(PERIODS["validation"][0])), "target_next_hour", NUMERIC, FLAGS, CATEGORIES)
    # Scored once: all parts of both periods read the written scores.
    scores = materialized(ml.score(model, df.where(~early(PERIODS["validation"][0])), ["hour_ts", "target_next_hour", "weekday"]))
    periods = {name: scores.where(aggregates.half_open("hour_ts", a, b)).drop("hour_ts") for name, (a, b) in PERIODS.items()}
    return {name: evaluation.report(rows, "target_next_hour", "score", ["weekday"]) for name, rows in periods.items()}


PERIOD_SQL = f"WITH {FRAME}, q AS (SELECT *, CASE WHEN hour_ts < TIMESTAMP '2024-01-25' THEN 'validation' ELSE 'evaluation' END AS period FROM f WHERE hour_ts >= TIMESTAMP '2024-01-20')"
COUNTS = "count(*) AS n, sum(target_next_hour)::BIGINT AS positives, TRUE AS holds FROM q GROUP BY"


@query(f"""{PERIOD_SQL} SELECT period, 'global' AS part, NULL::INT AS weekday, {COUNTS} period UNION ALL SELECT period, 'weekday', weekday, {COUNTS} period, weekday
UNION ALL SELECT period, 'calibration', NULL, {COUNTS} period UNION ALL SELECT period, 'curve', NULL, {COUNTS} period""")
def train_evaluate(spark, sf):
    """Both periods of one job: sizes of each part, and whether its numbers hold together.

    Metrics lie within their ranges; the bins of the calibration sum up to the period, each with a mean score between its
    bounds; the curve's lowest threshold takes all rows in, so its precision is the prevalence and its recall, where there
    is a positive, 1 and the highest. Hours of one class only teach a model that gives all rows the same score: then the
    curve has one point, and the Brier score follows from it. A period without rows has no parts.
    """
    out, whole = None, F.lit(None).cast("int")
    rows = lambda df, period, part, weekday: df.where("n > 0").select(F.lit(period).alias("period"), F.lit(part).alias("part"), weekday.alias("weekday"), "n", "positives", "holds")
    for period, report in trained_reports(spark, sf).items():
        parts = {part: materialized(df) for part, df in report.items()}  # some rows each; one plan of all parts would fill the driver
        ok = F.when(F.col("evaluable"), F.col("average_precision").between(0, 1) & F.col("roc_auc").between(0, 1)).otherwise(F.col("roc_auc").isNull()) & F.col("brier").between(0, 1)
        in_bin = F.col("mean_score").between(F.col("bin") / 10 - SAME, (F.col("bin") + 1) / 10 + SAME)
        bins = parts["calibration"].agg(F.sum("n").alias("n"), F.sum(F.round(F.col("n") * F.col("rate"))).cast("bigint").alias("positives"), F.min(in_bin).alias("holds"))
        sizes = parts["global"].select("n", "positives", F.col("prevalence").alias("share"), "brier")
        low = parts["curve"].agg(F.min(F.struct("threshold", "precision", "recall")).alias("low"), F.max("recall").alias("top"), F.count("*").alias("points"))
        recall = F.when(F.col("positives") > 0, (F.col("low.recall") == 1) & (F.col("top") == 1)).otherwise(F.col("top").isNull())
        alone = F.col("share") * F.pow(F.col("low.threshold") - 1, 2) + (1 - F.col("share")) * F.pow("low.threshold", F.lit(2))
        points = F.col("points").between(2, 101) | ((F.col("points") == 1) & (F.abs(F.col("brier") - alone) < SAME))
        curve = sizes.join(F.broadcast(low)).select("n", "positives", ((F.abs(F.col("low.precision") - F.col("share")) < SAME) & recall & points).alias("holds"))
        for df, part, weekday in ((parts["global"].withColumn("holds", ok), "global", whole), (parts["weekday"].withColumn("holds", ok), "weekday", F.col("weekday")), (bins, "calibration", whole), (curve, "curve", whole)):
            out = rows(df, period, part, weekday) if out is None else out.unionByName(rows(df, period, part, weekday))
    return out


@query(f"WITH {FRAME} SELECT count(*) AS n, 0.0::DOUBLE AS max_difference FROM f WHERE hour_ts >= TIMESTAMP '2024-01-25'")
def model_roundtrip(spark, sf):
    """The largest difference of scores after saving and loading the pipeline."""
    df, model = fitted(spark, sf)
    path = f"{work_dir(spark)}/model"
    model.write().overwrite().save(path)
    rows = df.where(~early("2024-01-25 00:00:00"))
    a, b = (ml.score(m, rows, ["dist", "hour_ts"]) for m in (model, PipelineModel.load(path)))
    return a.join(b.withColumnRenamed("score", "again"), ["dist", "hour_ts"]).agg(F.count("*").alias("n"), F.max(F.abs(F.col("score") - F.col("again"))).alias("max_difference"))
