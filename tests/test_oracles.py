"""Every query of the library with SQL, against DuckDB on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.oracle import duck, rows
from urbanflow.operators import ml
from urbanflow.plans import basics, jobs, models, registry  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, name):
    got, want = registry.QUERIES[name](spark, SF).toPandas(), duck(SF, registry.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_preprocessed_vectors(spark):
    """Scaled numbers have mean 0 and deviation 1 over the rows that were fitted; flags are 0 or 1, categories one-hot."""
    df, sizes = models.preprocessed(spark, SF)
    rows = df.toPandas()
    x = np.array([v for v, h in zip(rows["features"], rows["hour_ts"], strict=True) if h < pd.Timestamp("2024-01-25")])
    k = rows["dist"].nunique()
    assert sizes == [k, 24, 7] and x.shape[1] == 3 + 2 + k - 1 + 23 + 6 and np.isfinite(x).all()
    assert np.abs(x[:, :3].mean(axis=0)).max() < 1e-6 and np.abs(x[:, :3].std(axis=0, ddof=1) - 1).max() < 1e-6
    assert set(np.unique(x[:, 3:])) == {0.0, 1.0} and x[:, 5 : 4 + k].sum(axis=1).max() == 1


def auc(y, s):
    good, bad = s[y == 1], s[y == 0]
    return ((good[:, None] > bad) + (good[:, None] == bad) / 2).mean()


def test_a_fit_is_the_optimum_and_its_numbers_score_alike(spark):
    """A plain Newton iteration over the same vectors and penalty comes to the same weights."""
    df, model = models.fitted(spark, SF)
    train = model.transform(df.where(models.early("2024-01-25 00:00:00"))).toPandas()
    x = np.array([v.toArray() for v in train["features"]])
    y, spread = train["target_next_hour"].to_numpy(), np.r_[x.var(axis=0, ddof=1), 0]
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.pinv((x.T * (p * (1 - p))) @ x / len(x) + np.diag(0.1 * spread)) @ (x.T @ (p - y) / len(x) + 0.1 * spread * w)
    state = {r.name: r.value for r in ml.fitted_state(model).where("stage = 'weight'").collect()}
    assert np.abs(np.array(list(state.values())) - w).max() < 1e-3 and len(state) == len(w) and list(state)[-1] == "intercept"
    odd = df.limit(5).withColumns({"mean": F.lit(float("nan")), "click_mean": F.lit(None).cast("double")})
    for rows in (df, odd):
        assert models.both_scores(model, rows, ["dist"]).where("not agrees").isEmpty()
    unknown = ml.score_by_state(df.limit(1).withColumn("dist_cat", F.lit("99")), ml.fitted_state(model), models.NUMERIC, models.FLAGS, models.CATEGORIES, [])
    assert unknown.first().score is None


def test_reports_follow_from_the_scores(spark):
    df, model = models.feature_frame(spark, SF), None
    model = ml.fit_logistic(df.where(models.early("2024-01-20 00:00:00")), "target_next_hour", models.NUMERIC, models.FLAGS, models.CATEGORIES)
    rows = ml.score(model, df.where(~models.early("2024-01-25 00:00:00")), ["target_next_hour", "weekday"]).toPandas()
    y, s = rows["target_next_hour"].to_numpy(), rows["score"].to_numpy()
    reports = models.trained_reports(spark, SF)
    assert set(reports) == {"validation", "evaluation"} and all(set(r) == {"global", "weekday", "curve", "calibration"} for r in reports.values())
    whole = reports["evaluation"]["global"].first()
    assert (whole.n, whole.positives) == (len(y), y.sum()) and abs(whole.roc_auc - auc(y, s)) < 1e-6 and abs(whole.brier - ((s - y) ** 2).mean()) < 1e-6
    folds = {r.fold: r for r in models.backtest(spark, SF).collect()}
    assert set(folds) == {"fold1", "fold2"} and all(r.n == 15 * 7 * 24 and 0 <= r.roc_auc <= 1 for r in folds.values())


@pytest.mark.parametrize(("kind", "to"), [("'error'", "2024-01-27"), ("'click'", "2024-01-23")])
def test_hours_of_one_class_are_evaluated(spark, tmp_path, kind, to):
    """Each hour has an incident, so nearly all labels are 1; or none has, and the last period has no rows either."""
    con, at = duckdb.connect(), f"{tmp_path}/events.parquet"
    times = f"unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '{to}', INTERVAL 1 HOUR))"
    con.execute(f"CREATE TABLE events AS SELECT row_number() OVER () AS event_id, ts, u AS user_id, k AS event_type, v AS value, '{{}}' AS props FROM (SELECT {times} AS ts), (VALUES (0, {kind}, 1.5), (1, {kind}, 2.5), (1, 'click', 3.0)) AS t(u, k, v)")
    con.execute("ALTER TABLE events ALTER user_id TYPE BIGINT")
    con.execute("ALTER TABLE events ALTER value TYPE DOUBLE")
    con.execute(f"COPY events TO '{at}' (FORMAT parquet)")
    got, want = registry.QUERIES["train_evaluate"](spark, str(tmp_path)).toPandas(), con.execute(registry.ORACLES["train_evaluate"]).df()
    assert rows(got) == rows(want) and got["holds"].all() and got["period"].nunique() == (2 if kind == "'error'" else 1)


def test_no_query_is_without_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
