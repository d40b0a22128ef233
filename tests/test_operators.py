"""Exact values of small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from urbanflow.operators import aggregates, columns, dedup, evaluation, joins, ml, nrt, quality, reshape, silver
from urbanflow.sources import tables, versioned

T = lambda s: dt.datetime.fromisoformat(s)


def test_names():
    names = {"Estación Ñandú": "estacion_nandu", "ZonaBaja": "zona_baja", "flow (veh/h)": "flow_veh_h", "7días": "_7dias", "__raw": "_raw", "caudalMedioDiario": "caudal_medio_diario", "3": "_3"}
    assert {x: columns.normal_name(x) for x in names} == names
    for empty in ("", "?!", "  "):
        with pytest.raises(ValueError):
            columns.normal_name(empty)


def test_tied_scores(spark):
    """Three tie groups; the expected values follow from all pairs of a positive and a negative, and from precision by group."""
    pairs = [(0, 0.7), (1, 0.7), (1, 0.7), (0, 0.3), (1, 0.3), (0, 0.05)]
    pos, neg = ([s for y, s in pairs if y == k] for k in (1, 0))
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / 9
    precision = 2 / 3 * (2 / 3) + 1 / 3 * (3 / 5)  # two of three positives at 2 of 3, the last at 3 of 5
    r = evaluation.binary_metrics(spark.createDataFrame(pairs, "y int, s double"), "y", "s").first()
    assert abs(r.average_precision - precision) < 1e-12 and abs(r.roc_auc - auc) < 1e-12 and abs(r.brier - sum((s - y) ** 2 for y, s in pairs) / 6) < 1e-12


def test_single_class_segment_is_kept(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("b", 1, 0.5), ("b", 0, 0.4)], "g string, y int, s double")
    got = {r.g: (r.evaluable, r.roc_auc) for r in evaluation.binary_metrics(df, "y", "s", ["g"]).collect()}
    assert got == {"a": (False, None), "b": (True, 1.0)}


def test_baseline_falls_back(spark):
    train = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (1, 2, 0), (2, 1, 1)], "e int, h int, y int")
    frame = spark.createDataFrame([(1, 1), (1, 9), (9, 9)], "e int, h int")
    got = sorted(round(r.baseline, 4) for r in evaluation.baseline_fallback(frame, evaluation.baseline_rates(train, "y", "e", ["h"]), "e", ["h"]).collect())
    assert got == [0.3333, 0.5, 0.5]


def events_of(spark, rows):
    return spark.createDataFrame(rows, "event string, ts timestamp_ntz, e int")


def test_lead_label(spark):
    grid = spark.createDataFrame([(4, T("2023-06-30 22:00")), (4, T("2023-06-30 23:00"))], "e int, hour_ts timestamp_ntz")
    label = lambda rows, required: {r.hour_ts.hour: (r.n_next_hour, r.target_next_hour) for r in aggregates.lead_hour_label(grid, events_of(spark, rows), "e", "event", "ts", required).collect()}
    # One crash in several rows counts once; midnight belongs to the hour after 23; what is two hours off counts nowhere.
    crash = [("crash", T("2023-06-30 23:59:59"), 4), ("crash", T("2023-06-30 23:00:00"), 4), ("bike", T("2023-07-01 00:00:00"), 4), ("late", T("2023-07-01 01:00:00"), 4)]
    assert label(crash, ["event", "ts", "e"]) == {22: (1, 1), 23: (1, 1)}
    assert label([*crash, ("crash", T("2023-06-30 23:10"), None)], ["event", "ts", "e"]) == {22: (0, 0), 23: (1, 1)}
    for odd in ([("far", T("2023-06-30 23:10"), 5)], [("two", T("2023-06-30 22:10"), 4), ("two", T("2023-06-30 23:10"), 4)]):
        with pytest.raises(ValueError):
            label(odd, ["e"])


def test_rolling_window_counts_the_cutoffs_minute(spark):
    at = {"06:29:59.999": False, "06:30:00": True, "07:30:00": True, "08:30:59.999": True, "08:31:00": False, "08:45:00": False}
    df = spark.createDataFrame([(T(f"2022-11-05 {x}"), x) for x in at], "ts timestamp_ntz, x string")
    assert {r.x for r in aggregates.rolling_window(df, "ts", "2022-11-05 08:30:00", 2).collect()} == {x for x, inside in at.items() if inside}


def test_snapshot_per_partition(spark):
    d = dt.date
    df = spark.createDataFrame([(2025, "a", d(2026, 1, 1)), (2026, "b", d(2026, 1, 1)), (2026, "c", d(2026, 1, 2)), (2026, "d", d(2026, 1, 2))], "anio int, p string, day date")
    assert sorted(r.p for r in dedup.latest_partition_snapshot(df, ["anio"], "day").collect()) == ["a", "c", "d"]


def test_ranges(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (-1.0,), (10.0,), (None,), (float("inf"),)], "v double")
    got = [(r.v, r.v_available) for r in quality.sanitize_ranges(df, {"v": (0.0, True, 10.0, False)}).collect()]
    assert got == [(1.0, 1), (None, 0), (None, 0), (None, 0), (None, 0), (None, 0)]


def test_grid_difference(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "k int") for xs in ((1, 2), (1, 3)))
    assert {(r.k, r.side) for r in joins.key_diff(a, b, ["k"]).collect()} == {(2, "missing"), (3, "extra")}


def test_scan_is_pruned_and_pushed(spark):
    df = columns.select(columns.filter_expr(spark.read.parquet("/root/testdata/sf0.001/part.parquet"), "p_size > 10"), ["p_partkey"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(p_size,10)" in plan and "ReadSchema: struct<p_partkey:bigint,p_size:int>" in plan
    assert F is not None


def test_safe_labels():
    assert columns.safe_labels(["NO2", "no2", "---", "2019", "pm 2.5"], "m_") == {"NO2": "m_no2", "no2": "m_no2_2", "---": "m_value", "2019": "m_2019", "pm 2.5": "m_pm_2_5"}


def test_clashing_names(spark):
    with pytest.raises(ValueError):
        columns.normalize_column_names(spark.createDataFrame([(1, 2)], "`a b` int, `A-b` int"))
    with pytest.raises(ValueError):
        columns.check_names(spark.createDataFrame([(1,)], "`aB` int"))


def test_all_dates_null_fails(spark):
    rows = spark.createDataFrame([(1, None)], "k int, day date")
    with pytest.raises(ValueError):
        dedup.latest_file_snapshot(rows, "day")
    assert dedup.latest_file_snapshot(rows.limit(0), "day").count() == 0


def test_times_that_zones_skip(spark):
    """The hour that Madrid skips and the one that it has twice, under a session in Madrid."""
    from urbanflow.functions import temporal

    df = spark.createDataFrame([("31/03/2024 02:30:00",), ("27/10/2024 02:30:00",), ("no date",), (None,)], "x string")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Madrid")
    try:
        got = df.select(temporal.parse_timestamp(["x"], "dd/MM/yyyy HH:mm:ss", "null").cast("string").alias("t")).collect()
        local = spark.createDataFrame([(T("2024-03-31 00:59"),), (T("2024-03-31 01:00"),), (T("2024-07-01 10:19"),), (T("2024-10-27 00:30"),), (T("2024-10-27 01:30"),)], "ts timestamp_ntz")
        floors = [r.t for r in local.select(temporal.floor_minutes("ts", "Europe/Madrid").cast("string").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.t for r in got] == ["2024-03-31 02:30:00", "2024-10-27 02:30:00", None, None]
    assert floors == ["2024-03-31 01:50:00", "2024-03-31 03:00:00", "2024-07-01 12:10:00", "2024-10-27 02:30:00", "2024-10-27 02:30:00"]


def test_scores_and_labels_are_checked(spark):
    for y, s in ((1, 1.5), (2, 0.5), (None, 0.5), (1, None), (1, float("nan"))):
        with pytest.raises(Exception, match="must be 0 or 1"):
            evaluation.binary_metrics(spark.createDataFrame([(y, s), (0, 0.1)], "y int, s double"), "y", "s").collect()


def test_gates(spark):
    grid = spark.createDataFrame([(1, T("2024-01-01 00:00")), (1, T("2024-01-01 01:00")), (2, T("2024-01-01 01:00"))], "e int, h timestamp_ntz")
    with pytest.raises(ValueError, match="n_missing"):
        quality.require(quality.grid_problems(grid, "e", "h"), "grid")
    same = columns.contract_select(grid, [("e", "int"), ("h", "timestamp_ntz")])
    assert quality.schema_problems(same, [("e", "int", True), ("h", "timestamp_ntz", True)]).count() == 0
    with pytest.raises(ValueError, match="no valid value"):
        ml.fit_preprocess(spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "a double, b double"), ["a", "b"], [], [])
    with pytest.raises(ValueError, match="no rows"):
        reshape.conditional_pivot(grid.withColumn("k", F.lit("a")), ["h"], "k", "e", ["a", "b"], required=True)


def test_multiset_difference_goes_both_ways(spark):
    a, b = (spark.createDataFrame([(x,) for x in xs], "k int") for xs in ((1, 1, None, 2), (1, 3, None, None)))
    assert {tuple(r) for r in joins.multiset_difference(a, b).collect()} == {(1, "left", 1), (2, "left", 1), (3, "right", 1), (None, "right", 1)}


def test_multiset_difference_holds_one_table_a_task(spark):
    """One aggregate before and one behind a single shuffle; rows that only one side has or that are equally often in both count alike."""
    a, b = (spark.createDataFrame([(x, y) for x, y in xs], "k int, v string") for xs in ([(1, "a"), (1, "a"), (2, None)], [(2, None), (1, "b"), (1, "a")]))
    out = joins.multiset_difference(a, b.select("v", "k"))
    plan = out._jdf.queryExecution().sparkPlan().toString(), out._jdf.queryExecution().executedPlan().toString()
    assert (plan[0].count("HashAggregate("), plan[1].count("Exchange hashpartitioning")) == (2, 1)
    assert sorted(map(tuple, out.collect())) == [(1, "a", "left", 1), (1, "b", "right", 1)] and out.schema["times"].dataType.simpleString() == "bigint"


def test_silver_goes_on_where_it_was(spark, tmp_path):
    path, steps, day = f"file://{tmp_path}/s", [("trim", {"columns": ["v"]})], dt.date
    rows = [(1, " a", day(2024, 1, 1)), (2, "b ", day(2024, 1, 2))]
    silver.run(spark.createDataFrame(rows, "k int, v string, d date"), path, steps, "append", watermark="d", snapshot="d")
    more = [*rows, (3, " c", day(2024, 1, 3)), (4, "d", day(2024, 1, 4))]
    out = silver.run(spark.createDataFrame(more, "k int, v string, d date"), path, steps, "append", watermark="d", snapshot="d")
    assert sorted((r.k, r.v) for r in out.collect()) == [(2, "b"), (4, "d")] and out.where("_processed_at is null").count() == 0


def test_incomplete_batches_are_not_published(spark, tmp_path):
    path, all_of = f"file://{tmp_path}/p", spark.range(1, 4).select(F.col("id").cast("int").alias("e"))
    batch = all_of.select("e", F.lit(T("2024-01-01 10:00")).cast("timestamp_ntz").alias("w"), F.lit(0.5).alias("s"))
    with pytest.raises(ValueError, match="n_missing"):
        nrt.publish(batch.where("e < 3"), all_of, path, "e", "w", "s")
    assert not versioned.exists(spark, path)
    nrt.publish(batch, all_of, path, "e", "w", "s")
    assert nrt.current(nrt.published(batch, path), "w").count() == 3


def test_tables_that_may_be_absent(spark, tmp_path):
    assert tables.read_optional(spark, f"file://{tmp_path}/none") is None
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.read_optional(spark, f"file://{tmp_path}/none", required=True)
    spark.range(2).write.parquet(f"file://{tmp_path}/t")
    assert tables.read_optional(spark, f"file://{tmp_path}/t").count() == 2


def test_latin1_files(spark, tmp_path):
    from urbanflow.streaming.ingest import append_available, csv_stream

    path = f"file://{tmp_path}/t"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes("k;v\n1;niño\n".encode("latin-1"))
    append_available(csv_stream(spark, f"file://{tmp_path}/in", "k int, v string", encoding="ISO-8859-1"), path, f"{path}3")
    assert spark.read.parquet(path).first().v == "niño"


def test_work_folders_go(spark):
    path = tables.work_dir(spark)
    spark.range(3).write.parquet(f"{path}/t")
    assert tables.exists(spark, path)
    tables.clear(spark)
    assert not tables.exists(spark, path)
