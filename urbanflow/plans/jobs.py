"""Composite jobs (dimensions, facts, integrated table, snapshots), quality gates, sinks and streams over the standard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanflow.functions.temporal import day_part
from urbanflow.operators import columns, dedup, joins, nrt, quality, reshape, silver, sinks, snapshots
from urbanflow.plans.basics import LABELS, SIDES, label_rows, lead_hour_label, outer_sides
from urbanflow.plans.frames import EV, PART, districts, events, incidents, measured
from urbanflow.plans.registry import query
from urbanflow.sources import tables, versioned
from urbanflow.sources.tables import read, work_dir

# Facts and dimensions

PEOPLE = "sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS n_serious, sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)::BIGINT AS n_injured, count(*) AS n_people, max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::INT AS any_open"


def event_people(df):
    """People per event by injury class, and whether any of them is open."""
    flag = lambda v: quality.count_if(F.col("l_returnflag") == v, "x")
    return df.groupBy("l_orderkey").agg(flag("R").alias("n_serious"), flag("A").alias("n_injured"), F.count("*").alias("n_people"), F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("any_open"))


@query(f"SELECT l_orderkey, {PEOPLE} FROM lineitem GROUP BY l_orderkey")
def gold_event_people(spark, sf):
    return event_people(read(spark, sf, "lineitem"))


ORDER = "l_shipdate DESC NULLS LAST, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"


@query(f"""WITH p AS (SELECT l_orderkey, {PEOPLE} FROM lineitem GROUP BY l_orderkey), r AS (SELECT l_orderkey, l_partkey, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {ORDER}) = 1)
SELECT l_orderkey, l_partkey, l_shipdate, n_serious, n_injured, n_people, any_open, CASE WHEN n_serious > 2 THEN 'fatal' WHEN n_serious > 0 THEN 'serious' WHEN n_injured > 0 THEN 'injury' ELSE 'none' END AS severity FROM r JOIN p USING (l_orderkey)""")
def gold_event_detail(spark, sf):
    df = read(spark, sf, "lineitem")
    order = [F.col("l_shipdate").desc_nulls_last(), *(F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"))]
    one = dedup.deduplicate(df, ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_shipdate")
    severity = F.when(F.col("n_serious") > 2, "fatal").when(F.col("n_serious") > 0, "serious").when(F.col("n_injured") > 0, "injury").otherwise("none")
    return one.join(event_people(df), "l_orderkey", "left").withColumn("severity", severity)


@query(f"WITH {EV} SELECT user_id, hour_ts, round(avg(value), 4) AS mean, max(value) AS highest, count(*) AS n, min(event_type) AS kind FROM ev WHERE value > 0 GROUP BY user_id, hour_ts")
def gold_measure_point_hour(spark, sf):
    value = F.when(F.col("value") > 0, F.col("value"))
    rows = events(spark, sf).withColumn("value", value).where("value is not null")
    return rows.groupBy("user_id", "hour_ts").agg(F.round(F.avg("value"), 4).alias("mean"), F.max("value").alias("highest"), F.count("*").alias("n"), F.min("event_type").alias("kind"))


@query(f"""WITH {EV}, p AS (SELECT dist, user_id, hour_ts, avg(value) AS mean, max(value) AS highest, count(*) AS n, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS bad FROM ev GROUP BY ALL)
SELECT dist, hour_ts, count(DISTINCT user_id) AS n_points, round(avg(mean), 4) AS mean, max(highest) AS highest, sum(n)::BIGINT AS n, round(sum(bad) / sum(n), 4) AS bad_ratio FROM p GROUP BY dist, hour_ts""")
def gold_measure_region_hour(spark, sf):
    bad = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0))
    p = events(spark, sf).groupBy("dist", "user_id", "hour_ts").agg(F.avg("value").alias("mean"), F.max("value").alias("highest"), F.count("*").alias("n"), bad.alias("bad"))
    return p.groupBy("dist", "hour_ts").agg(F.countDistinct("user_id").alias("n_points"), F.round(F.avg("mean"), 4).alias("mean"), F.max("highest").alias("highest"), F.sum("n").alias("n"), F.round(F.sum("bad") / F.sum("n"), 4).alias("bad_ratio"))


@query("""SELECT 'supplier' AS kind, s_suppkey AS key, max(s_name) AS name FROM supplier WHERE s_suppkey IS NOT NULL GROUP BY s_suppkey UNION ALL SELECT 'nation', n_nationkey, max(n_name) FROM nation GROUP BY n_nationkey
UNION ALL SELECT 'customer', c_custkey, max(c_name) FROM customer WHERE c_custkey IS NOT NULL GROUP BY c_custkey""")
def gold_dim_entity(spark, sf):
    out = None
    for kind in ("supplier", "nation", "customer"):
        df = read(spark, sf, kind)
        rows = df.select(F.lit(kind).alias("kind"), columns.first_present(df, ["s_suppkey", "n_nationkey", "c_custkey"], "bigint").alias("key"), columns.first_present(df, ["s_name", "n_name", "c_name"], "string").alias("name"))
        rows = rows.where("key is not null").groupBy("kind", "key").agg(F.max("name").alias("name"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(f"""WITH {EV} SELECT user_id, hour_ts, event_type, n_name AS place, r_name AS region, round(avg(value), 4) AS mean, count(*) AS n FROM ev LEFT JOIN nation ON n_nationkey = user_id % 25 LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def gold_environment_hour(spark, sf):
    df = events(spark, sf)
    stations = F.col("event_type").isin("view", "click")
    rows = df.where(stations).unionByName(df.where(~F.coalesce(stations, F.lit(False)))).withColumn("place_key", (F.col("user_id") % 25).cast("int"))
    rows = rows.groupBy("user_id", "place_key", "hour_ts", "event_type").agg(F.round(F.avg("value"), 4).alias("mean"), F.count("*").alias("n"))
    rows = joins.lookup_join(rows, read(spark, sf, "nation"), {"place_key": "n_nationkey"}, {"place": "n_name", "region_key": "n_regionkey"})
    rows = joins.lookup_join(rows, read(spark, sf, "region"), {"region_key": "r_regionkey"}, {"region": "r_name"})
    return rows.select("user_id", "hour_ts", "event_type", "place", "region", "mean", "n")


@query(f"WITH {EV} SELECT dist, hour_ts, count(*) AS n_signups FROM ev WHERE event_type = 'signup' GROUP BY dist, hour_ts")
def gold_calendar_events_hour(spark, sf):
    return events(spark, sf).where("event_type = 'signup'").groupBy("dist", "hour_ts").agg(F.count("*").alias("n_signups"))


@query(f"""WITH {SIDES}, w AS (SELECT dist, hour_ts, round(avg(value) FILTER (event_type = 'click'), 4) AS click, round(avg(value) FILTER (event_type = 'view'), 4) AS view FROM ev GROUP BY ALL),
s AS (SELECT dist, hour_ts, count(*) AS n_signups FROM ev WHERE event_type = 'signup' GROUP BY ALL),
o AS (SELECT coalesce(a.dist, b.dist) AS dist, coalesce(a.hour_ts, b.hour_ts) AS hour_ts, coalesce(n_err, 0) AS n_err, mean_purchase, a.hour_ts IS NOT NULL AS has_err, b.hour_ts IS NOT NULL AS has_purchase FROM a FULL JOIN b ON a.dist IS NOT DISTINCT FROM b.dist AND a.hour_ts = b.hour_ts)
SELECT dist, hour_ts, n_err, mean_purchase, has_err, has_purchase, click, view, coalesce(n_signups, 0) AS n_signups, CAST(dayofweek(hour_ts) + 1 AS INT) AS weekday, {PART.format(h='hour(hour_ts)')} AS day_part
FROM o LEFT JOIN w USING (dist, hour_ts) LEFT JOIN s USING (dist, hour_ts)""")
def gold_integrated_hour(spark, sf):
    """Incidents and traffic in one, with pivoted measures and calendar events, per district and hour."""
    both = joins.full_outer(*outer_sides(spark, sf), ["dist", "hour_ts"], ("has_err", "has_purchase"))
    df = events(spark, sf)
    wide = reshape.pivot_wide(df, ["dist", "hour_ts"], "event_type", "value", ["click", "view"]).withColumns({c: F.round(c, 4) for c in ("click", "view")})
    out = both.join(wide, ["dist", "hour_ts"], "left").join(gold_calendar_events_hour(spark, sf), ["dist", "hour_ts"], "left").fillna(0, ["n_err", "n_signups"])
    return out.withColumns({"weekday": F.dayofweek("hour_ts"), "day_part": day_part(F.hour("hour_ts"))}).select("dist", "hour_ts", "n_err", "mean_purchase", "has_err", "has_purchase", "click", "view", "n_signups", "weekday", "day_part")


FEATURES = f"""{LABELS}, h AS (SELECT dist, hour_ts, round(avg(value), 4) AS mean, count(value) AS n FROM ev GROUP BY ALL),
p AS (SELECT dist, hour_ts, round(avg(value) FILTER (event_type = 'click'), 4) AS click_mean, count(value) FILTER (event_type = 'click') AS click_n FROM ev GROUP BY ALL)"""
FEATURES_SQL = f"WITH {FEATURES} SELECT dist, hour_ts, target_next_hour, mean, coalesce(n, 0) AS n, click_mean, coalesce(click_n, 0) AS click_n, CAST(hour(hour_ts) AS INT) AS hour, CAST(dayofweek(hour_ts) + 1 AS INT) AS weekday, CAST(month(hour_ts) AS INT) AS month FROM labels1 LEFT JOIN h USING (dist, hour_ts) LEFT JOIN p USING (dist, hour_ts)"


def feature_rows(df):
    """Labels with hourly aggregates and calendar: counts default to 0, means stay null."""
    keys = ["dist", "hour_ts"]
    h = df.groupBy(*keys).agg(F.round(F.avg("value"), 4).alias("mean"), F.count("value").alias("n"))
    p = reshape.conditional_pivot(df, keys, "event_type", "value", ["click"]).withColumn("click_mean", F.round("click_mean", 4))
    out = label_rows(df).select(*keys, "target_next_hour").join(h, keys, "left").join(p, keys, "left").fillna(0, ["n", "click_n"])
    return out.withColumns({"hour": F.hour("hour_ts"), "weekday": F.dayofweek("hour_ts"), "month": F.month("hour_ts")})


@query(FEATURES_SQL)
def feature_snapshot(spark, sf):
    return feature_rows(events(spark, sf))


LINEAGE = {"snapshot_id": "s1", "code_commit": "c1", "feature_schema_version": "v1"}


def broken_rows(df):
    """Counters of rows that break the contract of labels and features."""
    odd = {"no_key": F.col("dist").isNull() | F.col("hour_ts").isNull(), "target": ~F.col("target_next_hour").isin(0, 1)}
    return quality.counters(df, odd | ({"counts": F.col("n") < 0} if "n" in df.columns else {}))


def snapshot(spark, sf):
    """Version 1 of the events is captured; another is published before anything is built of it."""
    base, raw = work_dir(spark), read(spark, sf, "events")
    at = f"{base}/events"
    versioned.overwrite(raw.where("event_type <> 'error'"), at)
    versioned.append(raw.where("event_type = 'error'"), at)
    captured = snapshots.capture(spark, {"events": at}, {"events": 1})
    versioned.overwrite(raw.withColumns({"value": F.col("value") * 2, "event_type": F.lit("error")}), at)

    def make(frames):
        ev = measured(frames["events"])
        return {"labels": label_rows(ev).select("dist", "hour_ts", "target_next_hour"), "features": feature_rows(ev)}

    return snapshots.build(captured, f"{base}/snapshot", LINEAGE, make, broken_rows)


@query(f"""SELECT *, 's1' AS snapshot_id, 'c1' AS code_commit, 'v1' AS feature_schema_version, '{{"events":1}}' AS input_versions FROM ({FEATURES_SQL})""")
def training_snapshot(spark, sf):
    """Labels and features of captured versions with their lineage; published, checked and read back."""
    return snapshot(spark, sf)["features"]


@query(f"WITH {LABELS} SELECT 's1' AS snapshot_id, count(*) AS n_rows, sum(target_next_hour)::BIGINT AS n_positive FROM labels1")
def snapshot_pair(spark, sf):
    """Both tables of one snapshot, which agree row by row."""
    both = snapshot(spark, sf)
    ref = tables.latest_snapshot_reference(both["labels"], both["features"])
    pair = both["labels"].join(both["features"], ["dist", "hour_ts", "target_next_hour", "snapshot_id"]).join(F.broadcast(ref), "snapshot_id")
    return pair.groupBy("snapshot_id").agg(F.count("*").alias("n_rows"), F.sum(F.col("target_next_hour").cast("bigint")).alias("n_positive"))


# Quality gates

INJECTED = "CASE WHEN event_id % 50 = 0 THEN 'nan'::DOUBLE WHEN event_id % 51 = 0 THEN -value WHEN event_id % 52 = 0 THEN NULL ELSE value END"
RANGES = {"value": (0.0, True, 400.0, False), "user_id": (1.0, True, None, False)}


def injected(spark, sf):
    v = F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).when(F.col("event_id") % 51 == 0, -F.col("value")).when(F.col("event_id") % 52 == 0, F.lit(None)).otherwise(F.col("value"))
    return events(spark, sf).withColumn("value", v)


OK = "v IS NOT NULL AND NOT isnan(v) AND v >= 0 AND v < 400"


@query(f"SELECT event_id, CASE WHEN {OK} THEN v END AS value, user_id, CAST({OK} AS INT) AS value_available, CAST(user_id >= 1 AS INT) AS user_id_available FROM (SELECT event_id, user_id, {INJECTED} AS v FROM events)".replace(" user_id, CAST", " CASE WHEN user_id >= 1 THEN user_id END AS user_id, CAST"))
def sanitize_ranges(spark, sf):
    return quality.sanitize_ranges(injected(spark, sf).select("event_id", "value", "user_id"), RANGES)


@query(f"SELECT count(*) FILTER (v < 0) AS negative, count(*) FILTER (isnan(v)) AS not_a_number, count(*) FILTER (v IS NULL) AS missing, count(*) FILTER (event_type NOT IN ('click', 'view')) AS other_type FROM (SELECT event_type, {INJECTED} AS v FROM events)")
def domain_violations(spark, sf):
    v = F.col("value")
    return quality.counters(injected(spark, sf), {"negative": v < 0, "not_a_number": F.isnan(v), "missing": v.isNull(), "other_type": ~F.col("event_type").isin("click", "view")})


@query(f"""WITH t AS (SELECT user_id, {INJECTED} AS v FROM events) SELECT 'value' AS feature, count(*) FILTER (v IS NULL OR isnan(v)) AS missing, count(*) FILTER (v IS NOT NULL AND NOT isnan(v) AND (v < 0 OR v >= 400)) AS out_of_range, count(*) FILTER ({OK}) AS valid FROM t
UNION ALL SELECT 'user_id', count(*) FILTER (user_id IS NULL), count(*) FILTER (user_id < 1), count(*) FILTER (user_id >= 1) FROM t""")
def feature_quality_profile(spark, sf):
    return quality.feature_quality_profile(injected(spark, sf), RANGES)


@query(f"""WITH {EV}, t AS (SELECT dist, hour_ts, CASE WHEN dist <> 4 THEN round(avg(value), 4) END AS mean, CASE WHEN dist = 6 THEN 0 ELSE count(value) END AS n FROM ev GROUP BY dist, hour_ts)
SELECT count(*) FILTER (mean IS NOT NULL AND n = 0) AS mean_without_n, count(*) FILTER (mean IS NULL AND n > 0) AS n_without_mean FROM t""")
def count_without_mean(spark, sf):
    """Means and counts that contradict each other, put into two districts."""
    df = events(spark, sf).groupBy("dist", "hour_ts").agg(F.round(F.avg("value"), 4).alias("mean"), F.count("value").alias("n"))
    odd = df.withColumns({"mean": F.when(F.col("dist") != 4, F.col("mean")), "n": F.when(F.col("dist") == 6, 0).otherwise(F.col("n"))})
    return quality.count_without_mean(odd, {"mean": "n"})


@query(f"WITH {LABELS}, s AS (SELECT count(*) AS n_rows, count(DISTINCT dist) AS n_entities, min(hour_ts) AS first_hour FROM labels1) SELECT CAST(n_rows <> 15 AS BIGINT) AS n_rows, CAST(n_entities <> 21 AS BIGINT) AS n_entities, CAST(first_hour <> TIMESTAMP '2024-01-01 01:00:00' AS BIGINT) AS first_hour FROM s")
def summary_problems(spark, sf):
    """Which values of the summary differ from what was stated: a wrong number of rows, a wrong first hour."""
    import datetime as dt

    return quality.summary_problems(output_summary(spark, sf), {"n_rows": 15, "n_entities": 21, "first_hour": dt.datetime(2024, 1, 1, 1)})


BROKEN = "CASE WHEN dist = 2 THEN 7 ELSE target_next_hour END AS target_next_hour, CASE WHEN dist = 3 THEN -1 ELSE n_next_hour END AS n_next_hour, CASE WHEN dist <> 4 THEN dist END AS dist, hour_ts, CASE WHEN dist = 5 THEN hour_ts ELSE next_hour_ts END AS next_hour_ts"


@query(f"WITH {LABELS}, b AS (SELECT {BROKEN} FROM labels1 UNION ALL SELECT target_next_hour, n_next_hour, dist, hour_ts, next_hour_ts FROM labels1 WHERE dist = 1) SELECT count(*) AS n_rows, count(*) FILTER (dist IS NOT NULL) - count(DISTINCT (dist, hour_ts)) FILTER (dist IS NOT NULL) AS n_repeated, count(*) FILTER (next_hour_ts <> hour_ts + INTERVAL 1 HOUR) AS n_wrong_lead, count(*) FILTER (target_next_hour NOT IN (0, 1)) AS n_wrong_target, count(*) FILTER (n_next_hour < 0) AS n_negative, count(*) FILTER (dist IS NULL) AS n_null FROM b")
def output_contract_violations(spark, sf):
    """Counters over labels of which five districts are broken, each in its own way."""
    df = lead_hour_label(spark, sf)
    at, d = F.col, F.col("dist")
    odd = df.select(
        F.when(d == 2, 7).otherwise(at("target_next_hour")).alias("target_next_hour"), F.when(d == 3, -1).otherwise(at("n_next_hour")).alias("n_next_hour"),
        F.when(d != 4, d).alias("dist"), "hour_ts", F.when(d == 5, at("hour_ts")).otherwise(at("next_hour_ts")).alias("next_hour_ts"))
    df = odd.unionByName(df.where("dist = 1").select(*odd.columns))
    c = quality.count_if
    return df.agg(
        F.count("*").alias("n_rows"), (F.count("dist") - F.countDistinct("dist", "hour_ts")).alias("n_repeated"), c(F.col("next_hour_ts") != F.expr("hour_ts + INTERVAL 1 HOUR"), "n_wrong_lead"),
        c(~F.col("target_next_hour").isin(0, 1), "n_wrong_target"), c(F.col("n_next_hour") < 0, "n_negative"), c(F.col("dist").isNull(), "n_null"))


@query(f"WITH {LABELS} SELECT count(*) AS n_rows, count(DISTINCT dist) AS n_entities, min(hour_ts) AS first_hour, max(hour_ts) AS last_hour, count(*) FILTER (target_next_hour = 1) AS n_positive, count(DISTINCT dist) FILTER (target_next_hour = 1) AS n_positive_entities FROM labels1")
def output_summary(spark, sf):
    return quality.output_summary(lead_hour_label(spark, sf), "dist", "hour_ts", "target_next_hour")


@query(f"""WITH {LABELS}, f AS (SELECT dist, next_hour_ts, n_next_hour FROM labels1 WHERE target_next_hour = 1 QUALIFY row_number() OVER (PARTITION BY dist ORDER BY hour_ts) = 1)
SELECT *, n_next_hour = n_counted AS agrees FROM (SELECT f.dist, f.next_hour_ts, f.n_next_hour, count(DISTINCT user_id) AS n_counted FROM f LEFT JOIN ev ON ev.dist = f.dist AND ev.hour_ts = next_hour_ts AND event_type = 'error' GROUP BY ALL)""")
def reconcile_first_positive(spark, sf):
    """Each district's first positive label against an independent count of its incidents."""
    first = dedup.deduplicate(lead_hour_label(spark, sf).where("target_next_hour = 1"), ["dist"], [F.col("hour_ts")]).select("dist", "next_hour_ts", "n_next_hour")
    counts = incidents(spark, sf).groupBy("dist", F.col("hour_ts").alias("next_hour_ts")).agg(F.countDistinct("user_id").alias("n_counted"))
    return first.join(counts, ["dist", "next_hour_ts"], "left").fillna(0, ["n_counted"]).withColumn("agrees", F.col("n_next_hour") == F.col("n_counted"))


CONTRACT = [("dist", "int"), ("hour_ts", "timestamp_ntz"), ("n", "bigint"), ("mean", "double")]


def contract_frame(spark, sf):
    return events(spark, sf).groupBy("hour_ts", "dist").agg(F.round(F.avg("value"), 4).alias("mean"), F.count("*").cast("int").alias("n"))


CONTRACT_SQL = f"WITH {EV} SELECT dist, hour_ts, count(*) AS n, round(avg(value), 4) AS mean FROM ev GROUP BY dist, hour_ts"


@query(CONTRACT_SQL)
def contract_select(spark, sf):
    return columns.contract_select(contract_frame(spark, sf), CONTRACT)


@query("SELECT * FROM (VALUES ('risk', 'missing'), ('hour_ts', 'position'), ('n', 'position'), ('n', 'type'), ('dist', 'nullability'), ('mean', 'extra')) AS t(name, problem), (SELECT count(*) AS n_rows FROM (SELECT DISTINCT user_id % 21, date_trunc('hour', ts) FROM events))")
def schema_contract(spark, sf):
    """How a table differs from a stated contract, with its number of rows."""
    df = columns.contract_select(contract_frame(spark, sf), CONTRACT)
    stated = [("dist", "int", False), ("risk", "double", True), ("hour_ts", "timestamp_ntz", True), ("n", "int", True)]
    return quality.schema_problems(df, stated).join(F.broadcast(df.agg(F.count("*").alias("n_rows"))))


@query(f"SELECT *, 's1' AS snapshot_id, 'c1' AS code_commit, 'v1' AS feature_schema_version FROM ({CONTRACT_SQL})")
def add_lineage(spark, sf):
    return columns.add_lineage(contract_select(spark, sf), LINEAGE)


@query("""SELECT snapshot_id, code_commit, 'v1' AS feature_schema_version, string_agg(DISTINCT t, ',' ORDER BY t) AS tables, code_commit IS NULL AS has_null
FROM (SELECT 's' || (user_id % 2) AS snapshot_id, CASE WHEN user_id % 3 > 0 THEN 'c1' END AS code_commit, CASE WHEN event_type = 'error' THEN 'labels' ELSE 'features' END AS t FROM events) GROUP BY snapshot_id, code_commit""")
def lineage_check(spark, sf):
    """Two tables that mix snapshots, some without a commit."""
    df = events(spark, sf).withColumns({"snapshot_id": F.concat(F.lit("s"), F.col("user_id") % 2), "code_commit": F.when(F.col("user_id") % 3 > 0, "c1"), "feature_schema_version": F.lit("v1")})
    return quality.lineage_check({"features": df.where("event_type <> 'error'"), "labels": df.where("event_type = 'error'")}, list(LINEAGE))


# Sinks and versions


def versioned_part(spark, sf):
    path, df = f"{work_dir(spark)}/part", read(spark, sf, "part").select("p_partkey", "p_retailprice")
    versioned.overwrite(df, path)
    versioned.overwrite(df.withColumn("p_retailprice", F.col("p_retailprice") + 1), path)
    return path


@query("SELECT p_partkey, p_retailprice FROM part")
def read_version(spark, sf):
    return versioned.read(spark, versioned_part(spark, sf), 0)


def two_tables(spark, sf):
    path = f"{work_dir(spark)}/supplier"
    versioned.overwrite(read(spark, sf, "supplier"), path)
    return {"part": versioned_part(spark, sf), "supplier": path}


@query("SELECT 'part' AS \"table\", CAST(1 AS INT) AS version, (SELECT count(*) FROM part) AS n_rows UNION ALL SELECT 'supplier', 0, (SELECT count(*) FROM supplier)")
def capture_versions(spark, sf):
    """The newest versions of two tables, each read at the version captured."""
    paths = two_tables(spark, sf)
    found, out = tables.capture_versions(spark, paths), None
    for r in found.collect():  # one row per table named here
        rows = versioned.read(spark, paths[r["table"]], r["version"]).agg(F.lit(r["table"]).alias("table"), F.count("*").alias("n_rows"))
        out = rows if out is None else out.unionByName(rows)
    return found.join(out, "table")


@query("SELECT 'part' AS \"table\", CAST(0 AS INT) AS expected, CAST(1 AS INT) AS captured, (SELECT count(*) FROM part) AS n_rows UNION ALL SELECT 'orders', 3, NULL, (SELECT count(*) FROM part)")
def version_drift(spark, sf):
    """One table has moved on, one is gone, one is as it was."""
    paths = two_tables(spark, sf)
    expected = spark.createDataFrame([("part", 0), ("supplier", 0), ("orders", 3)], '`table` string, version int')
    rows = versioned.read(spark, paths["part"]).agg(F.count("*").alias("n_rows"))
    return quality.version_drift(expected, tables.capture_versions(spark, paths)).join(F.broadcast(rows))


@query("SELECT 's1' AS snapshot_id, count(*) AS n_rows FROM (SELECT DISTINCT user_id % 21, date_trunc('hour', ts) FROM events)")
def latest_snapshot_reference(spark, sf):
    a, b = add_lineage(spark, sf), columns.add_lineage(lead_hour_label(spark, sf), LINEAGE)
    return tables.latest_snapshot_reference(a, b).join(a, "snapshot_id").groupBy("snapshot_id").agg(F.count("*").alias("n_rows"))


@query("SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal + 1, 2) AS s_acctbal FROM supplier")
def sink_overwrite(spark, sf):
    """All rows, then all rows with other columns and values in their place."""
    path, df = f"{work_dir(spark)}/supplier", read(spark, sf, "supplier")
    sinks.write(df, path, "overwrite")
    sinks.write(df.select("s_suppkey", "s_name", "s_nationkey", F.round(F.col("s_acctbal") + 1, 2).alias("s_acctbal")), path, "overwrite", partition_by=["s_nationkey"])
    return versioned.read(spark, path)


@query("SELECT s_suppkey, s_name, CAST(s_acctbal AS DOUBLE) AS balance FROM supplier")
def insert_overwrite(spark, sf):
    """A managed table of a fixed schema, filled twice; the second time from columns of other order and type."""
    name = f"urbanflow_{work_dir(spark).rsplit('-', 1)[1]}"
    df = read(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_acctbal").alias("balance"))
    sinks.managed(df.limit(1), name)
    sinks.insert_overwrite(df.select(F.col("balance").cast("string").alias("balance"), "s_name", F.col("s_suppkey").cast("int").alias("s_suppkey")), name)
    return spark.table(name)


@query("SELECT * FROM supplier")
def sink_append(spark, sf):
    path, df = f"{work_dir(spark)}/supplier", read(spark, sf, "supplier")
    for k in (0, 1):
        sinks.write(df.where(F.col("s_suppkey") % 2 == k), path, "append")
    return versioned.read(spark, path)


PRICES = "o_orderkey, year(o_orderdate)::INT AS year, o_totalprice AS price"


@query(f"""WITH o AS (SELECT {PRICES} FROM orders) SELECT year, count(*) AS n, round(sum(CASE WHEN year = 1996 THEN 0 ELSE price + 1 END), 1) AS total, CAST(3 AS INT) AS version FROM o GROUP BY year""")
def write_strategies(spark, sf):
    """One table by all four strategies in turn: part of the orders, the rest, all with other prices, one year again."""
    path = f"{work_dir(spark)}/orders"
    df = read(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"))
    sinks.write(df.where("year < 1997"), path, "overwrite", partition_by=["year"])
    sinks.write(df.where("year >= 1997 or year is null"), path, "append")
    sinks.write(df.withColumn("price", F.col("price") + 1), path, "merge", keys=["o_orderkey"])
    last = sinks.write(df.where("year = 1996").withColumn("price", F.lit(0.0)), path, "replace_partitions", partition_by=["year"])
    return versioned.read(spark, path).groupBy("year").agg(F.count("*").alias("n"), F.round(F.sum("price"), 1).alias("total"), F.lit(last).alias("version"))


@query(f"WITH o AS (SELECT {PRICES} FROM orders) SELECT * FROM o")
def gold_managed(spark, sf):
    """A managed table of the catalog, by year; written twice, the second time with more columns."""
    name = f"urbanflow_{work_dir(spark).rsplit('-', 1)[1]}"
    df = read(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"))
    sinks.managed(df.drop("price").limit(1), name, ["year"])
    sinks.managed(df, name, ["year"])
    return spark.table(name)


@query("SELECT count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_orders, max(n) AS most, count(*) FILTER (n > 3) AS n_large FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def materialized_checks(spark, sf):
    """An intermediate table, made once, under four checks."""
    rows = tables.materialized(read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")))
    checks = [rows.agg(F.count("*").alias("n_rows")), rows.agg(F.countDistinct("l_orderkey").alias("n_orders")), rows.agg(F.max("n").alias("most")), rows.agg(quality.count_if(F.col("n") > 3, "n_large"))]
    return checks[0].join(F.broadcast(checks[1])).join(F.broadcast(checks[2])).join(F.broadcast(checks[3]))


@query("SELECT o_orderkey, true AS stamped, 'once' AS stamps FROM orders")
def processing_time(spark, sf):
    """All rows of one run have one stamp, not before its start."""
    rows = columns.add_processing_time(read(spark, sf, "orders").select("o_orderkey").withColumn("began", F.current_timestamp()))
    kinds = rows.agg(F.when(F.countDistinct("_processed_at") <= 1, "once").otherwise("several").alias("stamps"))
    return rows.select("o_orderkey", (F.col("_processed_at") >= F.col("began")).alias("stamped")).join(F.broadcast(kinds))


@query("SELECT check_name, refused, (SELECT count(*) FROM part) AS n_rows FROM (VALUES ('columns there', false), ('column missing', true), ('normal names', false), ('odd name', true), ('digit first', true), ('clash', true)) AS t(check_name, refused)")
def column_guards(spark, sf):
    """What the guards before a transform and before a write refuse."""
    df = read(spark, sf, "part")
    tries = {
        "columns there": lambda: columns.require_columns(df, ["p_partkey", "p_size"]), "column missing": lambda: columns.require_columns(df, ["p_partkey", "p_colour"]),
        "normal names": lambda: columns.check_names(df), "odd name": lambda: columns.check_names(df.withColumnRenamed("p_size", "p size")),
        "digit first": lambda: columns.check_names(df.withColumnRenamed("p_size", "2size")), "clash": lambda: columns.normalize_column_names(df.withColumn("P-size", F.lit(1))),
    }

    def refused(f):
        try:
            f()
        except ValueError:
            return True
        return False

    rows = spark.createDataFrame([(name, refused(f)) for name, f in tries.items()], "check_name string, refused boolean")
    return rows.join(F.broadcast(df.agg(F.count("*").alias("n_rows"))))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN CAST(s_nationkey AS INT) WHEN s_suppkey % 3 = 1 THEN CAST(s_suppkey % 1000 AS INT) END AS place_code, CASE WHEN s_suppkey % 5 > 0 THEN lower(s_name) END AS place_name FROM supplier")
def place_codes(spark, sf):
    """Codes as padded text or as numbers in one of two columns, names with capitals, accents and blanks."""
    df, k = read(spark, sf, "supplier"), F.col("s_suppkey")
    rows = df.select(
        k, F.when(k % 3 == 0, F.format_string("%04d.", F.col("s_nationkey").cast("int"))).when(k % 3 == 2, "unknown").alias("cod_a"), F.when(k % 3 == 1, k % 1000).alias("cod_b"),
        F.when(k % 5 > 0, F.concat(F.lit("  "), F.translate(F.upper("s_name"), "AEIOU", "ÁÉÍÓÚ"))).otherwise("  ").alias("name_a"))
    return columns.place_of(rows, ["cod_a", "cod_b", "cod_c"], ["name_b", "name_a"]).select("s_suppkey", "place_code", "place_name")


@query("SELECT r_name, count(n_nationkey) AS n_nations, false AS extra_there, true AS region_there FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY r_name")
def optional_tables(spark, sf):
    """A required table, one that may be absent and is there, and one that isn't."""
    region, nation = tables.read_optional(spark, f"{sf}/region.parquet", required=True), tables.read_optional(spark, f"{sf}/nation.parquet")
    extra = tables.read_optional(spark, f"{sf}/no_such_table.parquet")
    rows = region.join(nation, F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("r_name").agg(F.count("n_nationkey").alias("n_nations"))
    return rows.withColumns({"extra_there": F.lit(extra is not None), "region_there": F.lit(not region.isEmpty())})


MERGED = "SELECT c_custkey, c_name, round(c_acctbal + CASE WHEN c_custkey > n / 3 THEN 100 ELSE 0 END, 2) AS c_acctbal FROM customer, (SELECT count(*) AS n FROM customer) UNION ALL SELECT NULL, 'nobody', 1.0"


def customer_halves(spark, sf):
    """Target: the first two thirds; source: the last two thirds with 100 more, and a row with a null key."""
    df = read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    n = df.count()
    more = spark.createDataFrame([(None, "nobody", 1.0)], df.schema)
    source = df.where(F.col("c_custkey") > n / 3).withColumn("c_acctbal", F.round(F.col("c_acctbal") + 100, 2)).unionByName(more)
    return df.where(F.col("c_custkey") <= 2 * n / 3), source


@query(MERGED)
def upsert_merge(spark, sf):
    path, (target, source) = f"{work_dir(spark)}/customer", customer_halves(spark, sf)
    sinks.write(target, path, "merge", keys=["c_custkey"])
    sinks.write(source, path, "merge", keys=["c_custkey"])
    sinks.write(source.where("c_custkey is null"), path, "merge", keys=["c_custkey"])
    return versioned.read(spark, path).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query(MERGED)
def dedup_then_upsert(spark, sf):
    path, (target, source) = f"{work_dir(spark)}/customer", customer_halves(spark, sf)
    twice = source.unionByName(source.withColumn("c_acctbal", F.col("c_acctbal") - 1))
    sinks.write(target, path, "merge", keys=["c_custkey"])
    sinks.write(dedup.deduplicate(twice, ["c_custkey"], [F.desc("c_acctbal")]), path, "merge", keys=["c_custkey"])
    return versioned.read(spark, path).withColumn("c_acctbal", F.round("c_acctbal", 2))


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1996 THEN round(o_totalprice * 2, 2) ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def replace_partitions(spark, sf):
    path = f"{work_dir(spark)}/orders"
    df = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    sinks.write(df, path, "overwrite", partition_by=["year"])
    sinks.write(df.where("year = 1996").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2)), path, "replace_partitions", partition_by=["year"])
    return versioned.read(spark, path)


def rate_batches(spark, sf):
    """Incident rates of districts as three prediction batches; the last is published twice, corrected."""
    rates = incidents(spark, sf).groupBy("dist").agg(F.count("*").alias("k"))
    whole = events(spark, sf).groupBy("dist").agg(F.count("*").alias("n"))
    base = whole.join(rates, "dist", "left").select("dist", F.round(F.coalesce("k", F.lit(0)) / F.col("n"), 4).alias("risk"))
    at = lambda t, f: base.select("dist", F.lit(t).cast("timestamp_ntz").alias("window_start"), F.round(F.col("risk") * f, 4).alias("risk"))
    return [at("2024-01-15 08:00:00", 1.0), at("2024-01-15 09:00:00", 0.5), at("2024-01-15 09:00:00", 0.25)]


RATE = f"{EV}, base AS (SELECT dist, round(count(*) FILTER (event_type = 'error') / count(*), 4) AS risk FROM ev GROUP BY dist)"


def published(spark, sf):
    path = f"{work_dir(spark)}/predictions"
    for batch in rate_batches(spark, sf):
        sinks.write(batch, path, "merge", keys=["dist", "window_start"])
    return versioned.read(spark, path)


@query(f"WITH {RATE} SELECT dist, TIMESTAMP '2024-01-15 08:00:00' AS window_start, risk FROM base UNION ALL SELECT dist, TIMESTAMP '2024-01-15 09:00:00', round(risk * 0.25, 4) FROM base")
def publish_predictions(spark, sf):
    return published(spark, sf)


@query(f"WITH {RATE} SELECT dist, TIMESTAMP '2024-01-15 09:00:00' AS window_start, round(risk * 0.25, 4) AS risk FROM base")
def current_batch_view(spark, sf):
    published(spark, sf).createOrReplaceTempView("predictions")
    return spark.sql("SELECT * FROM predictions WHERE window_start = (SELECT max(window_start) FROM predictions)")


@query(f"WITH {RATE} SELECT count(*) AS n_rows, count(DISTINCT dist) AS n_entities, count(*) FILTER (dist IS NULL) AS n_null, count(*) FILTER (risk < 0 OR risk > 1) AS n_out_of_range FROM base")
def batch_completeness(spark, sf):
    c = quality.count_if
    return current_batch_view(spark, sf).agg(F.count("*").alias("n_rows"), F.countDistinct("dist").alias("n_entities"), c(F.col("dist").isNull(), "n_null"), c(~F.col("risk").between(0, 1), "n_out_of_range"))


@query("""SELECT o_orderkey, upper(o_orderpriority) AS o_orderpriority, CAST(trunc(o_totalprice) AS INT) AS o_totalprice, CAST(o_orderdate AS DATE) AS _file_date, true AS stamped
FROM orders QUALIFY CAST(o_orderdate AS DATE) = max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY year(o_orderdate))""")
def silver_pipeline(spark, sf):
    """An increment for each year: watermark, chain, newest file date, stamp, upsert by key."""
    path = f"{work_dir(spark)}/silver"
    df = read(spark, sf, "orders").select("o_orderkey", F.concat(F.lit(" "), "o_orderpriority").alias("o_orderpriority"), "o_totalprice", F.to_date("o_orderdate").alias("_file_date"))
    steps = [("trim", {"columns": ["o_orderpriority"]}), ("upper", {"columns": ["o_orderpriority"]}), ("cast", {"types": {"o_totalprice": "int"}})]
    done = None
    for r in df.select(F.year("_file_date").alias("y")).distinct().orderBy("y").collect():  # a file a year
        done = silver.run(df.where(F.year("_file_date") <= r["y"]), path, steps, "merge", keys=["o_orderkey"], watermark="_file_date", snapshot="_file_date")
    return done.withColumn("stamped", F.col("_processed_at").isNotNull()).drop("_processed_at")


NRT_AT = "2024-01-15 10:00:00"


@query(f"""WITH {EV}, f AS (SELECT dist, count(value) AS n_flow, round(avg(value), 4) AS mean_flow, max(ts) AS fa FROM ev WHERE event_type = 'view' AND ts >= TIMESTAMP '{NRT_AT}' - INTERVAL 24 HOUR AND ts < TIMESTAMP '{NRT_AT}' + INTERVAL 1 MINUTE GROUP BY dist),
l AS (SELECT dist, user_id, value, ts FROM ev WHERE event_type = 'click' AND ts <= TIMESTAMP '{NRT_AT}' AND ts >= TIMESTAMP '{NRT_AT}' - INTERVAL 96 HOUR QUALIFY row_number() OVER (PARTITION BY dist, user_id ORDER BY ts DESC, value DESC) = 1),
s AS (SELECT dist, count(value) AS n_stations, round(avg(value), 4) AS mean_station, max(ts) AS sa FROM l GROUP BY dist)
SELECT dist, coalesce(n_flow, 0) AS n_flow, mean_flow, coalesce(n_stations, 0) AS n_stations, mean_station, (SELECT max(fa) FROM f) AS flow_at, (SELECT max(sa) FROM s) AS station_at, TIMESTAMP '{NRT_AT}' AS cutoff FROM (SELECT DISTINCT dist FROM ev) LEFT JOIN f USING (dist) LEFT JOIN s USING (dist)""")
def nrt_features(spark, sf):
    """Rolling traffic and the newest value of each station, for every district at the cutoff."""
    df = events(spark, sf)
    age = F.lit(NRT_AT).cast("timestamp_ntz") - F.expr("INTERVAL 96 HOUR")
    rows = nrt.batch_features(districts(spark, sf), df.where("event_type = 'view'"), df.where("event_type = 'click'"), "dist", "user_id", "ts", "value", NRT_AT, 24, age)
    return rows.withColumns({c: F.round(c, 4) for c in ("mean_flow", "mean_station")})


@query(f"""WITH {EV}, base AS (SELECT dist, round(count(*) FILTER (event_type = 'error') / count(*), 4) AS risk FROM ev GROUP BY dist), b AS (SELECT CASE WHEN dist = 2 THEN 1 WHEN dist = 3 THEN 99 ELSE dist END AS dist, CASE WHEN dist = 5 THEN 1.5 ELSE risk END AS risk FROM base)
SELECT (SELECT count(*) FROM base ANTI JOIN b USING (dist)) AS n_missing, (SELECT count(*) FROM (SELECT dist FROM b GROUP BY dist HAVING count(*) > 1)) AS n_repeated, (SELECT count(DISTINCT dist) FROM b ANTI JOIN base USING (dist)) AS n_unknown, count(*) FILTER (NOT risk BETWEEN 0 AND 1) AS n_out_of_range FROM b""")
def batch_problems(spark, sf):
    """A batch with one district twice, two missing, an unknown one and a score above 1."""
    d = F.col("dist")
    odd = rate_batches(spark, sf)[0].select(F.when(d == 2, 1).when(d == 3, 99).otherwise(d).alias("dist"), F.when(d == 5, 1.5).otherwise(F.col("risk")).alias("risk"))
    return nrt.batch_problems(odd, districts(spark, sf), "dist", "risk")


# Streams

RECORD = 1000


def landing(spark, sf, root):
    """events as ;-separated CSV below yyyy/MM/dd folders, one a month of the data, as a supplier would deliver them."""
    df = read(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Fecha"), "user_id", "event_type", "value", F.to_date("ts").alias("day"))
    df = df.withColumn("half", F.when(F.dayofmonth("day") <= 15, 15).otherwise(28)).withColumn("folder", F.concat(F.date_format("day", "yyyy/MM/"), F.col("half").cast("string")))
    for r in df.select("folder").distinct().collect():  # two folders a month
        df.where(F.col("folder") == r["folder"]).drop("day", "half", "folder").write.option("header", True).option("sep", ";").csv(f"{root}/{r['folder']}")


@query("SELECT event_id, date_trunc('second', ts) AS fecha, user_id, event_type, value, CAST(date_trunc('month', ts) AS DATE) + CASE WHEN day(ts) <= 15 THEN 14 ELSE 27 END AS _file_date FROM events")
def stream_csv_ingest(spark, sf):
    from urbanflow.streaming.ingest import csv_stream, ingest

    base = work_dir(spark)
    landing(spark, sf, f"{base}/landing")
    ingest(csv_stream(spark, f"{base}/landing", "event_id string, Fecha string, user_id string, event_type string, value string"), "run1", f"{base}/bronze", f"{base}/checkpoint")
    rows = spark.read.parquet(f"{base}/bronze")
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), F.to_timestamp_ntz("fecha", F.lit("yyyy-MM-dd HH:mm:ss")).alias("fecha"), F.col("user_id").cast("bigint").alias("user_id"), "event_type", F.col("value").cast("double").alias("value"), "_file_date")


@query("""SELECT event_id, event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value, CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id, event_id % 7 = 0 AS rescued FROM events""")
def stream_schema_evolution(spark, sf):
    """Files that lack a column, then files that have it; values that don't parse stay in a rescued text beside a null."""
    from urbanflow.streaming.ingest import append_available, evolving_csv_stream

    base = work_dir(spark)
    value = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("bad "), F.col("value"))).otherwise(F.col("value").cast("string"))
    df = read(spark, sf, "events").select("event_id", "event_type", value.alias("value"), "user_id")
    schemas = ["event_id bigint, event_type string, value double", "event_id bigint, event_type string, value double, user_id bigint"]
    for k, schema in enumerate(schemas):
        rows = df.where(F.col("event_id") % 2 == k)
        (rows.drop("user_id") if k == 0 else rows).write.option("header", True).option("sep", ";").csv(f"{base}/landing/v{k + 1}")
        append_available(evolving_csv_stream(spark, f"{base}/landing", schema), f"{base}/bronze", f"{base}/checkpoint")
    rows = spark.read.option("mergeSchema", True).parquet(f"{base}/bronze")
    return rows.select("event_id", "event_type", "value", "user_id", F.col("_rescued").isNotNull().alias("rescued"))


@query("SELECT CAST(ts AS DATE) AS fecha, event_id AS id, value AS measure FROM events")
def stream_xml_ingest(spark, sf):
    from urbanflow.streaming.ingest import ingest, xml_stream

    base = work_dir(spark)
    df = read(spark, sf, "events").select(F.to_date("ts").cast("string").alias("fecha"), "event_id", F.struct(F.col("event_id").alias("id"), F.col("value").alias("measure")).alias("pm"))
    # Records of about RECORD elements each, however many events a day has.
    parts = df.groupBy("fecha").agg(F.ceil(F.count("*") / RECORD).alias("parts"))
    df = df.join(parts, "fecha").withColumn("part", F.pmod(F.xxhash64("event_id"), "parts"))
    df.groupBy("fecha", "part").agg(F.collect_list("pm").alias("pm")).drop("part").write.format("xml").option("rootTag", "root").option("rowTag", "pms").save(f"{base}/landing")
    schema = "fecha string, pm array<struct<id:bigint,measure:double>>"
    ingest(xml_stream(spark, f"{base}/landing", "pms", schema), "run1", f"{base}/bronze", f"{base}/checkpoint", ("pm", ["fecha"]))
    return spark.read.parquet(f"{base}/bronze").select(F.col("fecha").cast("date").alias("fecha"), "id", "measure")


@query("SELECT event_id, CAST(1 + event_id % 2 AS INT) AS batch FROM events")
def stream_incremental_files(spark, sf):
    """The same stream run twice, with files added in between: each row once."""
    from urbanflow.streaming.ingest import append_available

    base, df = work_dir(spark), read(spark, sf, "events")
    for batch in (1, 2):
        df.where(F.col("event_id") % 2 == batch - 1).select("event_id", F.lit(batch).alias("batch")).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema("event_id bigint, batch int").parquet(f"{base}/landing")
        append_available(stream, f"{base}/bronze", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/bronze")


@query("""SELECT event_id, event_type, CASE WHEN event_id % 7 > 0 THEN value END AS value, CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id,
CASE WHEN event_id % 7 = 0 THEN 'bad ' || event_id END AS bad_value, CASE WHEN event_id % 2 = 1 THEN event_type || '; "' || event_id || '"' END AS note FROM events""")
def stream_rescued_fields(spark, sf):
    """Files of other columns in another order: what doesn't fit is kept by field, beside all that does."""
    from urbanflow.streaming.ingest import rescue_available

    base = work_dir(spark)
    value = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("bad "), F.col("event_id"))).otherwise(F.col("value").cast("string"))
    note = F.concat("event_type", F.lit('; "'), F.col("event_id").cast("string"), F.lit('"'))
    df = read(spark, sf, "events").select("event_id", "event_type", value.alias("value"), "user_id", note.alias("note"))
    shapes = [(["event_id", "event_type", "value"], "event_id bigint, event_type string, value double"), (["note", "user_id", "value", "event_type", "event_id"], "event_id bigint, event_type string, value double, user_id bigint")]
    for k, (names, schema) in enumerate(shapes):
        rows = df.where(F.col("event_id") % 2 == k).select(*names)
        rows.write.option("header", True).option("sep", ";").option("escape", '"').csv(f"{base}/landing/v{k + 1}")
        rescue_available(spark, f"{base}/landing", schema, f"{base}/bronze", f"{base}/checkpoint")
    rows = versioned.read(spark, f"{base}/bronze")
    return rows.select("event_id", "event_type", "value", "user_id", F.col("_rescued")["value"].alias("bad_value"), F.col("_rescued")["note"].alias("note"))


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n, max(ts) AS last_ts, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY user_id")
def stream_upsert(spark, sf):
    """Events arrive in three files, older ones too: a table by user, kept by an upsert from a stream."""
    from urbanflow.streaming.ingest import upsert_available

    base, df = work_dir(spark), read(spark, sf, "events").select("event_id", "user_id", "ts")
    for k in range(3):
        df.where(F.col("event_id") % 3 == k).write.mode("append").parquet(f"{base}/landing")
        seen = spark.read.parquet(f"{base}/landing").groupBy("user_id").agg(F.count("*").alias("n"), F.max(F.struct("ts", "event_id")).alias("last"))
        seen.select("user_id", "n", F.col("last.ts").alias("last_ts"), F.col("last.event_id").alias("last_event")).withColumn("step", F.lit(k)).write.mode("append").parquet(f"{base}/changes")
        stream = spark.readStream.schema("user_id bigint, n bigint, last_ts timestamp_ntz, last_event bigint, step int").parquet(f"{base}/changes")
        upsert_available(stream, f"{base}/users", ["user_id"], [F.desc("step")], f"{base}/checkpoint")
    return versioned.read(spark, f"{base}/users").drop("step")
