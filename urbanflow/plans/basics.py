"""Column, time, reshape, join, window and set operators over the standard tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from urbanflow.functions import temporal
from urbanflow.operators import aggregates, columns, dedup, joins, quality, reshape, spatial
from urbanflow.plans.frames import EV, GRID, PART, TYPES, districts, events, grid, grid_of, incidents, incidents_of
from urbanflow.plans.registry import query
from urbanflow.sources.tables import read


# Columns


@query("SELECT r_regionkey AS region_key, r_name AS region_name, upper(r_name) AS area_total FROM region")
def normalize_column_names(spark, sf):
    return columns.normalize_column_names(read(spark, sf, "region").select(F.col("r_regionkey").alias("Region-Key"), F.col("r_name").alias("regionName"), F.upper("r_name").alias("ÁREA  total")))


@query("SELECT n_nationkey AS n_regionkey, n_name AS nation, n_regionkey AS n_nationkey FROM nation")
def rename_columns(spark, sf):
    return columns.rename(read(spark, sf, "nation"), {"n_nationkey": "n_regionkey", "n_regionkey": "n_nationkey", "n_name": "nation"})


@query("SELECT p_partkey, p_brand FROM part")
def select_columns(spark, sf):
    return columns.select(read(spark, sf, "part"), ["p_partkey", "p_brand"])


@query("SELECT p_partkey, p_name, p_brand, p_type FROM part")
def drop_columns(spark, sf):
    return columns.drop(read(spark, sf, "part"), ["p_size", "p_retailprice"])


@query("SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INT) AS brand_no, TRY_CAST(p_name AS DOUBLE) AS name_no, TRY_CAST(CAST(p_size AS VARCHAR) AS BIGINT) AS size_no FROM part")
def cast_columns(spark, sf):
    rows = read(spark, sf, "part").select("p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("brand_no"), F.col("p_name").alias("name_no"), F.col("p_size").cast("string").alias("size_no"))
    return columns.cast(rows, {"brand_no": "int", "name_no": "double", "size_no": "bigint"})


@query("SELECT r_regionkey, r_name, 'city' AS origin FROM region")
def add_literal(spark, sf):
    return columns.add_literal(read(spark, sf, "region"), "origin", "city")


@query("SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'B' WHEN 'MACHINERY' THEN 'M' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def replace_values(spark, sf):
    return columns.replace_values(read(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", {"BUILDING": "B", "MACHINERY": "M"})


@query("SELECT c_custkey, trim(concat('  ', c_name, ' ')) AS c_name FROM customer")
def trim_columns(spark, sf):
    return columns.trim(read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name")), ["c_name"])


@query("SELECT c_custkey, upper(c_name) AS c_name, contains(lower(c_mktsegment), 'build') AS builds FROM customer")
def upper_columns(spark, sf):
    return columns.upper(read(spark, sf, "customer").select("c_custkey", "c_name", F.lower("c_mktsegment").contains("build").alias("builds")), ["c_name"])


@query("SELECT doc_id, translate(text, 'áéíóúÁÉÍÓÚñÑüÜ', 'aeiouAEIOUnNuU') AS text FROM documents")
def strip_accents(spark, sf):
    return columns.strip_accents(read(spark, sf, "documents").select("doc_id", "text"), ["text"])


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat(' ', c_name) END AS c_name FROM customer")
def empty_to_null(spark, sf):
    blank = F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise(F.concat(F.lit(" "), "c_name"))
    return columns.empty_to_null(read(spark, sf, "customer").select("c_custkey", blank.alias("c_name")), ["c_name"])


@query("SELECT page_id, regexp_replace(url, '[0-9]+', '#', 'g') AS url FROM pages")
def regex_replace(spark, sf):
    return columns.regex_replace(read(spark, sf, "pages").select("page_id", "url"), ["url"], "[0-9]+", "#")


@query("SELECT * FROM part WHERE p_size BETWEEN 10 AND 20 AND p_type <> 'SMALL'")
def filter_expr(spark, sf):
    return columns.filter_expr(read(spark, sf, "part"), "p_size BETWEEN 10 AND 20 AND p_type <> 'SMALL'")


@query("SELECT s_suppkey, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS phone, 'none' AS fax FROM supplier")
def coalesce_candidates(spark, sf):
    df = read(spark, sf, "supplier")
    pick = lambda names, t, d=None: columns.first_present(df, names, t, d)
    return df.select("s_suppkey", pick(["name", "s_name"], "string").alias("name"), pick(["s_acctbal", "s_nationkey"], "double").alias("balance"), pick(["s_phone"], "string").alias("phone"), pick(["s_fax"], "string", "none").alias("fax"))


CHAIN = [("trim", {"columns": ["c_name"]}), ("upper", {"columns": ["c_name"]}), ("cast", {"types": {"c_acctbal": "int"}}), ("filter", {"condition": "c_acctbal > 0"}), ("deduplicate", {"keys": ["c_nationkey"], "order": ["-c_acctbal", "c_custkey"]})]


@query("""SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM (SELECT c_custkey, upper(trim(concat(' ', c_name))) AS c_name, c_nationkey, CAST(trunc(c_acctbal) AS INT) AS c_acctbal FROM customer) WHERE c_acctbal > 0
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1""")
def transform_chain(spark, sf):
    return columns.transform_chain(read(spark, sf, "customer").select("c_custkey", F.concat(F.lit(" "), "c_name").alias("c_name"), "c_nationkey", "c_acctbal"), CHAIN)


@query("SELECT user_id AS id, ts AS at, value AS measure, CASE WHEN ts < TIMESTAMP '2024-01-16' THEN event_type END AS kind FROM events")
def harmonize_union(spark, sf):
    df, edge = read(spark, sf, "events"), F.lit("2024-01-16").cast("timestamp_ntz")
    old = df.where(F.col("ts") < edge).select(F.col("user_id").alias("id"), F.col("ts").alias("fecha"), F.col("value").alias("vmed"), "event_type")
    new = df.where(F.col("ts") >= edge).select(F.col("user_id").cast("string").alias("idelem"), F.col("ts").alias("fecha_hora"), F.col("value").alias("velocidad"))
    layout = {"id": (["id", "idelem"], "bigint"), "at": (["fecha", "fecha_hora"], "timestamp_ntz"), "measure": (["vmed", "velocidad"], "double"), "kind": (["event_type"], "string")}
    return columns.harmonized([(old, layout), (new, layout)])


# Time


@query("SELECT o_orderkey, o_orderdate AS at FROM orders")
def parse_timestamp(spark, sf):
    rows = read(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("d"), F.date_format("o_orderdate", "HH:mm:ss").alias("t"))
    return rows.select("o_orderkey", temporal.parse_timestamp(["d", "t"], "dd/MM/yyyy HH:mm:ss").alias("at"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def parse_date(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy.MM.dd").alias("d")).select("o_orderkey", temporal.parse_date("d", "yyyy.MM.dd").alias("day"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def extract_year(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))


@query("SELECT event_id, date_trunc('hour', ts) AS hour_ts, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month FROM events")
def normalize_time(spark, sf):
    rows = read(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("ts")).alias("ts"), F.to_date("ts").alias("day"), F.hour("ts").alias("h"))
    out = temporal.normalize_time(rows, timestamp="ts", date="day", hour="h")
    return out.select("event_id", "hour_ts", "date", "hour", "year", "month")


@query(f"SELECT event_id, CAST(dayofweek(ts) + 1 AS INT) AS weekday, dayname(ts) AS day_name, {PART.format(h='hour(ts)')} AS day_part FROM events")
def time_labels(spark, sf):
    return temporal.time_labels(read(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@query("SELECT event_id, date_trunc('hour', ts + INTERVAL 1 HOUR) + INTERVAL 10 MINUTE * CAST(floor(minute(ts) / 10) AS INT) AS local_ts FROM events")
def floor_ten_minutes(spark, sf):
    return read(spark, sf, "events").select("event_id", temporal.floor_minutes("ts", "Europe/Madrid").alias("local_ts"))


@query(f"SELECT CAST(h AS INT) AS hour, {PART.format(h='h')} AS day_part, CAST(CASE WHEN h <= 5 THEN 1 WHEN h <= 11 THEN 2 WHEN h <= 15 THEN 3 WHEN h <= 19 THEN 4 ELSE 5 END AS INT) AS day_part_order, count(event_id) AS n_events FROM range(24) AS r(h) LEFT JOIN events ON hour(ts) = h GROUP BY h")
def dim_hour(spark, sf):
    counts = read(spark, sf, "events").groupBy(F.hour("ts").alias("hour")).agg(F.count("*").alias("n_events"))
    return temporal.hour_dimension(spark).join(counts, "hour", "left").fillna(0, ["n_events"])


@query("""SELECT d AS date, CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, monthname(d) AS month_name, CAST(weekofyear(d) AS INT) AS iso_week,
CAST(dayofweek(d) + 1 AS INT) AS weekday, dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series(date_trunc('day', min(o_orderdate)), date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""")
def dim_date(spark, sf):
    return temporal.date_dimension(read(spark, sf, "orders"), "o_orderdate")


@query("SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS _file_date FROM orders")
def ingest_metadata(spark, sf):
    from urbanflow.streaming.ingest import file_date

    path = F.concat(F.lit("file:/landing/orders/"), F.date_format("o_orderdate", "yyyy/MM/"), F.lit("01/orders.csv"))
    return read(spark, sf, "orders").select("o_orderkey", path.alias("p")).select("o_orderkey", file_date("p").alias("_file_date"))


@query(f"WITH {EV} SELECT event_id, lpad(CAST(hour(ts) AS VARCHAR), 2, '0') AS hour_cat, lpad(CAST(month(ts) AS VARCHAR), 2, '0') AS month_cat FROM ev")
def category_strings(spark, sf):
    from urbanflow.operators.ml import category_strings as padded

    return padded(events(spark, sf).select("event_id", F.hour("ts").alias("hour"), F.month("ts").alias("month")), ["hour", "month"]).select("event_id", "hour_cat", "month_cat")


# Reshape


@query(f"WITH {EV} SELECT user_id, hour_ts AS ts, round(max(value), 4) AS value, CASE WHEN max(value) > 100 THEN 'V' ELSE 'N' END AS valid FROM ev GROUP BY user_id, hour_ts HAVING max(value) IS NOT NULL")
def hourly_wide_to_long(spark, sf):
    df = events(spark, sf).withColumns({"y": F.year("ts"), "m": F.month("ts"), "d": F.dayofmonth("ts")})
    at = lambda h: F.max(F.when(F.hour("ts") == h - 1, F.col("value")))
    wide = df.groupBy("user_id", "y", "m", "d").agg(*(a for h in range(1, 25) for a in (at(h).alias(f"h{h:02d}"), F.when(at(h) > 100, "V").otherwise("N").alias(f"v{h:02d}"))))
    return reshape.hourly_wide_to_long(wide, "y", "m", "d").where("value is not null").select("user_id", "ts", F.round("value", 4).alias("value"), "valid")


@query(f"WITH {EV} SELECT dist, hour_ts, " + ", ".join(f"round(avg(value) FILTER (event_type = '{t}'), 4) AS {t}" for t in TYPES) + " FROM ev GROUP BY dist, hour_ts")
def pivot_latest_wide(spark, sf):
    wide = reshape.pivot_wide(events(spark, sf), ["dist", "hour_ts"], "event_type", "value", TYPES)
    return wide.select("dist", "hour_ts", *(F.round(t, 4).alias(t) for t in TYPES))


@query(f"WITH {EV}, k AS (SELECT dist, hour_ts, value, event_type, ts, event_id FROM ev) SELECT dist, hour_ts, " + ", ".join(f"arg_min(value, (ts, event_id)) FILTER (event_type = '{t}') AS kind_{t}" for t in TYPES) + " FROM k GROUP BY dist, hour_ts")
def pivot_first(spark, sf):
    """The labels come from the data, with names that columns may have; the first value of each."""
    df = events(spark, sf).withColumn("event_type", F.concat(F.lit("- "), F.upper("event_type")))
    return reshape.pivot_first(df, ["dist", "hour_ts"], "event_type", "value", [F.col("ts"), F.col("event_id")], "kind_")


@query(f"WITH {EV} SELECT dist, hour_ts, " + ", ".join(f"round(avg(value) FILTER (event_type = '{t}'), 4) AS {t}_mean, count(value) FILTER (event_type = '{t}') AS {t}_n" for t in ("click", "view")) + " FROM ev WHERE event_type IN ('click', 'view') GROUP BY dist, hour_ts")
def conditional_pivot_agg(spark, sf):
    wide = reshape.conditional_pivot(events(spark, sf), ["dist", "hour_ts"], "event_type", "value", ["click", "view"], required=True)
    return wide.withColumns({c: F.round(c, 4) for c in wide.columns if c.endswith("_mean")})


@query("SELECT o_orderkey, o_custkey, l_linenumber AS line, l_quantity AS quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def explode_nested_records(spark, sf):
    lines = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity"))).alias("lines"))
    nested = read(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", "o_custkey", "lines")
    return reshape.explode_nested_records(nested, "lines", ["o_orderkey", "o_custkey"])


@query("SELECT p_partkey, p_name, CASE WHEN p_partkey % 2 = 1 THEN p_size END AS p_size FROM part")
def schema_evolution_union(spark, sf):
    df = read(spark, sf, "part")
    old, new = df.where("p_partkey % 2 = 0").select("p_partkey", "p_name"), df.where("p_partkey % 2 = 1").select("p_partkey", "p_name", "p_size")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [old, new])


# Joins


@query("SELECT o_orderkey, o_custkey, c_name AS customer, c_mktsegment AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0")
def lookup_join_left(spark, sf):
    return joins.lookup_join(read(spark, sf, "orders").select("o_orderkey", "o_custkey"), read(spark, sf, "customer").where("c_acctbal > 0"), {"o_custkey": "c_custkey"}, {"customer": "c_name", "segment": "c_mktsegment"})


@query("SELECT s_suppkey, s_nationkey, n_name AS nation FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_nationkey < 12")
def lookup_join_inner(spark, sf):
    return joins.lookup_join(read(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), read(spark, sf, "nation").where("n_nationkey < 12"), {"s_nationkey": "n_nationkey"}, {"nation": "n_name"}, "inner")


@query("SELECT o_orderkey, n_name AS nation, r_name AS region FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def lookup_join_chain(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    df = joins.lookup_join(df, read(spark, sf, "customer"), {"o_custkey": "c_custkey"}, {"nation_key": "c_nationkey"})
    df = joins.lookup_join(df, read(spark, sf, "nation"), {"nation_key": "n_nationkey"}, {"nation": "n_name", "region_key": "n_regionkey"})
    return joins.lookup_join(df, read(spark, sf, "region"), {"region_key": "r_regionkey"}, {"region": "r_name"}).select("o_orderkey", "nation", "region")


@query("SELECT c_custkey, dense_rank() OVER (ORDER BY c_mktsegment) AS code FROM customer")
def lookup_join_text_key(spark, sf):
    df = read(spark, sf, "customer")
    # A handful of segments, in one array: the place in it is the code, without a window over everything.
    names = df.agg(F.sort_array(F.collect_set("c_mktsegment")).alias("names"))
    codes = names.select(F.posexplode("names").alias("code", "c_mktsegment")).withColumn("code", F.col("code").cast("bigint") + 1)
    mangled = df.select("c_custkey", F.concat(F.lit(" "), F.lower(F.translate("c_mktsegment", "AEIOU", "áéíóú")), F.lit("  ")).alias("segment"))
    mangled = columns.strip_accents(columns.upper(columns.trim(mangled, ["segment"]), ["segment"]), ["segment"])
    return joins.lookup_join(mangled, codes, {"segment": "c_mktsegment"}, {"code": "code"}).select("c_custkey", "code")


#: Regions over (p_size, p_retailprice): 19 rectangles, a triangle and a concave one, which overlap nowhere.
RINGS = {k + 1: [(2.0 * k + 0.5, 1000.0), (2.0 * k + 2.5, 1000.0), (2.0 * k + 2.5, 1400.0), (2.0 * k + 0.5, 1400.0)] for k in range(19)}
RINGS |= {20: [(0.5, 900.0), (20.5, 900.0), (0.5, 990.0)], 21: [(1.0, 1500.0), (40.0, 1500.0), (40.0, 1900.0), (20.0, 1700.0), (1.0, 1900.0)]}
X, Y = "CAST(p_size AS DOUBLE)", "p_retailprice"
IN_BOXES = " ".join(f"WHEN {X} > {2 * k + 0.5} AND {X} < {2 * k + 2.5} AND {Y} BETWEEN 1000 AND 1400 THEN {k + 1}" for k in range(19))
IN_REST = f"WHEN {X} >= 0.5 AND {Y} >= 900 AND ({X} - 0.5) / 20 + ({Y} - 900) / 90 <= 1 THEN 20 WHEN {X} BETWEEN 1 AND 40 AND {Y} >= 1500 AND {Y} <= CASE WHEN {X} <= 20 THEN 1900 - ({X} - 1) * 200 / 19 ELSE 1700 + ({X} - 20) * 10 END THEN 21"


@query(f"SELECT p_partkey, CAST(CASE {IN_BOXES} {IN_REST} END AS INT) AS region, CAST(CASE {' '.join(x for x in (IN_BOXES, IN_REST))} END IS NOT NULL AS BIGINT) AS matches FROM part")
def assign_region(spark, sf):
    out = spatial.assign_region(read(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice"), spatial.regions(spark, RINGS), "p_partkey", "p_size", "p_retailprice")
    return out.select("p_partkey", "region", "matches")


@query("SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def exclude_invalid_groups(spark, sf):
    return joins.exclude_invalid_groups(read(spark, sf, "lineitem"), "l_orderkey", F.col("l_returnflag") == "A")


@query("SELECT l_orderkey, count(DISTINCT year(l_shipdate)) AS n_values FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT year(l_shipdate)) > 1")
def conflicting_groups(spark, sf):
    return quality.conflicting_groups(read(spark, sf, "lineitem"), "l_orderkey", F.year("l_shipdate"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return quality.duplicate_keys(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1 ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 10")
def violation_examples(spark, sf):
    return duplicate_keys(spark, sf).orderBy(F.desc("n"), "l_orderkey", "l_linenumber").limit(10)


@query(f"""WITH {EV}, {GRID}, found AS (SELECT DISTINCT dist, hour_ts FROM ev WHERE event_type = 'error'), want AS (SELECT * FROM grid WHERE dist < 20 AND hour_ts < TIMESTAMP '2024-01-30')
SELECT dist, hour_ts, 'missing' AS side FROM want ANTI JOIN found USING (dist, hour_ts) UNION ALL SELECT dist, hour_ts, 'extra' FROM found ANTI JOIN want USING (dist, hour_ts)""")
def grid_key_diff(spark, sf):
    want = grid(spark, sf).where("dist < 20 AND hour_ts < timestamp_ntz '2024-01-30 00:00:00'")
    return joins.key_diff(want, incidents(spark, sf), ["dist", "hour_ts"])


SIDES = f"{EV}, a AS (SELECT nullif(dist, 7) AS dist, hour_ts, count(*) AS n_err FROM ev WHERE event_type = 'error' GROUP BY ALL), b AS (SELECT nullif(dist, 7) AS dist, hour_ts, round(avg(value), 4) AS mean_purchase FROM ev WHERE event_type = 'purchase' GROUP BY ALL)"


def outer_sides(spark, sf):
    df = events(spark, sf).withColumn("dist", F.when(F.col("dist") != 7, F.col("dist")))
    a = df.where("event_type = 'error'").groupBy("dist", "hour_ts").agg(F.count("*").alias("n_err"))
    b = df.where("event_type = 'purchase'").groupBy("dist", "hour_ts").agg(F.round(F.avg("value"), 4).alias("mean_purchase"))
    return a, b


@query(f"""WITH {SIDES} SELECT coalesce(a.dist, b.dist) AS dist, coalesce(a.hour_ts, b.hour_ts) AS hour_ts, n_err, mean_purchase, a.hour_ts IS NOT NULL AS has_err, b.hour_ts IS NOT NULL AS has_purchase
FROM a FULL JOIN b ON a.dist IS NOT DISTINCT FROM b.dist AND a.hour_ts = b.hour_ts""")
def full_outer_integrate(spark, sf):
    return joins.full_outer(*outer_sides(spark, sf), ["dist", "hour_ts"], ("has_err", "has_purchase"))


# Windows, sets, top-k


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(spark, sf):
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber").distinct()


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def drop_duplicates_keys(spark, sf):
    return read(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))


LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(f"SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, {', '.join(LINE)}) = 1")
def deduplicate(spark, sf):
    return dedup.deduplicate(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last(), *(F.col(c) for c in LINE)])


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 100 = 0 AND o_orderdate < TIMESTAMP '1998-01-01')")
def incremental_watermark(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dedup.after_watermark(df, df.where("o_orderkey % 100 = 0 AND o_orderdate < timestamp_ntz '1998-01-01 00:00:00'"), "o_orderdate")


@query("SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS _file_date FROM orders WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)")
def latest_file_snapshot(spark, sf):
    return dedup.latest_file_snapshot(read(spark, sf, "orders").select("o_orderkey", F.to_date(F.date_format("o_orderdate", "yyyy-MM-01")).alias("_file_date")), "_file_date")


@query("WITH o AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, date_trunc('month', o_orderdate)::DATE AS _file_date FROM orders) SELECT * FROM o QUALIFY _file_date = max(_file_date) OVER (PARTITION BY year)")
def latest_partition_snapshot(spark, sf):
    rows = read(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.to_date(F.date_format("o_orderdate", "yyyy-MM-01")).alias("_file_date"))
    return dedup.latest_partition_snapshot(rows, ["year"], "_file_date")


CUTOFF = "2024-01-15 10:00:00"


@query(f"SELECT user_id, event_type, ts, event_id, value FROM events WHERE ts <= TIMESTAMP '{CUTOFF}' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_entity(spark, sf):
    return dedup.latest_per_entity(read(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value"), ["user_id", "event_type"], "ts", F.lit(CUTOFF).cast("timestamp_ntz"), ["event_id"])


@query(f"""WITH {EV}, r AS (SELECT dist, count(*) AS n, round(avg(value), 4) AS mean, max(ts) AS newest FROM ev WHERE ts >= TIMESTAMP '{CUTOFF}' - INTERVAL 24 HOUR AND ts < TIMESTAMP '{CUTOFF}' + INTERVAL 1 MINUTE GROUP BY dist)
SELECT g.dist, coalesce(n, 0) AS n, mean, newest, (SELECT max(newest) FROM r) AS newest_of_all FROM (SELECT DISTINCT dist FROM ev) g LEFT JOIN r USING (dist)""")
def rolling_hour_features(spark, sf):
    rows = aggregates.rolling_window(events(spark, sf), "ts", CUTOFF, 24).groupBy("dist").agg(F.count("*").alias("n"), F.round(F.avg("value"), 4).alias("mean"), F.max("ts").alias("newest"))
    whole = rows.agg(F.max("newest").alias("newest_of_all"))
    return districts(spark, sf).join(rows, "dist", "left").fillna(0, ["n"]).join(F.broadcast(whole))


@query("SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def except_all_identity(spark, sf):
    keys = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    return keys.exceptAll(keys.distinct())


DIFFERENCE = "WITH a AS (SELECT l_orderkey, l_linenumber, count(*) AS k FROM lineitem GROUP BY ALL), b AS (SELECT o_orderkey AS l_orderkey, CAST(1 AS INT) AS l_linenumber, count(*) AS k FROM orders GROUP BY ALL)"


@query(f"""{DIFFERENCE} SELECT l_orderkey, l_linenumber, CASE WHEN coalesce(a.k, 0) > coalesce(b.k, 0) THEN 'left' ELSE 'right' END AS side, abs(coalesce(a.k, 0) - coalesce(b.k, 0)) AS times
FROM a FULL JOIN b USING (l_orderkey, l_linenumber) WHERE coalesce(a.k, 0) <> coalesce(b.k, 0)""")
def multiset_difference(spark, sf):
    """Lines against one first line per order: what either side has more often."""
    return joins.multiset_difference(read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber")))


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 32")
def ordered_sample(spark, sf):
    return read(spark, sf, "orders").orderBy("o_orderkey").limit(32)


# Aggregates and grids


@query(f"WITH {EV} SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS n_users, count(DISTINCT user_id) FILTER (event_type = 'error') AS n_err_users FROM ev GROUP BY 1")
def count_distinct_conditional(spark, sf):
    df = events(spark, sf)
    return df.groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("n_users"), F.countDistinct(F.when(F.col("event_type") == "error", F.col("user_id"))).alias("n_err_users"))


@query(f"WITH {EV} SELECT dist, hour_ts, count(value) AS n, round(avg(value), 4) AS mean, max(value) AS highest, round(sum(value), 4) AS total FROM ev WHERE hour_ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 22:00:00' GROUP BY dist, hour_ts")
def hourly_aggregate(spark, sf):
    a, b = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-05 00:00:00", "2024-01-20 22:00:00"))
    out = aggregates.hourly_aggregate(events(spark, sf).drop("hour_ts"), ["dist"], "ts", "value", a, b)
    return out.withColumns({"mean": F.round("mean", 4), "total": F.round("total", 4)})


@query(f"WITH {EV}, {GRID} SELECT dist, hour_ts FROM grid")
def dense_grid(spark, sf):
    """Every district with every hour of the data, with its uniqueness and completeness checked."""
    rows = grid(spark, sf)
    quality.require(quality.grid_problems(rows, "dist", "hour_ts"), "the grid")
    return rows


@query(f"""WITH {EV}, {GRID}, t AS (SELECT CASE WHEN dist <> 3 THEN dist END AS dist, hour_ts FROM grid WHERE dist <> 5 OR hour_ts < TIMESTAMP '2024-01-20' UNION ALL SELECT dist, hour_ts FROM grid WHERE dist = 1)
SELECT count(*) FILTER (dist IS NULL) AS n_null, count(*) FILTER (dist IS NOT NULL) - count(DISTINCT (dist, hour_ts)) FILTER (dist IS NOT NULL) AS n_repeated,
count(DISTINCT dist) * (SELECT count(*) FROM hrs) - count(DISTINCT (dist, hour_ts)) FILTER (dist IS NOT NULL) AS n_missing FROM t""")
def grid_problems(spark, sf):
    """A grid with null districts, one district twice and one that ends early."""
    rows = grid(spark, sf)
    odd = rows.where("dist <> 5 or hour_ts < timestamp_ntz '2024-01-20 00:00:00'").withColumn("dist", F.when(F.col("dist") != 3, F.col("dist")))
    return quality.grid_problems(odd.unionByName(rows.where("dist = 1")), "dist", "hour_ts")


@query(f"""WITH {EV}, {GRID}, c AS (SELECT dist, hour_ts, count(*) AS n FROM ev WHERE event_type = 'error' GROUP BY ALL)
SELECT dist, hour_ts, coalesce(n, 0) AS n, CAST(dayofweek(hour_ts) + 1 AS INT) AS weekday, dayname(hour_ts) AS day_name, {PART.format(h='hour(hour_ts)')} AS day_part FROM grid LEFT JOIN c USING (dist, hour_ts)""")
def dense_grid_counts(spark, sf):
    out = aggregates.dense_counts(incidents(spark, sf).drop("hour_ts"), ["dist"], "ts", districts(spark, sf), aggregates.hour_bounds(events(spark, sf), "ts"))
    return temporal.time_labels(out, "hour_ts")


LABELS = f"{EV}, {GRID}, c AS (SELECT dist, hour_ts - INTERVAL 1 HOUR AS hour_ts, count(DISTINCT user_id) AS n FROM ev WHERE event_type = 'error' GROUP BY ALL), labels1 AS (SELECT dist, hour_ts, coalesce(n, 0) AS n_next_hour, hour_ts + INTERVAL 1 HOUR AS next_hour_ts, CAST(coalesce(n, 0) > 0 AS INT) AS target_next_hour FROM grid LEFT JOIN c USING (dist, hour_ts))"


def label_rows(ev):
    """Labels of the grid of some measurements."""
    events_ = incidents_of(ev).withColumn("incident", F.concat_ws("@", F.col("user_id").cast("string"), F.col("hour_ts").cast("string"))).drop("hour_ts")
    return aggregates.lead_hour_label(grid_of(ev), events_, "dist", "incident", "ts", ["dist", "ts", "value"]).select("dist", "hour_ts", "n_next_hour", "next_hour_ts", "target_next_hour")


@query(f"WITH {LABELS} SELECT * FROM labels1")
def lead_hour_label(spark, sf):
    return label_rows(events(spark, sf))
