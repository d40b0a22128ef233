"""Data-quality operators: each is one aggregate over its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (lower, lower is inside, upper, upper is inside); None: open.
Range = tuple[float | None, bool, float | None, bool]


def in_range(column: str, r: Range) -> Column:
    """Finite and within the range; null is outside."""
    c = F.col(column).cast("double")
    low, low_in, high, high_in = r
    ok = c.isNotNull() & ~F.isnan(c) & (c != float("inf")) & (c != float("-inf"))
    if low is not None:
        ok = ok & ((c >= low) if low_in else (c > low))
    if high is not None:
        ok = ok & ((c <= high) if high_in else (c < high))
    return F.coalesce(ok, F.lit(False))


def sanitize_ranges(df: DataFrame, ranges: dict[str, Range]) -> DataFrame:
    """Values outside become null; <name>_available tells which were inside."""
    ok = {c: in_range(c, r) for c, r in ranges.items()}
    return df.withColumns({c: F.when(o, F.col(c)) for c, o in ok.items()} | {f"{c}_available": o.cast("int") for c, o in ok.items()})


def count_if(condition: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("bigint").alias(name)


def counters(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that meet each condition, in one pass."""
    return df.agg(*(count_if(c, n) for n, c in checks.items()))


def feature_quality_profile(df: DataFrame, ranges: dict[str, Range]) -> DataFrame:
    """A row per feature: missing or not finite, outside its range, valid."""
    each = []
    for c, r in ranges.items():
        v = F.col(c).cast("double")
        gone = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
        each.append(F.struct(F.lit(c).alias("feature"), count_if(gone, "m").alias("missing"), count_if(~gone & ~in_range(c, r), "o").alias("out_of_range"), count_if(in_range(c, r), "v").alias("valid")))
    return df.agg(F.array(*each).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")


def require(checks: DataFrame, what: str) -> None:
    """Raises if a counter of the one row of checks isn't 0."""
    if bad := {k: v for k, v in checks.first().asDict().items() if v}:
        raise ValueError(f"{what}: {bad}")


def grid_problems(grid: DataFrame, entity: str, ts: str) -> DataFrame:
    """One row: null keys, repeated rows, and how many rows of entities x hours (from the first to the last) are missing."""
    keys = grid.groupBy(entity, ts).agg(F.count("*").alias("n"))
    hours = (F.unix_timestamp(F.max(ts).cast("timestamp")) - F.unix_timestamp(F.min(ts).cast("timestamp"))) / 3600 + 1
    whole = F.col(entity).isNotNull() & F.col(ts).isNotNull()
    sums = keys.agg(
        F.coalesce(F.sum(F.when(~whole, F.col("n"))), F.lit(0)).alias("n_null"), F.coalesce(F.sum(F.when(whole, F.col("n") - 1)), F.lit(0)).alias("n_repeated"),
        (F.countDistinct(F.when(whole, F.col(entity))) * hours - count_if(whole, "x")).cast("bigint").alias("n_missing"))
    return sums


def count_without_mean(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """One row: for each mean and its count, the rows where one says that there are values and the other that there are none."""
    checks = {}
    for mean, n in pairs.items():
        checks |= {f"{mean}_without_{n}": F.col(mean).isNotNull() & (F.col(n) == 0), f"{n}_without_{mean}": F.col(mean).isNull() & (F.col(n) > 0)}
    return counters(df, checks)


def reconciled(parts: DataFrame, names: list[str], total: str) -> DataFrame:
    """parts (one row of counts) with `difference`: the total less its parts."""
    return parts.withColumn("difference", F.col(total) - sum((F.col(n) for n in names), F.lit(0)))


def summary_problems(summary: DataFrame, expected: dict) -> DataFrame:
    """One row: 1 for each value of the summary that isn't the expected one."""
    return summary.select(*((~F.col(k).eqNullSafe(F.lit(v).cast(summary.schema[k].dataType))).cast("bigint").alias(k) for k, v in expected.items()))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def conflicting_groups(df: DataFrame, key: str, value: Column) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(value).alias("n_values")).where("n_values > 1")


def lineage_check(tables: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """A row per different lineage: the tables that have it, and whether a part is null."""
    rows = None
    for name, df in tables.items():
        own = df.select(*columns).distinct().withColumn("table", F.lit(name))
        rows = own if rows is None else rows.unionByName(own)
    hole = F.lit(False)
    for c in columns:
        hole = hole | F.col(c).isNull()
    return rows.groupBy(*columns).agg(F.array_join(F.sort_array(F.collect_set("table")), ",").alias("tables")).withColumn("has_null", hole)


def version_drift(expected: DataFrame, captured: DataFrame) -> DataFrame:
    """Tables whose versions differ, or that one side lacks."""
    a, b = expected.select("table", F.col("version").alias("expected")), captured.select("table", F.col("version").alias("captured"))
    return a.join(b, "table", "full").where(~F.col("expected").eqNullSafe(F.col("captured")))


def output_summary(df: DataFrame, entity: str, ts: str, target: str) -> DataFrame:
    positive = F.col(target) == 1
    return df.agg(
        F.count("*").alias("n_rows"), F.countDistinct(entity).alias("n_entities"), F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour"),
        count_if(positive, "n_positive"), F.countDistinct(F.when(positive, F.col(entity))).alias("n_positive_entities"))


def schema_problems(df: DataFrame, contract: list[tuple[str, str, bool]]) -> DataFrame:
    """name and problem (missing, extra, position, type or nullability) of columns that differ from (name, type, may be null)."""
    fields, wanted, rows = {f.name: (i, f) for i, f in enumerate(df.schema.fields)}, {name for name, _, _ in contract}, []
    for i, (name, kind, nullable) in enumerate(contract):
        if name not in fields:
            rows.append((name, "missing"))
            continue
        at, f = fields[name]
        rows += [(name, what) for what, differs in (("position", at != i), ("type", f.dataType.simpleString() != kind), ("nullability", f.nullable and not nullable)) if differs]
    rows += [(name, "extra") for name in fields if name not in wanted]
    return df.sparkSession.createDataFrame(rows, "name string, problem string")
