"""Lookups, exclusions, densifying and null-safe outer joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanflow.operators.columns import REGISTRY, require_columns


def lookup_join(df: DataFrame, lookup: DataFrame, on: Mapping[str, str], take: Mapping[str, str], how: str = "left") -> DataFrame:
    """df with columns of a lookup table.  on: column -> lookup column; take: new name -> lookup column.

    Spark broadcasts the lookup where its size allows; only the columns needed are read.
    """
    require_columns(df, on, "lookup_join")
    require_columns(lookup, [*on.values(), *take.values()], "lookup table")
    if clash := sorted(set(take) & set(df.columns)):
        raise ValueError(f"columns exist already: {clash}")
    keys = {k: f"_on_{i}" for i, k in enumerate(on)}
    side = lookup.select(*(F.col(on[k]).alias(a) for k, a in keys.items()), *(F.col(c).alias(n) for n, c in take.items()))
    return df.join(side, [F.col(k) == F.col(a) for k, a in keys.items()], how).drop(*keys.values())


def exclude_invalid_groups(df: DataFrame, key: str, invalid: Column) -> DataFrame:
    """Without every row of a group in which one row is invalid."""
    return df.join(df.where(invalid).select(key).distinct(), key, "left_anti")


def key_diff(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are missing from, or extra in, `found`, with which of the two."""
    a, b = expected.select(*keys).distinct(), found.select(*keys).distinct()
    missing = a.join(b, keys, "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(b.join(a, keys, "left_anti").withColumn("side", F.lit("extra")))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with that side and how much more often."""
    # Both sides meet in one aggregate, so a task holds one table of its rows and not one of each side and one of both.
    a, b = (df.select(*left.columns, F.lit(sign).cast("bigint").alias("_more")) for df, sign in ((left, 1), (right, -1)))
    signed = a.unionByName(b).groupBy(*left.columns).agg(F.sum("_more").alias("_more")).where("_more <> 0")
    return signed.select(*left.columns, F.when(F.col("_more") > 0, "left").otherwise("right").alias("side"), F.abs("_more").alias("times"))


def densify(grid: DataFrame, facts: DataFrame, keys: list[str], zero: list[str]) -> DataFrame:
    """Every row of grid; counts without facts are 0.  Null keys meet each other."""
    side = facts.select(*(F.col(k).alias(f"_{k}") for k in keys), *zero)
    out = grid.join(side, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left").drop(*(f"_{k}" for k in keys))
    return out.fillna(0, zero)


def full_outer(left: DataFrame, right: DataFrame, keys: list[str], flags: tuple[str, str]) -> DataFrame:
    """Null-safe full outer join with one copy of the keys and flags for the sides that were there."""
    a = left.withColumn(flags[0], F.lit(True))
    b = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys)).withColumn(flags[1], F.lit(True))
    out = a.join(b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "full")
    named = [F.coalesce(k, f"_{k}").alias(k) for k in keys]
    rest = [c for c in [*left.columns, *right.columns] if c not in keys]
    return out.select(*named, *rest, *(F.coalesce(f, F.lit(False)).alias(f) for f in flags))


REGISTRY["lookup_join"] = lookup_join
