"""Points in polygons against a plain loop, and grids, batches and regions of any number."""

import math
import random

import pytest
from pyspark.sql import functions as F

from urbanflow.operators import aggregates, nrt, spatial


def inside(ring, x, y):
    """Winding of the ring around a point; its border counts as inside."""
    turns = 0
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]], strict=True):
        cross = (bx - ax) * (y - ay) - (by - ay) * (x - ax)
        if cross == 0 and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by):
            return True
        turns += (ay <= y < by and cross > 0) - (by <= y < ay and cross < 0)
    return turns != 0


def star(rng, x, y, size, n):
    """A ring without crossings around a centre; corners on a fine grid, so that points can lie exactly on it."""
    turn = [2 * math.pi * i / n for i in range(n)]
    return [(x + round(8 * size * (0.3 + 0.7 * rng.random()) * math.cos(t)) / 8, y + round(8 * size * (0.3 + 0.7 * rng.random()) * math.sin(t)) / 8) for t in turn]


def test_many_edged_polygons_equal_a_loop(spark, monkeypatch):
    rng = random.Random(7)
    rings = {1: [(0, 0), (16, 0), (16, 16), (0, 16)], 2: [(16, 0), (32, 0), (24, 8), (32, 16), (16, 16)], 3: [(-40, -40), (-39, -40), (-39, -39.5)]}
    rings |= {10 + i: star(rng, rng.randint(-60, 60), rng.randint(-60, 60), rng.choice([2, 9, 40]), rng.choice([5, 40, 300])) for i in range(12)}
    points = [(rng.randint(-400, 400) / 4, rng.randint(-400, 400) / 4) for _ in range(500)] + [p for ring in rings.values() for p in ring[:12]] + [(16.0, 4.0), (0.0, 0.0), (24.0, 8.0)]
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "k int, x double, y double")
    got = {r.k: (r.region, r.matches) for r in spatial.assign_region(df, spatial.regions(spark, rings), "k", "x", "y").collect()}
    for i, (x, y) in enumerate(points):
        hits = [c for c, ring in rings.items() if inside(ring, x, y)]
        assert got[i] == (hits[0] if len(hits) == 1 else None, len(hits)), (x, y)
    kinds = {r.inside: r["count"] for r in spatial.cover(spatial.regions(spark, rings)).groupBy("inside").count().collect()}
    assert kinds[True] > 50 and kinds[False] > 50


def test_odd_points_and_polygons(spark):
    polygons = spatial.regions(spark, {1: [(0, 0), (4, 0), (4, 4), (0, 4)], 2: [(1e6, 1e6), (1e6 + 1, 1e6), (1e6, 1e6 + 1)], 3: [(float("nan"), 0), (1, 1), (2, 2)], 4: []} | {5: [(9, 9), (9, 9), (9, 9)]})
    rows = [(1, 2.0, 2.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, float("inf"), 1.0), (5, 1e6, 1e6), (6, 9.0, 9.0), (None, 2.0, 2.0), (7, 1e300, -1e300)]
    points = spark.createDataFrame(rows, "k int, x double, y double")
    got = {r.k: (r.region, r.matches) for r in spatial.assign_region(points, polygons, "k", "x", "y").collect()}
    assert got == {1: (1, 1), 2: (None, 0), 3: (None, 0), 4: (None, 0), 5: (2, 1), 6: (5, 1), None: (None, 0), 7: (None, 0)}
    assert spatial.assign_region(points, polygons.limit(0), "k", "x", "y").agg(F.sum("matches")).first()[0] == 0
    with pytest.raises(ValueError, match="without exactly one"):
        spatial.assign_region(points, polygons, "k", "x", "y", strict=True)
    good = points.where("k in (1, 5, 6)")
    assert spatial.assign_region(good, polygons, "k", "x", "y", strict=True).count() == 3
    with pytest.raises(ValueError, match="unique"):
        spatial.assign_region(good.unionByName(good), polygons, "k", "x", "y", strict=True)


def test_a_hundred_thousand_polygons(spark):
    """Squares side by side; every point lies in the one that its place tells."""
    n = 317
    x, y = F.col("id") % n, F.floor(F.col("id") / n)
    corner = lambda i, j: ((x + i).cast("double"), (y + j).cast("double"))
    edge = lambda a, b: F.struct(a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by"))
    ring = [corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1)]
    polygons = spark.range(n * n).select(F.col("id").cast("int").alias("code"), F.array(*(edge(a, b) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))).alias("edges"))
    points = spark.range(50_000).select("id", ((F.col("id") * 7919) % n + 0.25).alias("x"), ((F.col("id") * 104_729) % n + 0.5).alias("y"))
    out = spatial.assign_region(points, polygons, "id", "x", "y")
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    want = (F.floor("x") + F.floor("y") * n).cast("int")
    assert out.where(F.col("region").eqNullSafe(want) & (F.col("matches") == 1)).count() == 50_000


def test_a_million_entities(spark):
    """Grids and batches of a million entities: only the bounds, one row, are broadcast."""
    entities = spark.range(1_000_000).select(F.col("id").alias("e"))
    times = spark.createDataFrame([("2024-03-01 22:10:00",), ("2024-03-02 00:05:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    rows = aggregates.dense_grid(entities, aggregates.hour_bounds(times, "t"))
    got = rows.agg(F.count("*").alias("n"), F.min("hour_ts").cast("string").alias("a"), F.max("hour_ts").cast("string").alias("b"), F.sum("e").alias("s")).first()
    assert tuple(got) == (3_000_000, "2024-03-01 22:00:00", "2024-03-02 00:00:00", 3 * 499_999_500_000)
    assert aggregates.dense_grid(entities, aggregates.hour_bounds(times.limit(0), "t")).count() == 0
    batch = entities.where("e <> 5").withColumn("s", F.when(F.col("e") == 7, 2.0).otherwise(0.5)).unionByName(spark.createDataFrame([(9, 0.1), (-1, 0.1)], "e bigint, s double"))
    assert nrt.batch_problems(batch, entities, "e", "s").first().asDict() == {"n_missing": 1, "n_repeated": 1, "n_unknown": 1, "n_out_of_range": 1}
