"""Point in polygon as an equi-join by cell.

Each polygon is covered by cells of a quadtree whose sides are powers of two: a cell that its border crosses is split
while it holds many edges, a cell inside is kept whole, one outside goes.  A point lies in one cell of each size, so
points meet polygons by (size, column, row).  Only points in border cells are tested, against the edges that a ray from
that cell can meet.  Neither polygons nor points are limited in number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanflow.sources.tables import materialized

EDGES = "array<struct<ax:double,ay:double,bx:double,by:double>>"
#: A border cell with more edges is split, so many times at most.
LEAF_EDGES, DEPTH = 12, 5
#: Cells count as touched by an edge from so near, in parts of the numbers at hand: rounding then costs a test, no point.
SLACK = 1e-9


def regions(spark: SparkSession, rings: dict[int, list[tuple[float, float]]]) -> DataFrame:
    """code and edges of closed rings."""
    rows = []
    for code, ring in rings.items():
        ring = [(float(x), float(y)) for x, y in ring]
        rows.append((code, [(*a, *b) for a, b in zip(ring, [*ring[1:], *ring[:1]], strict=True)]))
    return spark.createDataFrame(rows, f"code int, edges {EDGES}")


def odd_crossings(edges: str | Column, x: Column, y: Column) -> Column:
    """Whether a ray from the point to greater x crosses the edges an odd number of times."""

    def crosses(e):
        return ((e.ay > y) != (e.by > y)) & (x < (e.bx - e.ax) * (y - e.ay) / (e.by - e.ay) + e.ax)

    # `when` keeps horizontal edges from a division by zero.
    return F.aggregate(edges, F.lit(False), lambda inside, e: F.when(e.ay == e.by, inside).otherwise(inside != crosses(e)))


def covers(edges: str | Column, x: Column, y: Column) -> Column:
    """Inside or on an edge."""

    def on(e):
        cross = (e.bx - e.ax) * (y - e.ay) - (e.by - e.ay) * (x - e.ax)
        return (cross == 0) & x.between(F.least(e.ax, e.bx), F.greatest(e.ax, e.bx)) & y.between(F.least(e.ay, e.by), F.greatest(e.ay, e.by))

    return F.exists(edges, on) | odd_crossings(edges, x, y)


def _classified(cells: DataFrame) -> DataFrame:
    """New cells (inside is null) with the edges that matter in them; those outside go.  Others stay as they are."""
    side = F.pow(F.lit(2.0), F.col("e"))
    x0, y0 = F.col("ix") * side, F.col("iy") * side
    x1, y1, new = x0 + side, y0 + side, F.col("inside").isNull()
    near = F.lit(SLACK) * (F.abs(x0) + F.abs(y0) + side)

    def matters(e):  # to a ray from anywhere in the cell
        return (F.greatest(e.ay, e.by) >= y0 - near) & (F.least(e.ay, e.by) <= y1 + near) & (F.greatest(e.ax, e.bx) >= x0 - near)

    def touches(e):
        dx, dy = e.bx - e.ax, e.by - e.ay
        corners = [dx * (y - e.ay) - dy * (x - e.ax) for x in (x0, x1) for y in (y0, y1)]
        slack = near * (F.abs(dx) + F.abs(dy))
        return (F.least(e.ax, e.bx) <= x1 + near) & (F.least(*corners) <= slack) & (F.greatest(*corners) >= -slack)

    cells = cells.withColumn("edges", F.when(new, F.filter("edges", matters)).otherwise(F.col("edges")))
    cells = cells.withColumn("border", F.when(new, F.exists("edges", touches)).otherwise(F.col("border")))
    inside = F.when(new, F.when(F.col("border"), False).otherwise(odd_crossings("edges", x0 + side / 2, y0 + side / 2))).otherwise(F.col("inside"))
    return cells.withColumn("inside", inside).where("border or inside").withColumn("edges", F.when(F.col("border"), F.col("edges")).otherwise(F.array().cast(EDGES)))


def cover(polygons: DataFrame, leaf_edges: int = LEAF_EDGES, depth: int = DEPTH) -> DataFrame:
    """code, e (a cell's side is 2 ** e), ix, iy, inside, border, edges: cells that together hold each polygon, border included."""
    finite = F.forall("edges", lambda e: F.abs(e.ax) + F.abs(e.ay) + F.abs(e.bx) + F.abs(e.by) < float("inf"))
    box = {f"{axis}{k}": f(F.concat(F.col(f"edges.a{axis}"), F.col(f"edges.b{axis}"))) for axis in ("x", "y") for k, f in ((0, F.array_min), (1, F.array_max))}
    boxes = polygons.select("code", "edges").where(finite & (F.size("edges") > 0)).withColumns(box)
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"), F.lit(2.0**-60), F.lit(2.0**-40) * F.greatest(*(F.abs(F.col(c)) for c in box)))
    boxes = boxes.withColumn("e", F.ceil(F.log2(size)).cast("int"))
    at = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("e"))).cast("bigint")
    cells = boxes.select("code", "edges", "e", F.explode(F.sequence(at("x0"), at("x1"))).alias("ix"), at("y0").alias("a"), at("y1").alias("b"))
    cells = cells.select("code", "edges", "e", "ix", F.explode(F.sequence("a", "b")).alias("iy"), F.lit(None).cast("boolean").alias("inside"), F.lit(None).cast("boolean").alias("border"))
    cells = _classified(cells)
    for _ in range(depth):
        cell = lambda e, x, y, new: F.struct(e.alias("e"), x.alias("ix"), y.alias("iy"), new.alias("new"))
        four = F.array(*(cell(F.col("e") - 1, F.col("ix") * 2 + i, F.col("iy") * 2 + j, F.lit(True)) for i in (0, 1) for j in (0, 1)))
        split = F.when(F.col("border") & (F.size("edges") > leaf_edges), four).otherwise(F.array(cell(F.col("e"), F.col("ix"), F.col("iy"), F.lit(False))))
        parts = cells.select("code", "edges", "inside", "border", F.explode(split).alias("c"))
        cells = _classified(parts.select("code", "edges", "c.e", "c.ix", "c.iy", *(F.when(~F.col("c.new"), F.col(k)).alias(k) for k in ("inside", "border"))))
    return cells


def assign_region(points: DataFrame, polygons: DataFrame, key: str, x: str, y: str, strict: bool = False) -> DataFrame:
    """points with region (null unless exactly one covers it) and matches.  polygons: code and edges, as of `regions`.

    strict raises if a key is null or repeated, a coordinate is null or NaN, or a point isn't in exactly one region.
    """
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    cells = cover(polygons).select(F.col("code").alias("_code"), F.col("e").alias("_e"), F.col("ix").alias("_ix"), F.col("iy").alias("_iy"), F.col("inside").alias("_inside"), F.col("edges").alias("_edges"))
    cells = materialized(cells)
    sizes = sorted(r["_e"] for r in cells.select("_e").distinct().collect())  # a few dozen at most: polygons' sizes by powers of two
    at = lambda v, e: F.floor(v / F.pow(F.lit(2.0), e)).cast("bigint")
    placed = points.select(key, px.alias("_x"), py.alias("_y")).where((F.abs("_x") < float("inf")) & (F.abs("_y") < float("inf")))
    placed = placed.withColumn("_size", F.explode(F.array(*(F.lit(e) for e in sizes)).cast("array<int>")))
    placed = placed.select(key, "_x", "_y", "_size", at(F.col("_x"), F.col("_size")).alias("_px"), at(F.col("_y"), F.col("_size")).alias("_py"))
    met = placed.join(cells, (F.col("_size") == F.col("_e")) & (F.col("_px") == F.col("_ix")) & (F.col("_py") == F.col("_iy")))
    hits = met.where(F.when(F.col("_inside"), True).otherwise(covers("_edges", F.col("_x"), F.col("_y"))))
    hits = hits.groupBy(key).agg(F.count("*").alias("matches"), F.min("_code").alias("_code"))
    out = points.join(hits, key, "left").withColumns({"region": F.when(F.col("matches") == 1, F.col("_code")), "matches": F.coalesce("matches", F.lit(0))}).drop("_code")
    if strict:
        bad = out.where(F.col(key).isNull() | px.isNull() | py.isNull() | F.isnan(px) | F.isnan(py) | (F.col("matches") != 1))
        if not bad.isEmpty() or not out.groupBy(key).count().where("count > 1").isEmpty():
            raise ValueError(f"points without exactly one region, or keys that aren't unique, e.g. {[r[key] for r in bad.limit(3).collect()]}")
    return out
