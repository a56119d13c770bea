"""Queries on polygons whose shapes come from the tables: repair, dissolve, containment in large units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import polygons as Y
from ..operators import spatial as P
from .registry import query


def _scaled(points: list[tuple[int, int]], by: Column, dx: Column, dy: Column) -> Column:
    return F.array(*(F.struct((dx + x * by).cast("double").alias("x"), (dy + y * by).cast("double").alias("y")) for x, y in points))


#: A bow-tie, a square with a spike, a ring that crosses itself twice, a square with a hole, and a line.
EVENT_SHAPES = [
    [[(0, 0), (2, 2), (2, 0), (0, 2)]],
    [[(0, 0), (4, 0), (4, 2), (7, 2), (4, 2), (4, 4), (0, 4)]],
    [[(0, 0), (3, 3), (6, 0), (6, 3), (3, 0), (0, 3)]],
    [[(0, 0), (9, 0), (9, 9), (0, 9)], [(3, 3), (3, 6), (6, 6), (6, 3)]],
    [[(0, 0), (5, 5)]],
]


def event_shapes(spark, sf) -> DataFrame:
    """A shape for each event, of one of five kinds, moved and scaled."""
    rows = spark.read.parquet(f"{sf}/events.parquet").select("event_id", (F.col("event_id") % 5).alias("kind"), (F.col("event_id") % 3 + 1).alias("by"), F.col("user_id").alias("dx"), F.length("event_type").alias("dy"))
    shape = F.lit(None)
    for k, rings in enumerate(EVENT_SHAPES):
        listed = F.array(*(F.struct(F.lit(0).alias("part"), F.lit(r).alias("ring"), _scaled(pts, F.col("by"), F.coalesce("dx", F.lit(0)), F.coalesce("dy", F.lit(0))).alias("pts")) for r, pts in enumerate(rings)))
        shape = F.when(F.col("kind") == k, F.struct(F.lit("LineString" if k == 4 else "Polygon").alias("type"), listed.alias("rings"))).otherwise(shape)
    return rows.select("event_id", shape.alias("geometry"))


def ring_area(ring: Column) -> Column:
    """Area of a ring of points, without sign."""
    n, first = F.size(ring["pts"]), ring["pts"][0]
    at = lambda k: F.element_at(ring["pts"], k)
    terms = F.transform(F.sequence(F.lit(1), n), lambda k: (at(k)["x"] - first["x"]) * (at(k % n + 1)["y"] - first["y"]) - (at(k % n + 1)["x"] - first["x"]) * (at(k)["y"] - first["y"]))
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)) / 2


def area(rings: Column) -> Column:
    return F.aggregate(F.transform(rings, lambda r: F.when(r["ring"] == 0, ring_area(r)).otherwise(-ring_area(r))), F.lit(0.0), lambda s, t: s + t)


@query("repaired_polygons", "SELECT event_id, [2, 1, 3, 1][k] parts, [2, 1, 3, 2][k] rings, CAST([2, 16, 9, 72][k] * s * s AS DOUBLE) area, k = 4 AS valida, k = 4 AS same FROM (SELECT event_id, CAST(event_id % 5 + 1 AS INTEGER) k, event_id % 3 + 1 s FROM events) WHERE k < 5")
def repaired_polygons(spark, sf):
    """Crossing rings become parts, spikes go, valid shapes stay as they were, lines go."""
    own = event_shapes(spark, sf).withColumn("_before", F.col("geometry"))
    rings = F.col("geometry.rings")
    parts = F.size(F.array_distinct(F.transform(rings, lambda r: r["part"])))
    return Y.repair(own).select("event_id", parts.alias("parts"), F.size(rings).alias("rings"), F.round(area(rings), 6).alias("area"), "valida", (F.col("geometry") == F.col("_before")).alias("same"))


def customer_cells(spark, sf) -> DataFrame:
    """A unit square for each customer, those of even columns as two halves, so that corners lie on neighbours' edges."""
    k = F.col("c_custkey")
    rows = spark.read.parquet(f"{sf}/customer.parquet").select("c_mktsegment", (k % 61).cast("double").alias("x"), F.floor(k / 61).cast("double").alias("y"))
    rows = rows.withColumn("h", F.explode(F.when(F.col("x") % 2 == 0, F.array(F.lit(0.0), F.lit(0.5))).otherwise(F.array(F.lit(0.0)))))
    low, high = F.col("y") + F.col("h"), F.col("y") + F.when(F.col("x") % 2 == 0, F.col("h") + 0.5).otherwise(1.0)
    pts = F.array(*(F.struct((F.col("x") + dx).alias("x"), y.alias("y")) for dx, y in ((0, low), (1, low), (1, high), (0, high))))
    return rows.select(F.col("c_mktsegment").alias("uf"), F.struct(F.lit("Polygon").alias("type"), F.array(F.struct(F.lit(0).alias("part"), F.lit(0).alias("ring"), pts.alias("pts"))).alias("rings")).alias("geometry"))


_CELLS = "SELECT c_mktsegment uf, c_custkey % 61 x, c_custkey // 61 y FROM customer"


@query("dissolved_polygons", f"""SELECT c.uf, CAST(count(*) AS DOUBLE) area, CAST(4 * count(*) - 2 * (SELECT count(*) FROM ({_CELLS}) a JOIN ({_CELLS}) b ON a.uf = b.uf AND (a.x + 1 = b.x AND a.y = b.y OR a.x = b.x AND a.y + 1 = b.y) WHERE a.uf = c.uf) AS DOUBLE) border,
CAST(min(x) AS DOUBLE) west, CAST(min(y) AS DOUBLE) south, CAST(max(x) + 1 AS DOUBLE) east, CAST(max(y) + 1 AS DOUBLE) north FROM ({_CELLS}) c GROUP BY c.uf""")
def dissolved_polygons(spark, sf):
    """The union of the squares of each market segment, as polygons."""
    whole = Y.dissolve(customer_cells(spark, sf), "uf")
    e = P.unit_edges(whole, "uf").groupBy("uf").agg(F.round(F.sum(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), 6).alias("border"), F.min("x1").alias("west"), F.min("y1").alias("south"), F.max("x1").alias("east"), F.max("y1").alias("north"))
    return whole.select("uf", F.round(area(F.col("geometry.rings")), 6).alias("area")).join(e, "uf")
