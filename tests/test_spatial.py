import math

import pytest
from pyspark.sql import functions as F

from terracover.functions.geometry import contains, crosses_itself, edges, from_wkb_bytes, interior_point_of, to_wkb_bytes
from terracover.operators import polygons as Y
from terracover.operators import spatial as P

GEOMETRY = "struct<type:string, rings:array<struct<part:int, ring:int, pts:array<struct<x:double,y:double>>>>>"
SQUARE = [(0, 0, [(-51.5, -30.2), (-51.0, -30.2), (-51.0, -29.9), (-51.5, -29.9), (-51.5, -30.2)])]
HOLED = [(0, 0, [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]), (0, 1, [(3.0, 3.0), (6.0, 3.0), (6.0, 6.0), (3.0, 6.0)]), (1, 0, [(20.0, 0.0), (22.0, 0.0), (22.0, 2.0), (20.0, 2.0)])]
ELL = [(0, 0, [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0)])]
BOW = [(0, 0, [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)])]


def as_dicts(rings):
    return [{"part": p, "ring": r, "pts": [{"x": x, "y": y} for x, y in pts]} for p, r, pts in rings]


def units(spark, **shapes):
    return spark.createDataFrame([(k.lstrip("u"), k[:2], ("Polygon", v)) for k, v in shapes.items()], f"municipio_ibge string, uf string, geometry {GEOMETRY}")


def test_contains(spark):
    cases = [(HOLED, 1, 1, True), (HOLED, 4, 4, False), (HOLED, 21, 1, True), (HOLED, 15, 1, False), (HOLED, 3, 4, False), (HOLED, 0, 4, False), (HOLED, 9, 9, False), (ELL, 3, 3, False), (ELL, 0.5, 3, True), (ELL, 3, 0.5, True), (ELL, 1, 1, False), (BOW, 1.5, 1.0, True), (BOW, 1.0, 0.2, False)]
    df = spark.createDataFrame([(k, ("P", g), float(x), float(y)) for k, (g, x, y, _) in enumerate(cases)], f"k int, g {GEOMETRY}, x double, y double")
    assert [r.i for r in df.select("k", contains(edges(F.col("g.rings")), F.col("x"), F.col("y")).alias("i")).orderBy("k").collect()] == [c[3] for c in cases]


@pytest.mark.parametrize("rings", [SQUARE, HOLED, ELL])
def test_interior_point_and_wkb(spark, rings):
    p = interior_point_of(as_dicts(rings))
    df = spark.createDataFrame([(("P", rings), p["x"], p["y"])], f"g {GEOMETRY}, x double, y double")
    assert df.select(contains(edges(F.col("g.rings")), F.col("x"), F.col("y"))).first()[0]
    geometry = {"type": "MultiPolygon", "rings": as_dicts(rings)}
    assert from_wkb_bytes(to_wkb_bytes(geometry)) == geometry
    assert not crosses_itself(as_dicts(rings))


def test_bow_tie_is_invalid():
    assert crosses_itself(as_dicts(BOW))


def test_place(spark):
    points = [(0, "4314902", -30.03, -51.23, "endereço"), (1, None, None, None, ""), (2, "9999999", None, None, ""), (3, "4314902", 0.0, 0.0, "endereço"), (4, "4314902", None, None, "")]
    df = spark.createDataFrame(points, "_rid long, municipio_ibge string, latitude double, longitude double, precisao string")
    placed, causes = P.place(df, units(spark, u4314902=SQUARE))
    rows = {r._rid: r for r in placed.collect()}
    assert set(rows) == {0, 3, 4} and rows[0].precisao == "endereço" and rows[3].precisao == rows[4].precisao == "município"
    assert P.inside_own_unit(placed, units(spark, u4314902=SQUARE)).where("not dentro").count() == 0
    assert tuple(causes.first()) == (1, 1)


def test_fan_out_and_revert(spark):
    df = spark.createDataFrame([(k, "4314902", -30.03, -51.23, "endereço") for k in range(3)] + [(9, "4314902", -30.0, -51.2, "x"), (10, "4314902", None, None, "")], "_rid long, municipio_ibge string, latitude double, longitude double, precisao string")
    rows = {r._rid: r for r in P.fan_out(df).collect()}

    def metres(r):
        return math.hypot((r.lat_nova - r.latitude) * 111320, (r.lon_nova - r.longitude) * 111320 * math.cos(math.radians(r.latitude)))

    assert metres(rows[0]) == 0 and abs(metres(rows[1]) - 8 * math.sqrt(0.5)) < 1e-6 and abs(metres(rows[2]) - 8) < 1e-6
    assert metres(rows[9]) == 0 and rows[10].lat_nova is None
    tiny = units(spark, u4314902=[(0, 0, [(-51.23001, -30.03001), (-51.22999, -30.03001), (-51.22999, -30.02999), (-51.23001, -30.02999)])])
    back = P.revert_outside(P.fan_out(df.where("_rid < 3")), tiny)
    assert back.where("latitude = -30.03 and longitude = -51.23").count() == 3


def test_dissolve_and_bounds(spark):
    a = [(0, 0, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])]
    b = [(0, 0, [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0), (1.0, 0.0)])]
    df = units(spark, ua=a, ub=b).withColumn("uf", F.lit("X"))
    assert P.dissolve_edges(df).count() == 6
    assert {tuple(r) for r in P.bounds(df, "uf").select("uf", "south", "west", "north", "east").collect()} == {("X", 0.0, 0.0, 1.0, 2.0), ("todos", 0.0, 0.0, 1.0, 2.0)}
    mixed = df.union(df.withColumn("geometry", F.col("geometry").withField("type", F.lit("GeometryCollection"))))
    assert Y.repair(mixed).where("valida").count() == 2
