"""Repair and dissolve against hand-made shapes, random rings and flood fill."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from terracover.operators import polygons as Y
from terracover.operators import spatial as P

GEOMETRY = "struct<type:string, rings:array<struct<part:int, ring:int, pts:array<struct<x:double,y:double>>>>>"


def frame(spark, rows):
    return spark.createDataFrame(rows, f"municipio_ibge string, geometry {GEOMETRY}")


def as_parts(geometry):
    """{part: [signed area of each ring]}, shells first."""
    out = collections.defaultdict(list)
    for r in geometry.rings:
        pts = [(p.x, p.y) for p in r.pts]
        out[r.part].append(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(pts, pts[1:] + pts[:1], strict=True)) / 2)
    return out


def odd(rings, x, y):
    inside = False
    for pts in rings:
        for (x1, y1), (x2, y2) in zip(pts, pts[1:] + pts[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
                inside = not inside
    return inside


SQUARE = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]
CASES = {
    # rings, valid, areas of the shells, areas of the holes
    "bow": ([[(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0)]], False, [1, 1], []),
    "spike": ([[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (7.0, 2.0), (4.0, 2.0), (4.0, 4.0), (0.0, 4.0)]], False, [16], []),
    "spike without its foot": ([[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (7.0, 2.0), (3.0, 2.0), (3.0, 4.0), (0.0, 4.0)]], False, [14], []),
    "twice": ([[(0.0, 0.0), (3.0, 3.0), (6.0, 0.0), (6.0, 3.0), (3.0, 0.0), (0.0, 3.0)]], False, [2.25, 4.5, 2.25], []),
    "hole": ([SQUARE, [(3.0, 3.0), (3.0, 6.0), (6.0, 6.0), (6.0, 3.0)]], True, [81], [9]),
    "closed": ([[*SQUARE, SQUARE[0]]], True, [81], []),
    "clockwise": ([SQUARE[::-1]], True, [81], []),
    "hole that crosses the shell": ([SQUARE, [(6.0, 3.0), (12.0, 3.0), (12.0, 6.0), (6.0, 6.0)]], False, [72, 9], []),
    "ring that touches itself": ([[(0.0, 0.0), (8.0, 0.0), (8.0, 8.0), (0.0, 8.0), (0.0, 4.0), (2.0, 6.0), (4.0, 4.0), (2.0, 2.0), (0.0, 4.0)]], False, [64], [8]),
    "two touching holes in one loop": ([[*SQUARE[:3], (0.0, 9.0), (0.0, 5.0), (2.0, 7.0), (4.0, 5.0), (6.0, 7.0), (8.0, 5.0), (6.0, 3.0), (4.0, 5.0), (2.0, 3.0), (0.0, 5.0)]], False, [81], [8, 8]),
    "island in a hole": ([SQUARE, [(1.0, 1.0), (8.0, 1.0), (8.0, 8.0), (1.0, 8.0)], [(3.0, 3.0), (4.0, 4.0), (4.0, 3.0), (3.0, 4.0)]], False, [81, 0.25, 0.25], [49]),
    "twice around": ([SQUARE + SQUARE], False, None, []),
    "no area": ([[(0.0, 0.0), (2.0, 0.0), (1.0, 0.0)]], False, None, []),
    "two points": ([[(0.0, 0.0), (2.0, 1.0)]], False, None, []),
}


def test_repair(spark):
    rows = [(k, ("Polygon", [(0, j, pts) for j, pts in enumerate(c[0])])) for k, c in CASES.items()]
    rows += [("bow", rows[0][1]), (None, rows[0][1])]  # codes may repeat
    rows += [("two valid parts that touch", ("MultiPolygon", [(0, 0, SQUARE), (1, 0, [(9.0, 9.0), (12.0, 9.0), (12.0, 12.0)])]))]
    rows += [("line", ("LineString", [(0, 0, [(0.0, 0.0), (1.0, 1.0)])])), ("point", ("Point", None)), ("none", None), ("empty", ("Polygon", []))]
    df = frame(spark, rows)
    out = Y.repair(df)
    assert out.columns == ["municipio_ibge", "geometry", "valida"]
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r.municipio_ibge].append(r)
    assert sorted(map(str, got)) == sorted(map(str, [*CASES, None, "two valid parts that touch", "empty"]))
    assert len(got["bow"]) == 2 and got["two valid parts that touch"][0].valida and not got["empty"][0].valida
    before = {r.municipio_ibge: r.geometry for r in df.collect()}
    for name, (_, valid, shells, holes) in CASES.items():
        r = got[name][0]
        assert r.valida == valid, name
        if valid or shells is None:
            assert r.geometry == before[name], name
            continue
        parts = as_parts(r.geometry)
        assert sorted(a[0] for a in parts.values()) == pytest.approx(sorted(shells)), name
        assert sorted(-h for a in parts.values() for h in a[1:]) == pytest.approx(sorted(holes)), name
        assert r.geometry.type == ("Polygon" if len(shells) == 1 else "MultiPolygon")
        assert all(ring.pts[0] == ring.pts[-1] for ring in r.geometry.rings)
    again = {r.municipio_ibge: r.valida for r in Y.repair(out.drop("valida").where("municipio_ibge NOT IN ('twice around', 'no area', 'two points', 'empty')")).collect()}
    assert all(again.values())


def test_random_rings_keep_their_even_odd_area(spark):
    r = random.Random(6)
    shapes = {}
    for k in range(40):
        size = r.choice([3, 4, 5, 8, 15, 40])
        shapes[str(k)] = [[(float(r.randint(0, 12)), float(r.randint(0, 12))) for _ in range(size)] for _ in range(r.choice([1, 1, 2]))]
    out = Y.repair(frame(spark, [(k, ("Polygon", [(0, j, pts) for j, pts in enumerate(rings)])) for k, rings in shapes.items()])).collect()
    assert len(out) == 40
    for row in out:
        new = [[(p.x, p.y) for p in ring.pts] for ring in row.geometry.rings]
        for _ in range(150):
            x, y = r.uniform(-1, 13), r.uniform(-1, 13)
            assert odd(new, x, y) == odd(shapes[row.municipio_ibge], x, y), (row.municipio_ibge, x, y)
        if not row.valida and odd(new, 0, 0) is not None:
            seen = collections.Counter()
            for ring in new:
                assert len(set(ring)) == len(ring) - 1  # simple
                seen.update(frozenset(e) for e in zip(ring, ring[1:], strict=False))
            assert set(seen.values()) == {1}


def test_dissolve_equals_flood_fill(spark):
    r = random.Random(9)
    rows, cells = [], collections.defaultdict(set)
    for k in range(3):
        for x in range(9):
            for y in range(9):
                if r.random() < 0.6:
                    cells[str(k)].add((x, y))
                    cuts = r.choice([[0, 1], [0, 0.5, 1], [0, 0.25, 0.5, 1]])
                    for a, b in zip(cuts, cuts[1:], strict=False):
                        pts = [(x, y + a), (x + 1, y + a), (x + 1, y + b), (x, y + b)]
                        rows.append((str(k), ("Polygon", [(0, 0, [(float(u), float(v)) for u, v in (pts if r.random() < 0.5 else pts[::-1])])])))
    for r_ in Y.dissolve(frame(spark, rows), "municipio_ibge").collect():
        own = cells[r_.municipio_ibge]
        parts, todo = 0, set(own)
        while todo:
            parts, front = parts + 1, [todo.pop()]
            while front:
                x, y = front.pop()
                for n in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                    if n in todo:
                        todo.remove(n)
                        front.append(n)
        areas = as_parts(r_.geometry)
        assert len(areas) == parts and all(a[0] > 0 and all(h < 0 for h in a[1:]) for a in areas.values())
        assert sum(sum(a) for a in areas.values()) == pytest.approx(len(own))
        rings = [[(p.x, p.y) for p in ring.pts] for ring in r_.geometry.rings]
        assert all(odd(rings, x + 0.3, y + 0.6) == ((x, y) in own) for x in range(-1, 10) for y in range(-1, 10))


def test_dissolve_of_overlaps_and_holes(spark):
    ring = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    rows = [("over", ("Polygon", [(0, 0, ring(0.0, 0.0, 2.0))])), ("over", ("Polygon", [(0, 0, ring(1.0, 1.0, 2.0))])), ("over", ("Polygon", [(0, 0, ring(0.0, 0.0, 2.0))]))]
    rows += [("fill", ("Polygon", [(0, 0, ring(0.0, 0.0, 9.0)), (0, 1, ring(3.0, 3.0, 3.0))])), ("fill", ("Polygon", [(0, 0, ring(3.0, 3.0, 3.0))]))]
    rows += [("far", ("Polygon", [(0, 0, ring(0.0, 0.0, 1.0))])), ("far", ("Polygon", [(0, 0, ring(5.0, 0.0, 1.0))])), (None, None)]
    got = {r.municipio_ibge: (r.geometry.type, sorted(sum(a) for a in as_parts(r.geometry).values())) for r in Y.dissolve(frame(spark, rows), "municipio_ibge").collect()}
    assert got == {"over": ("Polygon", [7.0]), "fill": ("Polygon", [81.0]), "far": ("MultiPolygon", [1.0, 1.0])}
    assert Y.dissolve(frame(spark, []), "municipio_ibge").count() == 0 and Y.repair(frame(spark, [])).count() == 0


def test_a_unit_of_many_edges_and_a_hot_place(spark):
    n = 100_000
    k = F.col("id")
    circle = spark.range(n).agg(F.array_sort(F.collect_list(F.struct("id", (F.cos(2 * math.pi * k / n) * 10).alias("x"), (F.sin(2 * math.pi * k / n) * 10).alias("y")))).alias("p"))
    units = circle.select(F.lit("1").alias("municipio_ibge"), F.expr("named_struct('type', 'Polygon', 'rings', array(named_struct('part', 0, 'ring', 0, 'pts', transform(p, q -> named_struct('x', q.x, 'y', q.y)))))").alias("geometry"))
    points = spark.range(60_000).select("id", F.when(k % 50 == 0, "2").when(k % 51 == 0, None).otherwise("1").alias("municipio_ibge"), F.when(k % 3 == 0, 9.0).otherwise(k % 211 / 10.0 - 10).alias("latitude"), F.when(k % 3 == 0, 1.0).when(k % 7 == 0, None).otherwise(k % 199 / 10.0 - 10).alias("longitude"))
    rows = P.inside_own_unit(points, units)
    assert rows.count() == 60_000 and rows.columns == ["municipio_ibge", "id", "latitude", "longitude", "dentro"] or set(rows.columns) == {"id", "municipio_ibge", "latitude", "longitude", "dentro"}
    r2 = F.col("latitude") ** 2 + F.col("longitude") ** 2
    want = F.coalesce((F.col("municipio_ibge") == "1") & (r2 < 100), F.lit(False))
    assert rows.where(F.abs(F.coalesce(r2, F.lit(0)) - 100) > 1e-3).where(F.col("dentro") != want).count() == 0
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list(e" not in plan
