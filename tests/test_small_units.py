"""Units of few edges are repaired in their rows, with the geometry that the edge rows give."""

import random

from pyspark.sql import functions as F

from terracover.operators import polygons as Y
from terracover.operators import small_units as S

from .test_polygons import CASES, frame


def units():
    r = random.Random(11)
    rows = [(k, ("Polygon", [(0, j, pts) for j, pts in enumerate(c[0])])) for k, c in CASES.items()] + [("empty", ("Polygon", []))]
    for k in range(60):
        size, far = r.choice([3, 4, 5, 8, 14]), r.choice([0, 1000.25])
        rows.append((str(k), ("Polygon", [(0, j, [(far + r.randint(0, 9) / r.choice([1, 1, 3]), float(r.randint(0, 9))) for _ in range(size)]) for j in range(r.choice([1, 1, 2]))])))
    return rows


def test_small_units_move_nothing_and_equal_the_edge_rows(spark, monkeypatch):
    own = Y.repair(frame(spark, units()))
    assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()
    got = {r.municipio_ibge: (r.valida, r.geometry) for r in own.collect()}
    monkeypatch.setattr(S, "FEW", -1)
    want = {r.municipio_ibge: (r.valida, r.geometry) for r in Y.repair(frame(spark, units())).collect()}
    assert got == want and len(got) == len(units()) and sum(not v for v, _ in got.values()) > 20


def test_units_without_a_number_go_by_edge_rows(spark):
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
    rows = [("a", ("Polygon", [(0, 0, square)])), ("b", ("Polygon", [(0, 0, [*square, (None, 1.0)])])), ("c", ("Polygon", [(0, 0, [*square, (float("nan"), 1.0)])])), ("d", ("Polygon", None))]
    df = frame(spark, rows)
    small = df.select("municipio_ibge", S.is_small(F.col("geometry.rings"), S.edge_list(F.col("geometry.rings"))).alias("s"))
    assert {r.municipio_ibge: r.s for r in small.collect()} == {"a": True, "b": False, "c": False, "d": False}


def test_edges_lie_in_few_cells_and_meet_once(spark):
    square = spark.createDataFrame([(128.0 * x, 128.0 * y, 128.0 * (x + dx), 128.0 * (y + 1 - dx)) for x in range(4) for y in range(4) for dx in (0, 1)], "x1 double, y1 double, x2 double, y2 double")
    cells = square.select(F.size(Y._cells(F.lit(7), 0.5)).alias("n")).collect()
    assert max(r.n for r in cells) <= 4 and sum(r.n for r in cells) <= 3 * len(cells)
    r = random.Random(5)
    rows = [(str(k % 2), k, None, *(float(v) for v in (x, y, x + r.randint(-s, s), y + r.choice([-s, s])))) for k in range(120) for s in [r.choice([1, 2, 3, 8, 40])] for x, y in [(r.randint(-60, 60), r.randint(-60, 60))]]
    df = spark.createDataFrame(rows, "u string, id long, ring struct<part:int,ring:int>, x1 double, y1 double, x2 double, y2 double")
    for reach in (0.0, 0.5):
        pairs = Y.meeting_pairs(df, reach)
        assert pairs._jdf.queryExecution().optimizedPlan().nodeName() == "Project"  # not made distinct afterwards
        got = sorted((p.a.id, p.b.id) for p in pairs.collect())
        box = lambda e: [(min(e[3 + c], e[5 + c]), max(e[3 + c], e[5 + c])) for c in (0, 1)]
        want = [(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and all(max(p[0], q[0]) <= 2 * reach + min(p[1], q[1]) for p, q in zip(box(a), box(b), strict=True))]
        assert got == sorted(want) and len(want) > 50
