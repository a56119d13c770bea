"""Polygons rebuilt from their edges: repair and dissolve (G3, G4, A16), and ray counts by slabs.

Both operators work on edge rows, so a unit of any number of edges is spread over many tasks:

  1. node: corners are rounded to a lattice of 2**GRID steps over the unit's extent (6 mm of 100 km), so that every test
     of sides is exact. Edges that may meet are found by an equi-join on cells of a grid by size class (an edge
     lies in a few cells of its class and asks the cells of the larger classes), and are split at lattice points where
     they cross, overlap or pass a corner by less than half a step, until none do;
  2. depth: equal edges are summed up; what lies west of an edge is the sum of the edges that a ray from its middle
     crosses, found in the slab of its height. Edges with inside on one side only are the boundary,
     directed with the inside on their left;
  3. rings: around each vertex the edge that follows an incoming one is the next outgoing one clockwise; pointer
     doubling joins give every edge its ring and its place in it, in log2(longest ring) steps. A ring that meets itself
     at a vertex is taken apart there;
  4. polygons: a ring that turns left is a shell, others are holes of the smallest shell around them.

Corners of the result that a source has keep its coordinates. A unit's finished rings become one row, as the geometry
type is one; nothing else is gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import edges
from ..sources.files import discard, stored
from . import small_units

GRID = 24
#: Passes of noding; each but the first finds what the rounding of the last has made, and few are needed.
PASSES = 40


# ---------------------------------------------------------------- slabs


def slab_stats(rows: DataFrame, unit: str, crossed: int = 4) -> DataFrame:
    """Box and slabs of every unit: so many that all edges together reach into about 1 + crossed slabs an edge."""
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    stats = rows.groupBy(unit).agg(F.min(F.least("x1", "x2")).alias("_west"), F.max(F.greatest("x1", "x2")).alias("_east"), F.min(low).alias("_south"), F.max(high).alias("_north"), F.count("*").alias("_n"), F.sum(high - low).alias("_rise"))
    slabs = F.when(F.col("_rise") > 0, F.greatest(F.lit(1), F.floor(crossed * F.col("_n") * (F.col("_north") - F.col("_south")) / F.col("_rise")))).otherwise(F.lit(1))
    return stats.withColumn("_slabs", slabs.cast("long")).drop("_n", "_rise")


def slab_of(y: Column) -> Column:
    """The slab of a height, from the columns of slab_stats."""
    share = (y - F.col("_south")) / (F.col("_north") - F.col("_south"))
    return F.when(F.col("_slabs") == 1, F.lit(0)).otherwise(F.least(F.col("_slabs") - 1, F.floor(share * F.col("_slabs")))).cast("long")


def in_slabs(rows: DataFrame, stats: DataFrame, unit: str) -> DataFrame:
    """A row for each slab that an edge reaches into."""
    placed = rows.join(stats, unit)
    return placed.withColumn("slab", F.explode(F.sequence(slab_of(F.least("y1", "y2")), slab_of(F.greatest("y1", "y2"))))).drop("_west", "_east", "_south", "_north", "_slabs")


# ---------------------------------------------------------------- noding


def _box(rows: DataFrame) -> DataFrame:
    size = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))
    return rows.withColumn("_level", F.ceil(F.log2(size)).cast("int"))


def _span(a: Column, b: Column, level: Column, reach: float) -> tuple[Column, Column]:
    """First and last cell of a size class that an edge, widened by reach, meets in one direction. A cell is twice as long as its edges."""
    step = F.pow(F.lit(2.0), level + 1)
    return F.floor((F.least(a, b) - reach) / step).cast("long"), F.floor((F.greatest(a, b) + reach) / step).cast("long")


def _cells(level: Column, reach: float) -> Column:
    """The cells of a size class that the box of an edge, widened by reach, meets."""
    across, up = (F.sequence(*_span(F.col(a), F.col(b), level, reach)) for a, b in (("x1", "x2"), ("y1", "y2")))
    return F.flatten(F.transform(across, lambda i: F.transform(up, lambda j: F.struct(level.alias("level"), i.alias("i"), j.alias("j")))))


def meeting_pairs(rows: DataFrame, reach: float) -> DataFrame:
    """Pairs of edges of a unit whose boxes meet, once each: u, a and b (structs of id, ring, x1, y1, x2, y2), a.id < b.id.

    Of the cells that two edges share, the first in both directions counts, so that no pair is put out twice.
    """
    sized = _box(rows)
    levels = sized.groupBy("u").agg(F.collect_set("_level").alias("_levels"))  # at most the exponents of a double
    whole = F.struct("id", "ring", "x1", "y1", "x2", "y2")
    home = sized.select("u", F.explode(_cells(F.col("_level"), reach)).alias("cell"), whole.alias("e"))
    asks = sized.join(levels, "u").withColumn("_at", F.explode(F.filter("_levels", lambda k: k >= F.col("_level"))))
    asks = asks.select("u", F.explode(_cells(F.col("_at"), reach)).alias("cell"), whole.alias("f"), (F.col("_at") == F.col("_level")).alias("_same"))
    met = home.join(asks, ["u", "cell"]).where("e.id < f.id OR NOT _same")  # edges of one class ask each other
    apart = "greatest(least(e.{c}1, e.{c}2), least(f.{c}1, f.{c}2)) <= {r} + least(greatest(e.{c}1, e.{c}2), greatest(f.{c}1, f.{c}2))"
    met = met.where(" AND ".join(apart.format(c=c, r=2 * reach) for c in "xy"))
    for k, c in (("i", "x"), ("j", "y")):
        starts = [_span(F.col(f"{e}.{c}1"), F.col(f"{e}.{c}2"), F.col("cell.level"), reach)[0] for e in "ef"]
        met = met.where(F.col(f"cell.{k}") == F.greatest(*starts))
    first = F.col("e.id") < F.col("f.id")
    return met.select("u", F.when(first, F.col("e")).otherwise(F.col("f")).alias("a"), F.when(first, F.col("f")).otherwise(F.col("e")).alias("b"))


def _side(e: str, x: str, y: str) -> str:
    return f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({x} - {e}.x1) * ({e}.y2 - {e}.y1))"


def _no_end(e: str, x: str, y: str) -> str:
    return f"NOT ({x} = {e}.x1 AND {y} = {e}.y1) AND NOT ({x} = {e}.x2 AND {y} = {e}.y2)"


def _on(e: str, s: str, x: str, y: str, reach: float) -> str:
    """Whether e passes a point of side s by no more than reach in x and y, away from its own ends."""
    box = " AND ".join(f"{v} BETWEEN least({e}.{c}1, {e}.{c}2) - {reach} AND greatest({e}.{c}1, {e}.{c}2) + {reach}" for v, c in ((x, "x"), (y, "y")))
    return f"(abs({s}) <= {reach} * (abs({e}.x2 - {e}.x1) + abs({e}.y2 - {e}.y1)) AND {box} AND {_no_end(e, x, y)})"


def meetings(rows: DataFrame, lattice: bool) -> DataFrame:
    """Points at which an edge has to be split: u, id, x, y, and whether that makes its unit invalid (wrong).

    On the lattice, crossings are rounded and a corner counts as on an edge that passes it by half a step.
    """
    reach = 0.5 if lattice else 0.0
    pairs = meeting_pairs(rows, reach).withColumns({"s1": F.expr(_side("a", "b.x1", "b.y1")), "s2": F.expr(_side("a", "b.x2", "b.y2")), "t1": F.expr(_side("b", "a.x1", "a.y1")), "t2": F.expr(_side("b", "a.x2", "a.y2"))})
    cross = "s1 <> 0 AND s2 <> 0 AND t1 <> 0 AND t2 <> 0 AND (s1 > 0) <> (s2 > 0) AND (t1 > 0) <> (t2 > 0)"
    # a shared stretch is wrong, and so is a touch within one ring; two rings may touch at a point
    wrong = "(s1 = 0 AND s2 = 0) OR a.ring <=> b.ring"
    nearest = "round({})" if lattice else "{}"
    pairs = pairs.withColumn("c", F.expr(f"CASE WHEN {cross} THEN struct({', '.join(nearest.format(f'a.{c}1 + (a.{c}2 - a.{c}1) * (t1 / (t1 - t2))') + f' AS {c}' for c in 'xy')}) END"))
    cuts = []
    for e, f, s in (("a", "b", "s"), ("b", "a", "t")):
        cuts.append(f"CASE WHEN c IS NOT NULL AND {_no_end(e, 'c.x', 'c.y')} THEN struct({e}.id AS id, c.x AS x, c.y AS y, true AS wrong) END")
        for k in (1, 2):
            x, y = f"{f}.x{k}", f"{f}.y{k}"
            cuts.append(f"CASE WHEN {_on(e, f'{s}{k}', x, y, reach)} THEN struct({e}.id AS id, {x} AS x, {y} AS y, ({wrong}) AS wrong) END")
    return pairs.select("u", F.explode(F.expr(f"filter(array({', '.join(cuts)}), p -> p IS NOT NULL)")).alias("p")).select("u", "p.*")


def split(rows: DataFrame, points: DataFrame) -> DataFrame:
    """rows (u, id, ring, x1, y1, x2, y2) cut at points (id, x, y); the pieces keep direction and get new ids."""
    cuts = points.join(rows.select("id", "x1", "y1", "x2", "y2"), "id").select("id", F.struct(((F.col("x") - F.col("x1")) * (F.col("x2") - F.col("x1")) + (F.col("y") - F.col("y1")) * (F.col("y2") - F.col("y1"))).alias("t"), "x", "y").alias("p"))
    cuts = cuts.groupBy("id").agg(F.array_sort(F.collect_set("p")).alias("_p"))
    own = rows.join(cuts, "id", "left")
    ends = [F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (1, 2)]
    middle = F.coalesce(F.transform("_p", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))), F.array().cast("array<struct<x:double,y:double>>"))
    starts, stops = F.concat(F.array(ends[0]), middle), F.concat(middle, F.array(ends[1]))
    pieces = own.select("u", "ring", F.explode(F.arrays_zip(starts.alias("s"), stops.alias("e"))).alias("z"))
    pieces = pieces.select("u", "ring", F.col("z.s.x").alias("x1"), F.col("z.s.y").alias("y1"), F.col("z.e.x").alias("x2"), F.col("z.e.y").alias("y2"))
    return pieces.where("x1 <> x2 OR y1 <> y2").withColumn("id", F.monotonically_increasing_id())


def node(rows: DataFrame) -> DataFrame:
    """Edges on the lattice that meet at their ends only."""
    for _ in range(PASSES):
        points = stored(meetings(rows, True).select("id", "x", "y").distinct(), "polygon-points")
        done = points.isEmpty()
        before, rows = rows, rows if done else stored(split(rows, points), "polygon-edges")
        discard(points, *([] if done else [before]))
        if done:
            return rows
    raise ValueError(f"edges still cross after {PASSES} passes")


def on_lattice(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (u, x1, y1, x2, y2) with ends on the lattice of their unit and ids, and the corners: u, x, y, and place (x, y as they were)."""
    extent = F.greatest(F.max(F.greatest("x1", "x2")) - F.min(F.least("x1", "x2")), F.max(F.greatest("y1", "y2")) - F.min(F.least("y1", "y2")))
    steps = rows.groupBy("u").agg(F.pow(F.lit(2.0), F.ceil(F.log2(extent)) - GRID).alias("step"))
    steps = stored(steps, "polygon-steps")
    both = rows.join(steps, "u")
    at = [F.round(F.col(c) / F.col("step")).alias(c) for c in ("x1", "y1", "x2", "y2")]
    ring = F.lit(None).cast("struct<part:int,ring:int>").alias("ring")
    moved = both.select("u", ring, *at).where("x1 <> x2 OR y1 <> y2").withColumn("id", F.monotonically_increasing_id())
    ends = both.select("u", F.explode(F.array(*(F.struct(F.round(F.col(f"x{k}") / F.col("step")).alias("x"), F.round(F.col(f"y{k}") / F.col("step")).alias("y"), F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")).alias("place")) for k in (1, 2)))).alias("c"))
    known = ends.select("u", "c.*").groupBy("u", "x", "y").agg(F.min("place").alias("place"))
    return stored(moved, "polygon-edges"), stored(known.join(steps, "u"), "polygon-corners")


# ---------------------------------------------------------------- depth and boundary


def _summed(rows: DataFrame, odd: bool) -> DataFrame:
    """Equal edges once, from their lower end (by y, x) to the upper, with their weight towards the east; weightless ones go."""
    up = F.expr("y1 < y2 OR y1 = y2 AND x1 < x2")
    ends = [F.when(up, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("x1", "x2", "lx"), ("y1", "y2", "ly"), ("x2", "x1", "hx"), ("y2", "y1", "hy"))]
    weight = F.count("*") % 2 if odd else F.sum(F.when(F.col("up"), -1).otherwise(1))
    rows = rows.select("u", *ends, up.alias("up")).groupBy("u", "lx", "ly", "hx", "hy").agg(weight.cast("long").alias("weight")).where("weight <> 0")
    return rows.selectExpr("u", "lx AS x1", "ly AS y1", "hx AS x2", "hy AS y2", "weight")


def west_of(probes: DataFrame, rows: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """For probes (u, id, x, y): the sum of value over the edges (x1, y1 the lower end) that a ray to the west crosses, by keys.

    Heights are compared with x as the tie, as if the plane were turned a little, so level edges need no care.
    """
    stats = stored(slab_stats(rows, "u", 1), "polygon-slabs")
    asked = probes.join(stats, "u").where("y BETWEEN _south AND _north").withColumn("slab", slab_of(F.col("y"))).select("u", "slab", F.col("id").alias("_id"), "x", "y")
    met = asked.join(in_slabs(rows, stats, "u"), ["u", "slab"]).where("_id <> id")
    met = met.where("(y1 < y OR y1 = y AND x1 <= x) AND NOT (y2 < y OR y2 = y AND x2 <= x) AND (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1) < 0")
    out = stored(met.groupBy(F.col("_id").alias("id"), *keys).agg(F.sum(value).alias("west")), "polygon-west")
    discard(stats)
    return out


def boundary(rows: DataFrame, odd: bool) -> DataFrame:
    """Noded edges with inside on one side only, directed with the inside on the left: u, id, x1, y1, x2, y2.

    Inside is where the depth is odd, or above zero (the depth counts how often directed rings run around).
    """
    sums = stored(_summed(rows, odd).withColumn("id", F.monotonically_increasing_id()), "polygon-sums")
    middle = sums.select("u", "id", ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    depth = west_of(middle, sums, [], F.col("weight"))
    inside = (lambda v: v % 2 != 0) if odd else (lambda v: v > 0)
    west = F.coalesce("west", F.lit(0))
    sides = sums.join(depth, "id", "left").withColumns({"_w": inside(west), "_e": inside(west + F.col("weight"))}).where("_w <> _e")
    flip = [F.when(F.col("_w"), F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("x1", "x2", "x1"), ("y1", "y2", "y1"), ("x2", "x1", "x2"), ("y2", "y1", "y2"))]
    out = stored(sides.select("u", "id", *flip), "polygon-boundary")
    discard(sums, depth)
    return out


# ---------------------------------------------------------------- rings


def successors(rows: DataFrame) -> DataFrame:
    """(id, next): the edge that follows each one around the same piece of inside."""
    turn = lambda a, b: F.atan2(F.col(f"y{b}") - F.col(f"y{a}"), F.col(f"x{b}") - F.col(f"x{a}"))
    come = rows.select("u", F.col("x2").alias("x"), F.col("y2").alias("y"), turn(2, 1).alias("angle"), F.col("id").alias("come"), F.lit(None).cast("long").alias("go"))
    go = rows.select("u", F.col("x1").alias("x"), F.col("y1").alias("y"), turn(1, 2).alias("angle"), F.lit(None).cast("long").alias("come"), F.col("id").alias("go"))
    around = W.partitionBy("u", "x", "y").orderBy("angle")  # the few edges of one vertex
    before = F.last("go", ignorenulls=True).over(around.rowsBetween(W.unboundedPreceding, 0))
    last = F.last("go", ignorenulls=True).over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return come.union(go).withColumn("next", F.coalesce(before, last)).where("come IS NOT NULL").select(F.col("come").alias("id"), "next")


def cycles(follow: DataFrame) -> DataFrame:
    """(id, ring, away): the least id of the cycle that each id is in, and how many steps away it is.

    follow: id, next, a permutation. Windows of the cycles are doubled until no least id changes.
    """
    known, span = stored(follow.select("id", "next", F.col("id").alias("ring"), F.lit(0).cast("long").alias("away")), "polygon-cycles"), 1
    while True:
        ahead = known.select(F.col("id").alias("next"), F.col("next").alias("_next"), F.col("ring").alias("_ring"), F.col("away").alias("_away"))
        closer = F.col("_ring") < F.col("ring")
        doubled = known.join(ahead, "next").select("id", F.col("_next").alias("next"), F.least("ring", "_ring").alias("ring"), F.when(closer, F.col("_away") + span).otherwise(F.col("away")).alias("away"), closer.alias("_new"))
        before, known, span = known, stored(doubled, "polygon-cycles"), 2 * span
        discard(before)
        if known.where("_new").isEmpty():
            return known.select("id", "ring", "away")


def rings(rows: DataFrame) -> DataFrame:
    """The boundary edges with ring and pos, their place in it."""
    follow = stored(successors(rows), "polygon-next")
    placed = stored(_placed(rows, follow), "polygon-rings")
    visits = placed.groupBy("ring", "x1", "y1").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("v")).where("size(v) > 1")
    visits = stored(visits, "polygon-visits")
    if visits.isEmpty():
        return placed
    # the edge that comes before the k-th visit of a vertex is followed by the edge of the visit before
    moved = visits.select(F.explode(F.transform("v", lambda p, k: F.struct(p["id"].alias("next"), F.element_at("v", F.when(k == 0, F.size("v")).otherwise(k).cast("int"))["id"].alias("other")))).alias("m")).select("m.*")
    again = stored(follow.join(moved, "next", "left").select("id", F.coalesce("other", "next").alias("next")), "polygon-next")
    discard(follow, placed, visits)
    return stored(_placed(rows, again), "polygon-rings")


def _placed(rows: DataFrame, follow: DataFrame) -> DataFrame:
    known = rows.join(cycles(follow), "id")
    sizes = known.groupBy("ring").agg(F.count("*").alias("_n"))
    return known.join(sizes, "ring").withColumn("pos", (F.col("_n") - F.col("away")) % F.col("_n")).drop("_n", "away")


def assemble(placed: DataFrame, corners: DataFrame) -> DataFrame:
    """(u, geometry): shells with their holes, closed and started at their least vertex, in the order of those."""
    steps = corners.select("u", "step").distinct()
    known = corners.select("u", F.col("x").alias("x1"), F.col("y").alias("y1"), "place")
    own = F.struct((F.col("x1") * F.col("step")).alias("x"), (F.col("y1") * F.col("step")).alias("y"))
    shown = placed.join(steps, "u").join(known, ["u", "x1", "y1"], "left").withColumn("place", F.coalesce("place", own))
    anchor = placed.where("pos = 0").select("ring", F.col("x1").alias("_x"), F.col("y1").alias("_y"))
    area = F.sum((F.col("x1") - F.col("_x")) * (F.col("y2") - F.col("_y")) - (F.col("x2") - F.col("_x")) * (F.col("y1") - F.col("_y"))) / 2
    points = F.transform(F.array_sort(F.collect_list(F.struct("pos", "place"))), lambda p: p["place"])
    whole = shown.join(anchor, "ring").groupBy("u", "ring").agg(area.alias("area"), points.alias("p"))
    k = F.array_position("p", F.array_min("p")).cast("int")
    turned = F.concat(F.slice("p", k, F.size("p")), F.slice("p", F.lit(1), k))  # closed
    whole = stored(whole.select("u", "ring", "area", turned.alias("pts")), "polygon-whole")
    shells, holes = whole.where("area > 0"), whole.where("area < 0")

    low = F.expr("y1 < y2 OR y1 = y2 AND x1 < x2")
    walls = placed.join(shells.select(F.col("ring"), F.col("area")), "ring")
    walls = walls.select("u", "id", "ring", "area", *(F.when(low, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("x1", "x2", "x1"), ("y1", "y2", "y1"), ("x2", "x1", "x2"), ("y2", "y1", "y2"))))
    probes = placed.where("pos = 0").join(holes.select("ring"), "ring", "left_semi").select("u", F.col("ring").alias("id"), ((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y"))
    around = west_of(probes, walls, ["ring", "area"], F.lit(1)).where("west % 2 = 1")
    inside = around.groupBy(F.col("id").alias("hole")).agg(F.min_by("ring", F.struct("area", "ring")).alias("shell"))
    own = holes.join(inside, F.col("ring") == F.col("hole")).groupBy(F.col("shell").alias("ring")).agg(F.array_sort(F.collect_list("pts")).alias("holes"))
    parts = shells.join(own, "ring", "left").select("u", F.struct("pts", F.coalesce("holes", F.array().cast("array<array<struct<x:double,y:double>>>")).alias("holes")).alias("part"))
    parts = parts.groupBy("u").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    ring = lambda part, k, pts: F.struct(part.cast("int").alias("part"), k.cast("int").alias("ring"), pts.alias("pts"))
    listed = F.flatten(F.transform("parts", lambda p, i: F.concat(F.array(ring(i, F.lit(0), p["pts"])), F.transform(p["holes"], lambda h, j: ring(i, j + 1, h)))))
    return parts.select("u", F.struct(F.when(F.size("parts") == 1, "Polygon").otherwise("MultiPolygon").alias("type"), listed.alias("rings")).alias("geometry"))


# ---------------------------------------------------------------- the operators


def _unit_edges(units: DataFrame) -> DataFrame:
    """u, ring, its signed area, and its edges."""
    one = units.select("u", F.explode("geometry.rings").alias("r")).select("u", F.struct("r.part", "r.ring").alias("ring"), edges(F.array("r")).alias("e"))
    turn = F.aggregate("e", F.lit(0.0), lambda s, e: s + (e["x1"] - F.col("e")[0]["x1"]) * (e["y2"] - F.col("e")[0]["y1"]) - (e["x2"] - F.col("e")[0]["x1"]) * (e["y1"] - F.col("e")[0]["y1"]))
    return one.withColumn("turn", turn).select("u", "ring", "turn", F.explode("e").alias("e")).select("u", "ring", "turn", "e.*")


def repair(units: DataFrame, flag: str = "valida") -> DataFrame:
    """Units with polygons only; invalid ones are noded and rebuilt as valid parts, by even-odd depth.

    A unit is invalid if edges cross or overlap, or a ring meets itself. Valid ones stay as they are; an invalid one
    of which no area is left stays too, so that it is seen. flag tells whether the unit came in valid. Units
    without rings are invalid. Codes may repeat: rows are repaired one by one. Units of few edges are repaired in their rows.
    """
    kept = units.where(F.col("geometry.type").isin("Polygon", "MultiPolygon")).withColumn("_e", small_units.edge_list(F.col("geometry.rings")))
    kept = stored(kept.withColumn("_small", small_units.is_small(F.col("geometry.rings"), F.col("_e"))).withColumn("_e", F.when(F.col("_small"), F.col("_e"))), "repair-units")
    few = kept.where("_small").withColumn("_m", small_units.mend(F.col("_e")))
    few = few.withColumns({"geometry": F.coalesce("_m.geometry", "geometry"), flag: ~F.col("_m.bad")}).drop("_e", "_small", "_m")
    many = kept.where("NOT _small").drop("_e", "_small")
    return few if many.isEmpty() else few.unionByName(_repair_by_edges(many, flag))


def _repair_by_edges(units: DataFrame, flag: str) -> DataFrame:
    """repair() of units of any number of edges, by edge rows."""
    kept = stored(units.withColumn("u", F.monotonically_increasing_id()), "repair-units")
    rows = stored(_unit_edges(kept).drop("turn").withColumn("id", F.monotonically_increasing_id()), "repair-edges")
    wrong = meetings(rows, False).where("wrong").select("u").distinct()
    twice = rows.groupBy("u", "ring", "x1", "y1").agg(F.count("*").alias("n")).where("n > 1")
    short = rows.groupBy("u", "ring").agg(F.count("*").alias("n")).where("n < 3")
    empty = kept.join(rows, "u", "left_anti")
    bad = stored(wrong.union(twice.select("u")).union(short.select("u")).union(empty.select("u")).distinct(), "repair-bad")
    if bad.isEmpty():
        return kept.drop("u").withColumn(flag, F.lit(True))
    rows, corners = on_lattice(rows.join(bad, "u", "left_semi"))
    mended = assemble(rings(boundary(node(rows), odd=True)), corners).withColumnRenamed("geometry", "_new")
    out = kept.join(bad.withColumn("_bad", F.lit(True)), "u", "left").join(mended, "u", "left")
    return out.withColumns({"geometry": F.coalesce("_new", "geometry"), flag: F.col("_bad").isNull()}).drop("u", "_new", "_bad")


def dissolve(units: DataFrame, key: str = "uf") -> DataFrame:
    """(key, geometry), the union of the valid polygons of each key, overlaps included.

    Shells are taken counter-clockwise and holes clockwise whatever their order in the source. Borders that two units
    share vanish where they are equal at once, and after noding where a vertex of one lies on an edge of the other.
    Units without rings are left out; a null key is a key.
    """
    rows = _unit_edges(units.select(F.col(key).alias("u"), "geometry")).withColumn("ok", (F.col("ring.ring") == 0) == (F.col("turn") > 0))
    rows = rows.select("u", *(F.when(F.col("ok"), F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("x1", "x2", "x1"), ("y1", "y2", "y1"), ("x2", "x1", "x2"), ("y2", "y1", "y2"))))
    sums = _summed(rows, odd=False)
    # an edge of weight w is w edges, directed up if w < 0
    down = F.col("weight") > 0
    again = sums.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.abs("weight"))))
    again = again.select("u", *(F.when(down, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("x2", "x1", "x1"), ("y2", "y1", "y1"), ("x1", "x2", "x2"), ("y1", "y2", "y2"))))
    rows, corners = on_lattice(again)
    return assemble(rings(boundary(node(rows), odd=False)), corners).withColumnRenamed("u", key)
