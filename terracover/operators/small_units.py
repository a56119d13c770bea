"""Repair of units of few edges (G3): the steps of polygons.py, by arrays over the units of an Arrow batch.

A unit of at most FEW edges is small enough to be noded and rebuilt where its row lies, so nothing of it is shuffled. Steps,
lattice, tests and order of parts are those of polygons.py, which takes the other units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.geometry import edges
from ..schema import GEOMETRY

#: Edges of a unit that is repaired in its row; its pieces are fewer than FEW ** 2 + FEW.
FEW = 32
#: Pairs of edges that are compared at once.
PAIRS = 500_000
GRID = 24
PASSES = 40


def edge_list(rings: Column) -> Column:
    """The edges of all rings, with part and ring."""
    own = lambda r: F.transform(edges(F.array(r)), lambda e: F.struct(r["part"].alias("part"), r["ring"].alias("ring"), *(e[c].alias(c) for c in ("x1", "y1", "x2", "y2"))))
    return F.coalesce(F.flatten(F.transform(rings, own)), F.array().cast("array<struct<part:int,ring:int,x1:double,y1:double,x2:double,y2:double>>"))


def is_small(rings: Column, e: Column) -> Column:
    """Whether a unit has few edges, with a number for every coordinate."""
    plain = lambda r: r["pts"].isNotNull() & F.forall(r["pts"], lambda p: (F.abs(p["x"]) < 1e150) & (F.abs(p["y"]) < 1e150))
    return F.coalesce((F.size(e) <= FEW) & F.forall(rings, plain), F.lit(False))


def _pairs(u: np.ndarray, once: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of the edges of one unit, i < j or all but i = j; u ascends."""
    ends = np.searchsorted(u, u, side="right")
    starts = np.arange(1, len(u) + 1) if once else np.searchsorted(u, u)
    lens = ends - starts
    total = np.concatenate(([0], np.cumsum(lens)))
    at = 0
    while at < len(u):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, side="right")) - 1)
        i = np.repeat(np.arange(at, to), lens[at:to])
        j = np.repeat(starts[at:to] - (total[at:to] - total[at]), lens[at:to]) + np.arange(len(i))
        yield (i, j) if once else (i[i != j], j[i != j])
        at = to


def _side(a: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (a[:, 2] - a[:, 0]) * (y - a[:, 1]) - (x - a[:, 0]) * (a[:, 3] - a[:, 1])


def _nearest(x: np.ndarray) -> np.ndarray:
    low = np.floor(np.abs(x))
    return np.copysign(low + (np.abs(x) - low >= 0.5), x) + 0.0


def _meetings(u: np.ndarray, e: np.ndarray, ring: np.ndarray | None, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edge, point and whether it is wrong, of the points at which an edge has to be split: polygons.meetings()."""
    found = [(np.zeros(0, np.int64), np.zeros((0, 2)), np.zeros(0, bool))]
    low, high = np.minimum(e[:, :2], e[:, 2:]), np.maximum(e[:, :2], e[:, 2:])
    for i, j in _pairs(u, True):
        near = (np.maximum(low[i], low[j]) <= 2 * reach + np.minimum(high[i], high[j])).all(axis=1)
        i, j = i[near], j[near]
        a, b = e[i], e[j]
        s = [_side(a, b[:, 0], b[:, 1]), _side(a, b[:, 2], b[:, 3])]
        t = [_side(b, a[:, 0], a[:, 1]), _side(b, a[:, 2], a[:, 3])]
        cross = (s[0] != 0) & (s[1] != 0) & (t[0] != 0) & (t[1] != 0) & ((s[0] > 0) != (s[1] > 0)) & ((t[0] > 0) != (t[1] > 0))
        wrong = (s[0] == 0) & (s[1] == 0) | (ring is None or ring[i] == ring[j])
        at = np.zeros((len(i), 2))
        at[cross] = a[cross, :2] + (a[cross, 2:] - a[cross, :2]) * (t[0][cross] / (t[0][cross] - t[1][cross]))[:, None]
        at = _nearest(at) if reach else at
        for k, own, other, side in ((i, a, b, s), (j, b, a, t)):
            hit = cross & (at != own[:, :2]).any(axis=1) & (at != own[:, 2:]).any(axis=1)
            found.append((k[hit], at[hit], np.ones(hit.sum(), bool)))
            for v, p in zip(side, (other[:, :2], other[:, 2:]), strict=True):
                hit = (np.abs(v) <= reach * np.abs(own[:, 2:] - own[:, :2]).sum(axis=1)) & (p >= low[k] - reach).all(axis=1) & (p <= high[k] + reach).all(axis=1)
                hit &= (p != own[:, :2]).any(axis=1) & (p != own[:, 2:]).any(axis=1)
                found.append((k[hit], p[hit], wrong[hit]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _invalid(n: int, u: np.ndarray, e: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """Which of n units are wrong: edges meet, a ring comes to a corner twice or has under three edges, or there are none."""
    bad = np.bincount(u, minlength=n) == 0
    at, _, wrong = _meetings(u, e, ring, 0.0)
    bad[u[at[wrong]]] = True
    starts, times = np.unique(np.column_stack((u, ring, e[:, :2])), axis=0, return_counts=True)
    bad[starts[times > 1, 0].astype(np.int64)] = True
    rings, times = np.unique(np.column_stack((u, ring)), axis=0, return_counts=True)
    bad[rings[times < 3, 0]] = True
    return bad


def _noded(u: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    done = []
    for _ in range(PASSES):
        at, p, _ = _meetings(u, e, None, 0.5)
        again = np.isin(u, u[at])
        done.append((u[~again], e[~again]))
        if not len(at):
            whole = np.concatenate([x[0] for x in done])
            order = np.argsort(whole, kind="stable")
            return whole[order], np.concatenate([x[1] for x in done])[order]
        t = ((p - e[at, :2]) * (e[at, 2:] - e[at, :2])).sum(axis=1)
        every = np.flatnonzero(again)
        edge, t = np.concatenate((every, at, every)), np.concatenate((np.full(len(every), -np.inf), t, np.full(len(every), np.inf)))
        p = np.concatenate((e[every, :2], p, e[every, 2:]))
        order = np.lexsort((p[:, 1], p[:, 0], t, edge))
        edge, p = edge[order], p[order]
        piece = np.flatnonzero((edge[1:] == edge[:-1]) & (p[1:] != p[:-1]).any(axis=1))
        u, e = u[edge[piece]], np.column_stack((p[piece], p[piece + 1]))
    raise ValueError(f"edges still cross after {PASSES} passes")


def _west(u: np.ndarray, p: np.ndarray, e: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether a ray from p[i] to the west crosses edge j (lower end first)."""
    x, y, a = p[i, 0], p[i, 1], e[j]
    return ((a[:, 1] < y) | (a[:, 1] == y) & (a[:, 0] <= x)) & ~((a[:, 3] < y) | (a[:, 3] == y) & (a[:, 2] <= x)) & (_side(a, x, y) < 0)


def _upward(e: np.ndarray) -> np.ndarray:
    up = (e[:, 1] < e[:, 3]) | (e[:, 1] == e[:, 3]) & (e[:, 0] < e[:, 2])
    return np.where(up[:, None], e, e[:, [2, 3, 0, 1]])


def _boundary(u: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that are there an odd number of times, with the inside on their left."""
    rows, times = np.unique(np.column_stack((u, _upward(e))), axis=0, return_counts=True)
    rows = rows[times % 2 == 1]
    u, e = rows[:, 0].astype(np.int64), rows[:, 1:]
    west = np.zeros(len(u), np.int64)
    middle = (e[:, :2] + e[:, 2:]) / 2
    for i, j in _pairs(u, False):
        west += np.bincount(i[_west(u, middle, e, i, j)], minlength=len(u))
    return u, np.where((west % 2 == 1)[:, None], e, e[:, [2, 3, 0, 1]])


def _successors(u: np.ndarray, e: np.ndarray) -> np.ndarray:
    n = len(u)
    d = e[:, 2:] - e[:, :2]
    angle = np.concatenate((np.arctan2(-d[:, 1] + 0.0, -d[:, 0] + 0.0), np.arctan2(d[:, 1], d[:, 0])))
    vertex = np.column_stack((np.concatenate((u, u)), np.concatenate((e[:, 2:], e[:, :2]))))
    order = np.lexsort((angle, vertex[:, 2], vertex[:, 1], vertex[:, 0]))
    vertex, go = vertex[order], order >= n
    first = np.concatenate(([True], (vertex[1:] != vertex[:-1]).any(axis=1)))
    start = np.flatnonzero(first)
    group = np.cumsum(first) - 1
    last = np.maximum.accumulate(np.where(go, np.arange(2 * n), -1))
    end = np.append(start[1:], 2 * n) - 1
    last = np.where(last >= start[group], last, last[end][group])
    follow = np.zeros(n, np.int64)
    follow[order[~go]] = order[last[~go]] - n
    return follow


def _placed(follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ring of every edge (its least edge) and the edge's place in it: polygons.cycles()."""
    ring, away, ahead, span = np.arange(len(follow)), np.zeros(len(follow), np.int64), follow, 1
    while True:
        closer = ring[ahead] < ring
        if not closer.any():
            size = np.bincount(ring, minlength=len(follow))[ring]
            return ring, (size - away) % size
        ring, away, ahead, span = np.where(closer, ring[ahead], ring), np.where(closer, away[ahead] + span, away), ahead[ahead], 2 * span


def _rings(u: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    follow = _successors(u, e)
    ring, pos = _placed(follow)
    order = np.lexsort((pos, e[:, 1], e[:, 0], ring))
    key = np.column_stack((ring, e[:, :2]))[order]
    first = np.concatenate(([True], (key[1:] != key[:-1]).any(axis=1)))
    start = np.flatnonzero(first)
    end = np.append(start[1:], len(order)) - 1
    if len(start) == len(order):
        return ring, pos
    before = np.where(first, end[np.cumsum(first) - 1], np.arange(len(order)) - 1)
    other = np.zeros(len(order), np.int64)
    other[order] = order[before]
    return _placed(other[follow])


def _mended(n: int, u: np.ndarray, e: np.ndarray) -> list[list[tuple[list, list]] | None]:
    """Shells and their holes of each of n units, as closed lists of points; none of a unit without area."""
    out: list[list | None] = [None] * n
    start = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1]))) if len(u) else np.zeros(0, np.int64)
    if not len(start):
        return out
    high = np.maximum.reduceat(np.maximum(e[:, :2], e[:, 2:]), start) - np.minimum.reduceat(np.minimum(e[:, :2], e[:, 2:]), start)
    steps = np.zeros(n)
    steps[u[start]] = 2.0 ** (np.ceil(np.log(high.max(axis=1)) / np.log(2)) - GRID)
    on = _nearest(e / steps[u][:, None])
    place = np.column_stack((np.concatenate((u, u)), np.concatenate((on[:, :2], on[:, 2:])), np.concatenate((e[:, :2], e[:, 2:]))))
    known: dict[tuple, tuple] = {}
    for k, x, y, px, py in place.tolist():
        known[k, x, y] = min(known.get((k, x, y), (px, py)), (px, py))
    moved = (on[:, :2] != on[:, 2:]).any(axis=1)
    u, e = _boundary(*_noded(u[moved], on[moved]))
    if not len(u):
        return out
    ring, pos = _rings(u, e)
    order = np.lexsort((pos, ring))
    u, e, ring = u[order], e[order], ring[order]
    start = np.flatnonzero(np.concatenate(([True], ring[1:] != ring[:-1])))
    own = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(ring))))
    d, d2 = e[:, :2] - e[start[own], :2], e[:, 2:] - e[start[own], :2]
    area = np.add.reduceat(d[:, 0] * d2[:, 1] - d2[:, 0] * d[:, 1], start) / 2
    points, edge = [], np.append(start, len(ring)).tolist()
    rows = np.column_stack((u, e[:, :2])).tolist()
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        pts = [known.get((k, x, y)) or (x * steps[int(k)], y * steps[int(k)]) for k, x, y in rows[a:b]]
        k = pts.index(min(pts))
        points.append([*pts[k:], *pts[: k + 1]])
    holes: dict[int, list] = {}
    unit, up = u[start], _upward(e)
    for h in np.flatnonzero(area < 0).tolist():
        lo, hi = np.searchsorted(u, unit[h]), np.searchsorted(u, unit[h], side="right")
        j = np.arange(lo, hi)
        j = j[area[own[lo:hi]] > 0]
        middle = (e[start[h], :2] + e[start[h], 2:])[None] / 2
        met = np.bincount(own[j[_west(u, middle, up, np.zeros(len(j), np.int64), j)]], minlength=0)
        around = np.flatnonzero(met % 2 == 1)
        if len(around):
            holes.setdefault(int(around[np.argmin(area[around])]), []).append(points[h])
    for s in np.flatnonzero(area > 0).tolist():
        k = int(unit[s])
        out[k] = [*(out[k] or []), (points[s], sorted(holes.get(s, [])))]
    return [x and sorted(x) for x in out]


def _as_geometry(units: list) -> pa.Array:
    kind, count, part, ring, size, points = [], [], [], [], [], []
    for parts in units:
        kind.append(None if parts is None else "Polygon" if len(parts) == 1 else "MultiPolygon")
        before = len(size)
        for p, (shell, holes) in enumerate(parts or []):
            for r, pts in enumerate((shell, *holes)):
                part.append(p)
                ring.append(r)
                size.append(len(pts))
                points += pts
        count.append(len(size) - before)
    xy = np.array(points, float).reshape(-1, 2)
    ends = lambda n: pa.array(np.concatenate(([0], np.cumsum(np.array(n, np.int64)))), pa.int32())
    pts = pa.ListArray.from_arrays(ends(size), pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], ["x", "y"]))
    rings = pa.ListArray.from_arrays(ends(count), pa.StructArray.from_arrays([pa.array(part, pa.int32()), pa.array(ring, pa.int32()), pts], ["part", "ring", "pts"]))
    return pa.StructArray.from_arrays([pa.array(kind, pa.string()), rings], ["type", "rings"], mask=pa.array([x is None for x in units], pa.bool_()))


def mend_units(found: pa.Array) -> pa.Array:
    """(bad, geometry): whether a unit of these edges is invalid, and what it becomes."""
    n = len(found)
    u = np.repeat(np.arange(n), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = found.flatten()
    part, ring = (flat.field(c).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("part", "ring"))
    e = np.column_stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("x1", "y1", "x2", "y2")]).reshape(-1, 4) + 0.0
    bad = _invalid(n, u, e, (part << 32) + ring)
    own = bad[u]
    return pa.StructArray.from_arrays([pa.array(bad), _as_geometry(_mended(n, u[own], e[own]))], ["bad", "geometry"])


def mend(e: Column) -> Column:
    return F.arrow_udf(mend_units, f"struct<bad:boolean,geometry:{GEOMETRY if isinstance(GEOMETRY, str) else GEOMETRY.simpleString()}>")(e)
