"""Geometry expressions: containment, boxes, edges, and Arrow UDFs for WKB and interior points."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import GEOMETRY, POINT


def edges(rings: Column) -> Column:
    """All edges (x1, y1, x2, y2) of all rings; rings may be closed or not."""

    def of_ring(r: Column) -> Column:
        pts = r["pts"]
        after = F.concat(F.slice(pts, 2, F.greatest(F.size(pts) - 1, F.lit(0))), F.slice(pts, 1, 1))
        return F.filter(F.zip_with(pts, after, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2"))), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))

    return F.flatten(F.transform(rings, of_ring))


def _side(e, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])


def _crosses(e, x: Column, y: Column) -> Column:
    # which side of the edge the point is on, without a division
    return ((e["y1"] > y) != (e["y2"] > y)) & ((_side(e, x, y) > 0) == (e["y2"] > e["y1"]))


def _touches(e, x: Column, y: Column) -> Column:
    return (_side(e, x, y) == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))


def crosses(x: Column, y: Column) -> Column:
    """Whether a ray from the point crosses the edge of the row (x1, y1, x2, y2)."""
    return _crosses({c: F.col(c) for c in ("x1", "y1", "x2", "y2")}, x, y)


def touches(x: Column, y: Column) -> Column:
    """Whether the point lies on the edge of the row."""
    return _touches({c: F.col(c) for c in ("x1", "y1", "x2", "y2")}, x, y)


def contains(edge_list: Column, x: Column, y: Column) -> Column:
    """G1: whether (x, y) lies strictly inside, by even-odd crossings; the boundary is outside.

    Holes and further parts need no special care: their edges count like any other.
    """
    inside = F.size(F.filter(edge_list, lambda e: _crosses(e, x, y))) % 2 == 1
    known = x.isNotNull() & y.isNotNull() & edge_list.isNotNull()
    return F.when(known, inside & ~F.exists(edge_list, lambda e: _touches(e, x, y))).otherwise(F.lit(False))


def edge_key(e: Column) -> Column:
    """An edge without direction."""
    return F.array_sort(F.array(F.array(e["x1"], e["y1"]), F.array(e["x2"], e["y2"])))


def _parts(rings) -> dict[int, list[np.ndarray]]:
    parts: dict[int, list[np.ndarray]] = {}
    for r in rings:
        pts = np.array([(p["x"], p["y"]) for p in r["pts"]], float).reshape(-1, 2)
        if len(pts) > 1 and (pts[0] == pts[-1]).all():
            pts = pts[:-1]
        parts.setdefault(r["part"], []).append(pts)
    return parts


def interior_point_of(rings) -> dict | None:
    """The middle of the widest stretch inside, on the scan line nearest mid-height that lies half way between two vertex heights and meets the shape."""
    ends = [np.hstack((p, np.roll(p, -1, axis=0))) for own in _parts(rings).values() for p in own if len(p) > 2]
    if not ends:
        return None
    e = np.vstack(ends)
    levels = np.unique(e[:, 1])
    if len(levels) < 2:
        return None
    between = (levels[:-1] + levels[1:]) / 2
    for y in between[np.argsort(np.abs(between - (levels[0] + levels[-1]) / 2), kind="stable")]:
        cut = e[(e[:, 1] > y) != (e[:, 3] > y)]
        if len(cut):
            xs = np.sort(cut[:, 0] + (y - cut[:, 1]) * (cut[:, 2] - cut[:, 0]) / (cut[:, 3] - cut[:, 1]))
            spans = xs.reshape(-1, 2)
            best = spans[np.argmax(spans[:, 1] - spans[:, 0])]
            return {"x": float(best.mean()), "y": float(y)}
    return None


@F.pandas_udf(POINT)
def interior_point(rings: pd.Series) -> pd.DataFrame:
    points = [interior_point_of(r) if r is not None else None for r in rings]
    return pd.DataFrame({k: [p[k] if p else None for p in points] for k in ("x", "y")}, columns=["x", "y"])


def turn(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cross products of plane vectors."""
    return u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]


def crosses_itself(rings) -> bool:
    """Whether two edges of a ring cross in their interiors."""
    for own in _parts(rings).values():
        for p in own:
            a, b = p, np.roll(p, -1, axis=0)
            d = b - a
            for i in range(len(p)):
                r = np.delete(np.arange(len(p)), [i, (i + 1) % len(p), (i - 1) % len(p)])
                s = turn(d[i], a[r] - a[i]) * turn(d[i], b[r] - a[i])
                t = turn(d[r], a[i] - a[r]) * turn(d[r], b[i] - a[r])
                if ((s < 0) & (t < 0)).any():
                    return True
    return False


@F.pandas_udf(T.BooleanType())
def is_valid(rings: pd.Series) -> pd.Series:
    return pd.Series([r is not None and len(r) > 0 and not crosses_itself(r) for r in rings])


def to_wkb_bytes(geometry) -> bytes:
    """Little-endian well-known binary of a polygon or multi-polygon."""
    parts: dict[int, list] = {}
    for r in geometry["rings"]:
        parts.setdefault(r["part"], []).append(r["pts"])

    def polygon(rings) -> bytes:
        out = struct.pack("<BII", 1, 3, len(rings))
        for pts in rings:
            out += struct.pack("<I", len(pts)) + b"".join(struct.pack("<dd", p["x"], p["y"]) for p in pts)
        return out

    if geometry["type"] == "Polygon":
        return polygon(next(iter(parts.values())))
    return struct.pack("<BII", 1, 6, len(parts)) + b"".join(map(polygon, parts.values()))


def from_wkb_bytes(blob: bytes) -> dict:
    at = 0

    def read(fmt: str):
        nonlocal at
        out = struct.unpack_from(fmt, blob, at)
        at += struct.calcsize(fmt)
        return out

    def polygon(part: int) -> list[dict]:
        order = "<" if read("B")[0] else ">"
        kind, n = read(order + "II")
        if kind != 3:
            raise ValueError(f"geometry type {kind} is not a polygon")
        rings = []
        for k in range(n):
            (m,) = read(order + "I")
            values = read(f"{order}{2 * m}d")
            rings.append({"part": part, "ring": k, "pts": [{"x": values[2 * j], "y": values[2 * j + 1]} for j in range(m)]})
        return rings

    order = "<" if blob[0] else ">"
    kind = struct.unpack_from(order + "I", blob, 1)[0]
    if kind == 3:
        return {"type": "Polygon", "rings": polygon(0)}
    if kind != 6:
        raise ValueError(f"geometry type {kind} is neither polygon nor multi-polygon")
    at = 5
    (n,) = read(order + "I")
    return {"type": "MultiPolygon", "rings": [r for k in range(n) for r in polygon(k)]}


@F.pandas_udf(T.BinaryType())
def to_wkb(geometry: pd.DataFrame) -> pd.Series:
    return pd.Series([None if g["type"] is None else to_wkb_bytes(g) for g in geometry.to_dict("records")])


@F.pandas_udf(GEOMETRY)
def from_wkb(blobs: pd.Series) -> pd.DataFrame:
    rows = [{"type": None, "rings": None} if b is None else from_wkb_bytes(bytes(b)) for b in blobs]
    return pd.DataFrame(rows, columns=["type", "rings"])
