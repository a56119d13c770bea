"""Placing points: own-polygon check, fallback, fan-out and boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.geometry import crosses, edge_key, edges, interior_point, touches
from ..functions.text import lookup
from .numbering import numbered
from .polygons import in_slabs, slab_of, slab_stats

CODE = "municipio_ibge"


def unit_edges(units: DataFrame, code: str = CODE) -> DataFrame:
    """The edges of every unit, a row each: code, x1, y1, x2, y2."""
    return units.select(code, F.explode(edges(F.col("geometry.rings"))).alias("e")).select(code, "e.*")


def inside_own_unit(points: DataFrame, units: DataFrame, lat: str = "latitude", lon: str = "longitude", flag: str = "dentro", code: str = CODE) -> DataFrame:
    """Whether a point lies strictly inside the polygon of its own code; the boundary is outside.

    Only the own polygon decides, so no spatial join is needed. Edges are dealt to slabs of latitude, and a place (code,
    lat, lon; once, however many points it has) meets the edges of its own slab only, by an equi-join on (code, slab)
    behind a box test; crossings are summed up as they are found. Holes and further parts need no special care: their
    edges count like any other. Edges of repeated codes count together.
    """
    rows = unit_edges(units.where(F.col("geometry.rings").isNotNull()), code)
    stats = slab_stats(rows, code)
    x, y = F.col("_x"), F.col("_y")
    places = points.select(code, F.col(lon).cast("double").alias("_x"), F.col(lat).cast("double").alias("_y")).dropna().distinct()
    asked = places.join(stats, code).where(x.between(F.col("_west"), F.col("_east")) & y.between(F.col("_south"), F.col("_north"))).select(code, "_x", "_y", slab_of(y).alias("slab"))
    met = asked.join(in_slabs(rows, stats, code), [code, "slab"])
    found = met.groupBy(code, "_x", "_y").agg(F.count_if(crosses(x, y)).alias("_n"), F.max(touches(x, y)).alias("_on")).where("_n % 2 = 1 AND NOT _on")
    own = found.select(F.col(code).alias("_c"), "_x", "_y", F.lit(True).alias("_in"))
    joined = points.join(own, (F.col(code) == F.col("_c")) & (F.col(lon).cast("double") == x) & (F.col(lat).cast("double") == y), "left")
    return joined.withColumn(flag, F.coalesce("_in", F.lit(False))).drop("_c", "_x", "_y", "_in")


def representative_points(units: DataFrame) -> DataFrame:
    """A point inside every unit."""
    return units.select(CODE, interior_point(F.col("geometry.rings")).alias("_inside"))


def place(points: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points outside their unit fall back to the unit's own point; those without a unit go.

    Returns the placed points, and one row counting the dropped by cause (null code, unknown code).
    """
    checked = inside_own_unit(points, units)
    spots = representative_points(units).dropDuplicates([CODE])
    joined = checked.join(spots, CODE, "left")
    ok = F.col("dentro")
    placed = joined.withColumns({
        "precisao": F.when(ok, F.col("precisao")).when(F.col("_inside").isNotNull(), F.lit(tables.UNIT)).otherwise(""),
        "latitude": F.when(ok, F.col("latitude")).otherwise(F.col("_inside.y")),
        "longitude": F.when(ok, F.col("longitude")).otherwise(F.col("_inside.x")),
    })
    lost = placed.where(F.col("latitude").isNull())
    causes = lost.agg(F.count_if(F.col(CODE).isNull()).alias("null_code"), F.count_if(F.col(CODE).isNotNull()).alias("unknown_code"))
    return placed.where(F.col("latitude").isNotNull()).drop("dentro", "_inside"), causes


def fan_out(points: DataFrame, radius: Column | None = None, lat: str = "latitude", lon: str = "longitude", order: str = "_rid") -> DataFrame:
    """Points of one coordinate spread on a sunflower around the first, which stays.

    Adds lat_nova and lon_nova. The angle is rank times the golden angle; the distance grows with the
    square root of the rank up to the radius of the point's precision.
    """
    radius = F.coalesce(lookup(F.col("precisao"), tables.FAN_OUT_METRES), F.lit(0.0)) if radius is None else radius
    rows = numbered(points, [order], [lat, lon], "_i", "_n")  # a hot coordinate is spread over many tasks
    distance = radius * F.sqrt(F.col("_i") / F.greatest(F.col("_n") - 1, F.lit(1)))
    angle = F.col("_i") * F.lit(math.pi * (3 - math.sqrt(5)))
    dlat = distance * F.sin(angle) / tables.METRES_PER_DEGREE
    dlon = distance * F.cos(angle) / (tables.METRES_PER_DEGREE * F.cos(F.radians(lat)))
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull() & (F.col("_n") > 1)
    return rows.withColumns({"lat_nova": F.when(known, F.col(lat) + dlat).otherwise(F.col(lat)), "lon_nova": F.when(known, F.col(lon) + dlon).otherwise(F.col(lon))}).drop("_i", "_n")


def revert_outside(points: DataFrame, units: DataFrame) -> DataFrame:
    """The spread coordinate stays where it is still inside the own unit, else the old one returns."""
    checked = inside_own_unit(points, units, "lat_nova", "lon_nova", "_still")
    return checked.withColumns({"latitude": F.when(F.col("_still"), F.col("lat_nova")).otherwise(F.col("latitude")), "longitude": F.when(F.col("_still"), F.col("lon_nova")).otherwise(F.col("longitude"))}).drop("lat_nova", "lon_nova", "_still")


def bounds(units: DataFrame, key: str, whole: str = "todos") -> DataFrame:
    """Box of every key and of all together, in one pass."""
    e = units.select(key, F.explode(edges(F.col("geometry.rings"))).alias("e")).select(key, "e.x1", "e.y1")
    return bounds_of(e, key, "x1", "y1", whole)


def bounds_of(points: DataFrame, key: str, x: str, y: str, whole: str = "todos") -> DataFrame:
    sets = points.rollup(key).agg(F.min(y).alias("south"), F.min(x).alias("west"), F.max(y).alias("north"), F.max(x).alias("east"), F.grouping(key).alias("_g"))
    return sets.withColumn(key, F.when(F.col("_g") == 1, F.lit(whole)).otherwise(F.col(key).cast("string"))).drop("_g")


def zoom_of(south: Column, west: Column, north: Column, east: Column, width: int = 1100, height: int = 700, tile: int = 256, least: int = 2, most: int = 12, floor: float = 0.05) -> Column:
    """E27 as an expression."""
    wide = F.greatest(F.abs(east - west), F.lit(floor))
    middle = F.radians(F.least(F.greatest((south + north) / 2, F.lit(-85.0)), F.lit(85.0)))
    high = F.greatest(F.abs(north - south) / F.cos(middle), F.lit(floor))
    levels = F.sequence(F.lit(least), F.lit(most))
    fits = F.filter(levels, lambda z: (wide * tile * F.pow(F.lit(2.0), z) / 360 <= width) & (high * tile * F.pow(F.lit(2.0), z) / 360 <= height))
    return F.coalesce(F.array_max(fits), F.lit(least))


def dissolve_edges(units: DataFrame, key: str = "uf") -> DataFrame:
    """Outer boundary edges of each key: an edge that two of its units share is inside."""
    e = units.select(key, F.explode(edges(F.col("geometry.rings"))).alias("e"))
    return e.groupBy(key, edge_key(F.col("e")).alias("edge")).agg(F.count("*").alias("n")).where("n = 1").drop("n")
