"""JSON sources: boundary GeoJSON (S4, S8, S9), unit names (S5), population series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import series_value, zero_fill
from ..schema import POPULATION, UNIT_CODE_COLUMNS, UNIT_NAMES

_FEATURES = "type string, crs struct<properties:struct<name:string>>, features array<struct<properties:map<string,string>, geometry:struct<type:string, coordinates:string>>>"
_KNOWN_CRS = ("EPSG:4326", "urn:ogc:def:crs:OGC:1.3:CRS84", "urn:ogc:def:crs:EPSG::4326", "OGC:CRS84")
_XY = "array<array<double>>"


def rings_of(kind: str, coordinates: str) -> str:
    """SQL: the rings of GeoJSON coordinates held as text, which differ in depth by type."""
    pts = "transform({}, p -> named_struct('x', p[0], 'y', p[1]))"
    one = f"transform(from_json({coordinates}, 'array<{_XY}>'), (r, k) -> named_struct('part', 0, 'ring', k, 'pts', {pts.format('r')}))"
    many = f"flatten(transform(from_json({coordinates}, 'array<array<{_XY}>>'), (q, j) -> transform(q, (r, k) -> named_struct('part', j, 'ring', k, 'pts', {pts.format('r')}))))"
    return f"CASE {kind} WHEN 'Polygon' THEN {one} WHEN 'MultiPolygon' THEN {many} END"


def read_boundaries(spark: SparkSession, *paths: str) -> DataFrame:
    """Municipality code column and geometry of every feature of one or more collections.

    No declared reference system means longitude and latitude; any other than that is refused.
    """
    raw = spark.read.option("multiLine", True).schema(_FEATURES).json(list(paths))
    crs = F.col("crs.properties.name")
    checked = raw.withColumn("_ok", F.when(crs.isNull() | crs.isin(*_KNOWN_CRS), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unsupported reference system "), crs)).cast("boolean")))
    rows = checked.where("_ok").select(F.explode("features").alias("f"))
    code = F.coalesce(*(F.try_element_at("f.properties", F.lit(c)) for c in UNIT_CODE_COLUMNS))
    return rows.select(code.alias("codarea"), F.struct(F.col("f.geometry.type").alias("type"), F.expr(rings_of("f.geometry.type", "f.geometry.coordinates")).alias("rings")).alias("geometry"))


def check_collection(boundaries: DataFrame, expected: int | None = None) -> int:
    """The number of features; none is an error, another number than expected is left to the caller."""
    n = boundaries.count()
    if not n:
        raise ValueError("an empty feature collection")
    return n


def read_unit_names(spark: SparkSession, *paths: str) -> DataFrame:
    """Zero-filled code and name; without files, a typed empty table."""
    if not paths:
        return spark.createDataFrame([], UNIT_NAMES)
    rows = spark.read.option("multiLine", True).schema("id long, nome string").json(list(paths))
    return rows.where("id is not null").select(zero_fill(F.col("id").cast("string")).alias("municipio_ibge"), F.col("nome").alias("municipio_nome"))


def latest_of(series: str) -> tuple:
    """The last year of a year -> value map, and its value."""
    year = F.array_max(F.map_keys(series))
    return year, series_value(F.element_at(series, year))


def read_population(spark: SparkSession, *paths: str) -> DataFrame:
    """Population of the latest year of every unit; absent markers are null, empty series are skipped."""
    if not paths:
        return spark.createDataFrame([], POPULATION)
    shape = "resultados array<struct<series:array<struct<localidade:struct<id:string>, serie:map<string,string>>>>>"
    rows = spark.read.option("multiLine", True).schema(shape).json(list(paths))
    rows = rows.select(F.explode("resultados").alias("r")).select(F.explode("r.series").alias("s")).select(F.col("s.localidade.id").alias("id"), F.col("s.serie").alias("serie")).where(F.size("serie") > 0)
    year, value = latest_of("serie")
    return rows.select(zero_fill(F.col("id")).alias("municipio_ibge"), value.alias("populacao"), year.alias("populacao_ano"))
