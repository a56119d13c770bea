"""From raw registers to the categorised table: projections, filters and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.rules import classify
from ..functions.text import lookup, squeeze, unit_code
from ..schema import COMMON_COLUMNS, REGISTER_HEADERS, UNIT_CODE_COLUMNS, first_column, resolve_column
from ..scope import Scope


def standardize(df: DataFrame, kind: str, source: str, rank: int = 0, headers: dict[str, list[str]] = REGISTER_HEADERS) -> DataFrame:
    """The common schema with provenance and `_rid`; footer rows (without a state) go."""
    columns = {target: resolve_column(df.columns, names) for target, names in headers.items()}
    picked = [(unit_code if target == "municipio_ibge" else squeeze)(F.col(f"`{name}`").cast("string")).alias(target) for target, name in columns.items()]
    order = F.col("_rid") if "_rid" in df.columns else F.monotonically_increasing_id()
    rows = df.select(*picked, F.lit(kind).alias("tipo_instalacao"), F.lit(source).alias("fonte_arquivo"), (F.lit(rank).cast("long") * (1 << 48) + order).alias("_rid"))
    return rows.where(F.col("uf").isNotNull() & (F.col("uf") != "")).select(*COMMON_COLUMNS, "_rid")


def union_all(*frames: DataFrame) -> DataFrame:
    """Sources one under the other, by column name."""
    return reduce(DataFrame.unionByName, frames)


def in_scope(df: DataFrame, scope: Scope) -> DataFrame:
    """F1."""
    return df.where(scope.contains(F.col("uf")))


def target_institutions(df: DataFrame) -> DataFrame:
    """co-operatives by segment or the listed banks by exact name."""
    return df.where((F.col("segmento") == tables.COOPERATIVE_SEGMENT) | F.col("nome_instituicao").isin(*tables.BANK_BRANDS))


def categorise(frames: list[DataFrame], scope: Scope) -> DataFrame:
    """Stage 1: union, territory, institutions, then the classifications."""
    return classify(target_institutions(in_scope(union_all(*frames), scope)))


def with_unit(df: DataFrame, code: str = "municipio_ibge") -> tuple[DataFrame, DataFrame]:
    """rows with a unit code, and the count of those without (one row)."""
    return df.where(F.col(code).isNotNull()), df.where(F.col(code).isNull()).agg(F.count("*").alias("without_code"))


def unit_dimensions(df: DataFrame) -> DataFrame:
    """The code column under its own name, with state and region derived from it."""
    df = df.withColumnRenamed(first_column(df.columns, UNIT_CODE_COLUMNS), "municipio_ibge").withColumn("municipio_ibge", unit_code(F.col("municipio_ibge")))
    states = {str(code): uf for uf, code in tables.STATE_CODES.items()}
    return df.withColumn("uf", lookup(F.substring("municipio_ibge", 1, 2), states)).withColumn("regiao", lookup(F.col("uf"), tables.REGION_OF_STATE))


def enrich_units(units: DataFrame, names: DataFrame | None, population: DataFrame | None) -> DataFrame:
    """Names and population joined to the boundaries; an absent source gives typed nulls."""
    code = "municipio_ibge"
    if names is not None:
        units = units.join(names.select(code, "municipio_nome"), code, "left")
    else:
        units = units.withColumn("municipio_nome", F.lit(None).cast("string"))
    if population is not None:
        return units.join(population.select(code, "populacao", "populacao_ano"), code, "left")
    return units.withColumn("populacao", F.lit(None).cast("long")).withColumn("populacao_ano", F.lit(None).cast("string"))


def client_properties(aggregate: DataFrame) -> DataFrame:
    """Population as a number, a blank year as null, a missing detail as empty."""
    return aggregate.withColumns({"populacao_valor": F.col("populacao").cast("long"), "populacao_ano": F.when(F.trim("populacao_ano") != "", F.col("populacao_ano")), "outras_coops_detalhe": F.coalesce("outras_coops_detalhe", F.lit(""))})


def cell_text(x: Column) -> Column:
    """P10."""
    return F.coalesce(x.cast("string"), F.lit(""))


def to_points(df: DataFrame, lat: str, lon: str, crs: str = "EPSG:4326") -> DataFrame:
    """Latitude and longitude as a point; only the identity reference system is supported."""
    if crs not in ("EPSG:4326", "OGC:CRS84"):
        raise ValueError(f"reprojection from {crs} is not supported")
    return df.withColumn("geometry", F.struct(F.col(lon).cast("double").alias("x"), F.col(lat).cast("double").alias("y")))


def key_minus(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """U4: distinct keys of left that right lacks."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def choropleth(aggregate: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in keep, all totals, and the geometry if there is one; nothing else reaches the payload."""
    own = [c for c in aggregate.columns if c in keep or c.startswith("total_") or c == "geometry"]
    return aggregate.select(*own)
