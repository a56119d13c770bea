"""Queries on column names, points, rows without a unit, and unions of batches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import checks as C
from ..operators import standardize as D
from ..schema import resolve_column, snake_columns
from .registry import query


@query("resolved_columns", "SELECT c_custkey AS codigo_do_municipio, c_name AS nome_do_campus, c_mktsegment AS segmento FROM customer")
def resolved_columns(spark, sf):
    """Columns found whatever their accents, case and spaces, and named without them."""
    odd = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias(" CÓDIGO  do Município"), F.col("c_name").alias("Nome do Câmpus "), F.col("c_mktsegment").alias("SEGMENTO"), F.lit(1).alias("Outra"))
    own = [resolve_column(odd.columns, names) for names in (["Código do municipio"], ["campus", "NOME DO CAMPUS"], ["segmento"])]
    return snake_columns(odd.select(*(F.col(f"`{c}`") for c in own)))


_KNOWN = {f"Brand#{k}" for k in range(1, 26)}


@query("brand_columns", "SELECT p_size, CAST(count(*) AS BIGINT) total_geral, CAST(count(*) FILTER (WHERE p_size > 25) AS BIGINT) total_large, CAST(count(*) FILTER (WHERE p_size <= 25) AS BIGINT) total_small, " + ", ".join(f"CAST(count(*) FILTER (WHERE p_brand = 'Brand#{k}') AS BIGINT) total_brand_{k}" for k in range(1, 26)) + " FROM part GROUP BY p_size")
def brand_columns(spark, sf):
    """A column for each brand, named after it."""
    rows = spark.read.parquet(f"{sf}/part.parquet").withColumn("kind", F.when(F.col("p_size") > 25, "large").otherwise("small"))
    counts = A.count_points(rows, "p_size", "kind", "p_brand")
    return A.pivot_counts(counts, sorted(_KNOWN), "p_size", "kind", "p_brand", {"total_large": "large", "total_small": "small"})


@query("event_points", "SELECT event_id, value x, CAST(user_id AS DOUBLE) y FROM events")
def event_points(spark, sf):
    """X is the longitude, y the latitude."""
    return D.to_points(spark.read.parquet(f"{sf}/events.parquet"), "user_id", "value").select("event_id", "geometry.x", "geometry.y")


@query("without_unit", "SELECT CAST(count(n_nationkey) AS BIGINT) placed, CAST(count(*) - count(n_nationkey) AS BIGINT) without_code FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 0")
def without_unit(spark, sf):
    """rows without a unit code leave the aggregation, and their number is told."""
    nations = spark.read.parquet(f"{sf}/nation.parquet").where("n_regionkey <> 0").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_nationkey").alias("unit"))
    kept, lost = D.with_unit(spark.read.parquet(f"{sf}/customer.parquet").join(nations, "c_nationkey", "left"), "unit")
    return kept.agg(F.count("*").alias("placed")).crossJoin(lost)


@query("united_batches", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def united_batches(spark, sf):
    """Batches with their columns in any order, one of them empty, under one another."""
    rows = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice", "o_orderstatus")
    batches: list[DataFrame] = [rows.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P")]
    batches += [rows.where(~F.coalesce(F.col("o_orderstatus").isin("F", "O", "P"), F.lit(False))).select("o_orderstatus", "o_orderkey", "o_totalprice"), spark.createDataFrame([], rows.schema)]
    return D.union_all(*batches)


@query("unit_checks", "SELECT 'names' AS check_name, CAST(count(*) FILTER (WHERE n_name IS NULL OR n_nationkey % 6 = 0) AS BIGINT) failures FROM nation UNION ALL SELECT 'population', CAST(0 AS BIGINT)")
def unit_checks(spark, sf):
    """Units without a name, and whether no unit has a population (here a sixth lacks a name, none lacks all)."""
    k = F.col("n_nationkey")
    units = spark.read.parquet(f"{sf}/nation.parquet").select(F.when(k % 6 != 0, F.col("n_name")).alias("municipio_nome"), F.when(k % 2 == 0, k).alias("populacao"))
    return reduce(DataFrame.union, (C.unnamed_units(units), C.population_absent(units)))
