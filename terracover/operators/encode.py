"""Dictionary-encoded columnar payload of the points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .aggregate import BRAND, CATEGORY, panel_rank
from .numbering import numbered


def dictionary(df: DataFrame, column: str, position: str = "_pos") -> DataFrame:
    """(value, code) of a column, codes by first appearance; distinct values are ordered, and by many tasks."""
    firsts = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("")).alias("value")).agg(F.min(position).alias("first"))
    return numbered(firsts, ["first", "value"], position="code").select("value", F.col("code").cast("int").alias("code"))


def emission_order(points: DataFrame, panel: list[str], order: str = "_rid") -> DataFrame:
    """Points in the order of the panel, then of the source, numbered by `_pos`."""
    rows = points.withColumn("_rank", panel_rank(F.col(BRAND), panel))
    return numbered(rows, ["_rank", BRAND, order]).drop("_rank")


def encode(points: DataFrame, coded: list[str], free: list[str], position: str = "_pos") -> tuple[DataFrame, dict[str, DataFrame]]:
    """M1: points with rounded coordinates, codes for the dictionary columns and text for the free ones."""
    tables = {c: dictionary(points, c, position) for c in coded}
    out = points
    for c, t in tables.items():
        key = F.coalesce(F.col(c).cast("string"), F.lit(""))
        out = out.withColumn(f"_v_{c}", key).join(t.toDF(f"_v_{c}", f"{c}_code"), f"_v_{c}").drop(f"_v_{c}")
    shown = [F.round("latitude", 7).alias("latitude"), F.round("longitude", 7).alias("longitude")]
    return out.select(position, *shown, *(F.col(f"{c}_code") for c in coded), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in free)), tables


def layers(points: DataFrame, panel: list[str]) -> DataFrame:
    """M2: the category and brand layers with their [start, stop) ranges; empty categories do not appear."""
    counts = points.groupBy(CATEGORY, BRAND).agg(F.count("*").alias("pontos"))
    w = W.orderBy("_rank", BRAND).rowsBetween(W.unboundedPreceding, 0)
    rows = counts.withColumn("_rank", panel_rank(F.col(BRAND), panel)).withColumn("stop", F.sum("pontos").over(w))
    return rows.withColumn("start", F.col("stop") - F.col("pontos")).drop("_rank")
