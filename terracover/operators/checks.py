"""Invariants as DataFrames of violations, which must be empty."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tables


def unclassified(df: DataFrame) -> DataFrame:
    """Rows without category or brand."""
    return df.where(F.col("categoria_if").isNull() | F.col("sub_categoria").isNull())


def unreconciled(wide: DataFrame, whole: str, *partitions: list[str]) -> DataFrame:
    """Rows where the whole differs from the sum of any of its partitions."""
    wrong = F.lit(False)
    for parts in partitions:
        wrong = wrong | (F.col(whole) != sum((F.col(p) for p in parts), F.lit(0)))
    return wide.where(wrong)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that more than one row has, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def bad_codes(df: DataFrame, code: str = "municipio_ibge") -> DataFrame:
    """C4: codes that are null or not seven digits, with up to five examples in one row, if there are any."""
    bad = df.where(F.col(code).isNull() | ~F.col(code).rlike(r"^\d{7}$"))
    first = bad.select(F.substring(code, 1, 40).alias("c")).distinct().where("c IS NOT NULL").orderBy("c").limit(5)
    return bad.agg(F.count("*").alias("n")).crossJoin(first.agg(F.array_sort(F.collect_list("c")).alias("examples"))).where("n > 0")  # one row each


def incomplete_states(units: DataFrame, states: list[str]) -> DataFrame:
    """States whose number of units differs from the official one."""
    expected = units.sparkSession.createDataFrame([(s, tables.UNITS_PER_STATE[s]) for s in states], "uf string, expected long")
    found = units.groupBy("uf").agg(F.count("*").alias("found"))
    return expected.join(found, "uf", "outer").na.fill(0, ["expected", "found"]).where("expected <> found")


def unnamed_units(units: DataFrame) -> DataFrame:
    """How many units have no name."""
    return units.agg(F.lit("names").alias("check_name"), F.count_if(F.col("municipio_nome").isNull()).alias("failures"))


def population_absent(units: DataFrame) -> DataFrame:
    """One failure if there are units and none has a population."""
    return units.agg(F.lit("population").alias("check_name"), F.when((F.count("*") > 0) & (F.count("populacao") == 0), 1).otherwise(0).cast("long").alias("failures"))


def is_stale(derived: str, source: str, slack: float = 60.0) -> bool:
    """Whether a derived file is older than its source by more than the slack."""
    return os.path.getmtime(derived) < os.path.getmtime(source) - slack


def excess_unmatched(points: DataFrame, matched: DataFrame, share: float = 0.001, floor: int = 1) -> DataFrame:
    """One row if more than the allowed share of points is unmatched."""
    n = points.agg(F.count("*").alias("n"))
    m = matched.agg(F.count("*").alias("m"))
    return n.crossJoin(m).withColumn("unmatched", F.col("n") - F.col("m")).where(F.col("unmatched") > F.greatest(F.lit(floor), F.floor(F.col("n") * share)))
