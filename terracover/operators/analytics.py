"""The questions of the coverage map: totals, breaks, legend, indicators, ranking, search."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.text import plain_fold, search_key
from ..scope import Selection, View
from .aggregate import suffix

CODE = "municipio_ibge"
MAX_CLASSES = 6
MAX_RANKING = 12
MAX_SUGGESTIONS = 8
MIN_SEARCH = 2


def selection_total(columns: list[str]) -> Column:
    """M4: sum of the selected totals, missing as zero; an empty selection gives zero."""
    return reduce(lambda a, b: a + b, (F.coalesce(F.col(c), F.lit(0)) for c in columns), F.lit(0).cast("long"))


def totals(aggregate: DataFrame, selection: Selection, view: View = View()) -> DataFrame:
    """The aggregate in view with the selection's `total`."""
    columns = [f"total_{suffix(b)}" for b in selection.active]
    return aggregate.where(view.contains(F.col("uf"))).withColumn("total", selection_total([c for c in columns if c in aggregate.columns]))


def class_breaks(rows: DataFrame, total: str = "total", n: int = MAX_CLASSES - 1) -> DataFrame:
    """One row with `cuts`, the lower bounds of the classes of positive totals.

    Up to n distinct values: those. Else n quantile picks, strictly increasing, completed by a geometric
    progression to the maximum where they collapse. Totals are first counted by value, so the ordered
    part sees one row a distinct value.
    """
    values = rows.where(F.col(total) > 0).groupBy(F.col(total).cast("long").alias("v")).agg(F.count("*").alias("k"))
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    ranked = values.withColumn("upto", F.sum("k").over(W.orderBy("v").rowsBetween(W.unboundedPreceding, 0))).withColumn("_n", F.sum("k").over(everything)).withColumn("_distinct", F.count("*").over(everything)).withColumn("_max", F.max("v").over(everything))
    places = F.sequence(F.lit(0), F.lit(n - 1))
    hit = F.exists(places, lambda j: (F.floor(j * F.col("_n") / n) >= F.col("upto") - F.col("k")) & (F.floor(j * F.col("_n") / n) < F.col("upto")))
    picked = ranked.where((F.col("_distinct") <= n) | hit)  # at most n rows
    one = picked.agg(F.array_sort(F.collect_set("v")).alias("base"), F.max("_max").alias("top"), F.max("_distinct").alias("distinct"))
    last, missing = F.element_at("base", -1), F.lit(n) - F.size("base")
    steps = F.transform(F.sequence(F.lit(1), F.greatest(missing, F.lit(1))), lambda g: F.floor(last * F.pow(F.col("top") / last, g / (missing + 1)) + 0.5).cast("long"))
    grown = F.aggregate(steps, F.col("base"), lambda acc, c: F.when((c > F.element_at(acc, -1)) & (c < F.col("top")), F.concat(acc, F.array(c))).otherwise(acc))
    complete = (F.col("distinct") <= n) | (missing <= 0) | (F.col("top") <= last)
    return one.select(F.when(F.size("base") == 0, F.array().cast("array<bigint>")).when(complete, F.col("base")).otherwise(grown).alias("cuts"))


def class_of(total: Column, cuts: Column) -> Column:
    """M6: number of the class of a total, -1 for zero."""
    return F.when(total > 0, F.greatest(F.size(F.filter(cuts, lambda c: c <= total)) - 1, F.lit(0))).otherwise(F.lit(-1))


def legend(rows: DataFrame, cuts: DataFrame, total: str = "total") -> DataFrame:
    """M7: class number, label and count; the zero class (-1) first, empty classes included.

    cuts: the single row of class_breaks().
    """
    top = rows.agg(F.max(total).alias("top"))
    bounds = cuts.crossJoin(top).select("top", F.posexplode("cuts").alias("class", "lo"), "cuts")  # at most n rows
    following = F.get("cuts", F.col("class") + 1)
    label = (
        F.when(following.isNull() & (F.col("lo") >= F.col("top")), F.col("lo").cast("string"))
        .when(following.isNull(), F.concat(F.col("lo").cast("string"), F.lit("+")))
        .when(following - 1 > F.col("lo"), F.concat(F.col("lo").cast("string"), F.lit("–"), (following - 1).cast("string")))
        .otherwise(F.col("lo").cast("string"))
    )
    classes = bounds.select("class", label.alias("label")).union(rows.sparkSession.createDataFrame([(-1, "0")], "class int, label string"))
    counted = rows.crossJoin(F.broadcast(cuts)).groupBy(class_of(F.col(total), F.col("cuts")).alias("class")).agg(F.count("*").alias("n"))
    return classes.join(counted, "class", "left").select("class", "label", F.coalesce("n", F.lit(0)).alias("n"))


def kpis(rows: DataFrame, total: str = "total") -> DataFrame:
    """Points, units served and not (with rounded percentages), population not served, units without data."""
    empty = F.col(total) == 0
    one = rows.agg(
        F.coalesce(F.sum(total), F.lit(0)).cast("long").alias("points"),
        F.coalesce(F.max(total), F.lit(0)).cast("long").alias("most"),
        F.count("*").alias("units"),
        F.count_if(~empty).alias("served"),
        F.count_if(empty).alias("unserved"),
        F.coalesce(F.sum(F.when(empty, F.col("populacao"))), F.lit(0)).cast("long").alias("unserved_population"),
        F.count_if(empty & F.col("populacao").isNull()).alias("without_population"),
    )

    def percent(c: str) -> Column:
        return F.floor(F.col(c) * 100 / F.greatest("units", F.lit(1)) + 0.5).cast("long")

    return one.withColumns({"served_pct": percent("served"), "unserved_pct": percent("unserved")})


def ranking(rows: DataFrame, total: str = "total", k: int = MAX_RANKING, code: str = CODE) -> DataFrame:
    """O3: the k units with most points, ties by code, with a bar width against the first (at least 2)."""
    first = rows.where(F.col(total) > 0).orderBy(F.desc(total), code).limit(k)
    order = W.orderBy(F.desc(total), code)
    return first.withColumn("place", F.row_number().over(order)).withColumn("width", F.greatest(F.lit(2), F.floor(F.col(total) * 100 / F.first(total).over(order) + 0.5)).cast("long"))


def search(units: DataFrame, term: str, name: str = "municipio_nome", code: str = CODE, k: int = MAX_SUGGESTIONS, least: int = MIN_SEARCH) -> DataFrame:
    """Units whose name holds the term, those that start with it first, by name; too short a term finds none."""
    wanted = plain_fold(term).lower().strip()
    rows = units.withColumn("_key", search_key(F.col(name)))
    if len(wanted) < least:
        return rows.limit(0).withColumn("place", F.lit(0)).drop("_key")
    at = F.instr("_key", wanted)
    found = rows.where(at > 0).withColumn("_late", (at != 1).cast("int")).orderBy("_late", "_key", code).limit(k)
    return found.withColumn("place", F.row_number().over(W.orderBy("_late", "_key", code))).drop("_key", "_late")


def search_states(states: DataFrame, term: str, view: View = View()) -> DataFrame:
    """States (uf, nome, ordem) by prefix of name or code, then by part of the name; an empty term finds all."""
    wanted = plain_fold(term).lower().strip()
    if view.state and wanted == plain_fold(tables.STATE_NAMES[view.state]).lower():
        wanted = ""
    rows = states.where(F.col("uf").isin(*tables.REGIONS[view.region])) if view.region else states
    key = search_key(F.col("nome"))
    if not wanted:
        return rows.withColumn("_late", F.lit(0)).orderBy("ordem").drop("_late")
    prefix = key.startswith(wanted) | F.lower("uf").startswith(wanted)
    return rows.where(prefix | key.contains(wanted)).withColumn("_late", (~prefix).cast("int")).orderBy("_late", "ordem").drop("_late")


@dataclass
class Answer:
    """Everything a change of selection or view asks for, over one cached frame of totals."""

    totals: DataFrame
    breaks: DataFrame
    legend: DataFrame
    kpis: DataFrame
    ranking: DataFrame


def coverage(aggregate: DataFrame, selection: Selection, view: View = View()) -> Answer:
    own = totals(aggregate, selection, view).cache()
    cuts = class_breaks(own)
    return Answer(own, cuts, legend(own, cuts), kpis(own), ranking(own))
