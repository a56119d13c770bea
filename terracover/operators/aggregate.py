"""Counts, pivots, detail texts, coverage and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.text import number_br, snake_case

CODE, CATEGORY, BRAND = "municipio_ibge", "categoria_if", "sub_categoria"


def count_points(points: DataFrame, *keys: str) -> DataFrame:
    """A1: points by code, category and brand; nulls are groups."""
    return points.groupBy(*(keys or (CODE, CATEGORY, BRAND))).agg(F.count("*").alias("pontos"))


def suffix(brand: str) -> str:
    """Column suffix of a brand; unknown brands get one made from their name."""
    return tables.BRAND_SUFFIX.get(brand) or snake_case(brand)


def pivot_counts(counts: DataFrame, known: list[str] | None = None, code: str = CODE, category: str = CATEGORY, brand: str = BRAND, categories: dict[str, str] | None = None, closed: bool = False) -> DataFrame:
    """One row a code with totals by category and brand, zero filled, in one aggregation.

    Known brands have their columns even if unseen; unknown ones follow, sorted (A21: their distinct
    names are the only rows that reach the driver, one a brand). closed: the caller knows all brands, so none are looked for.
    """
    known = list(tables.BRAND_SUFFIX) if known is None else known
    categories = categories or {"total_cooperativas": tables.CATEGORY_COOPERATIVE, "total_bancos": tables.CATEGORY_BANK}
    seen = [] if closed else [r[0] for r in counts.where(F.col(brand).isNotNull() & ~F.col(brand).isin(*known)).select(brand).distinct().collect()]

    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("pontos"))), F.lit(0)).cast("long").alias(name)

    parts = [total(F.col(category) == c, name) for name, c in categories.items()]
    brands = [total(F.col(brand) == b, f"total_{suffix(b)}") for b in [*known, *sorted(seen)]]
    wide = counts.groupBy(code).agg(*parts, *brands)
    whole = sum((F.col(n) for n in categories), F.lit(0)).cast("long").alias("total_geral")
    return wide.select(code, whole, *categories, *(c for c in wide.columns if c != code and c not in categories))


def join_dimension(units: DataFrame, wide: DataFrame, code: str = CODE) -> DataFrame:
    """Every unit stays, counts it lacks are zero. wide has one row a code (see checks.duplicate_keys)."""
    totals = [c for c in wide.columns if c != code]
    joined = units.join(wide, code, "left")
    return joined.select(*units.columns, *(F.coalesce(c, F.lit(0)).alias(c) for c in totals))


def bucket_detail(points: DataFrame, code: str = CODE, brand: str = BRAND, mark: str = "marca_exibicao", bucket: str = tables.OTHER_COOPERATIVE) -> DataFrame:
    """Per code "brand n · brand n" inside the bucket, by count, then name."""
    counts = points.where((F.col(brand) == bucket) & F.col(code).isNotNull() & F.col(mark).isNotNull()).groupBy(code, mark).agg(F.count("*").alias("n"))
    parts = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("k"), F.col(mark).alias("m"))))  # one entry a brand of the bucket
    return counts.groupBy(code).agg(F.array_join(F.transform(parts, lambda p: F.concat(p["m"], F.lit(" "), (-p["k"]).cast("string"))), " · ").alias("outras_coops_detalhe"))


def join_detail(aggregate: DataFrame, detail: DataFrame, code: str = CODE) -> DataFrame:
    """J2."""
    return aggregate.join(detail, code, "left").withColumn("outras_coops_detalhe", F.coalesce("outras_coops_detalhe", F.lit("")))


def unmatched(points: DataFrame, units: DataFrame, code: str = CODE) -> DataFrame:
    """Points whose code no unit has; a null code counts as unmatched."""
    return points.join(units.select(code).distinct(), code, "left_anti")


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Counts by value, most frequent first, nulls dropped."""
    kept = df.na.drop(subset=list(columns)).groupBy(*columns).agg(F.count("*").alias("n"))
    return kept.orderBy(F.desc("n"), *columns)


def crosstab(df: DataFrame, rows: str, column: str, values: list[str]) -> DataFrame:
    """Counts of rows by column, zeros included."""
    return df.groupBy(rows).agg(*(F.count(F.when(F.col(column) == v, 1)).alias(v) for v in values))


def institution_types(df: DataFrame, names: list[str]) -> DataFrame:
    """Counts by institution and type of the named institutions; null groups stay."""
    return df.where(F.col("nome_instituicao").isin(*names)).groupBy("nome_instituicao", "tipo_instalacao").agg(F.count("*").alias("n"))


def coverage_by(aggregate: DataFrame, *keys: str, total: str = "total_geral") -> DataFrame:
    """Units, units without a point, and their share in percent."""
    out = aggregate.groupBy(*keys).agg(F.count("*").alias("units"), F.count_if(F.col(total) == 0).alias("unserved"))
    return out.withColumn("unserved_pct", F.round(100 * F.col("unserved") / F.col("units"), 1))


def coverage_summary(aggregate: DataFrame, points: DataFrame) -> DataFrame:
    """One row of coverage figures; populations that are missing are left out."""
    unserved = F.col("total_geral") == 0
    one = aggregate.agg(F.count("*").alias("units"), F.count_if(~unserved).alias("served"), F.count_if(unserved).alias("unserved"), F.sum(F.when(unserved, F.col("populacao"))).alias("unserved_population"), F.median(F.when(unserved, F.col("populacao"))).alias("unserved_population_median"))
    outside = unmatched(points, aggregate).agg(F.count("*").alias("points_outside"))
    return one.crossJoin(outside)  # one row by one row


def column_totals(aggregate: DataFrame, columns: list[str]) -> DataFrame:
    """Sum of each total column, and how many units have any."""
    stacked = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in columns)))
    rows = aggregate.select(stacked.alias("t")).select("t.*")
    return rows.groupBy("name").agg(F.sum("n").alias("total"), F.count_if(F.col("n") > 0).alias("units"))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """A20."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(f"no_{c}") for c in columns))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """A21."""
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def top_k(df: DataFrame, by: str, k: int, tie: str = CODE) -> DataFrame:
    """O2: the k largest, nulls left out, ties by code."""
    return df.where(F.col(by).isNotNull()).orderBy(F.desc(by), F.asc(tie)).limit(k)


def panel_rank(brand: Column, order: list[str]) -> Column:
    """Place of a brand in the panel; unknown ones come after, by name."""
    place = F.array_position(F.array(*map(F.lit, order)), brand)
    return F.when(place > 0, place).otherwise(len(order) + 1)


def brand_ranges(counts: DataFrame, order: list[str], brand: str = BRAND, n: str = "pontos") -> DataFrame:
    """[start, stop) of each brand in panel order. counts has one row a brand."""
    w = W.orderBy("_rank", brand).rowsBetween(W.unboundedPreceding, 0)
    ranked = counts.withColumn("_rank", panel_rank(F.col(brand), order))
    return ranked.withColumn("stop", F.sum(n).over(w)).withColumn("start", F.col("stop") - F.col(n)).drop("_rank")


def cumulative_levels(points: DataFrame, level: str, order: list[str]) -> DataFrame:
    """Count, running count and running percentage of every level in order, absent levels as zero."""
    levels = points.sparkSession.createDataFrame([(k, v) for k, v in enumerate(order)], "_rank int, level string")
    counts = points.groupBy(F.col(level).alias("level")).agg(F.count("*").alias("n"))
    w = W.orderBy("_rank")
    out = levels.join(counts, "level", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    out = out.withColumn("running", F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("_all", F.sum("n").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    return out.select("level", "n", "running", F.round(F.try_divide(100 * F.col("running"), F.col("_all")), 1).alias("running_pct"))


def group_counts(points: DataFrame, category: str = CATEGORY, brand: str = BRAND) -> DataFrame:
    """Counts by category and by brand inside it, in one pass (brand null: the whole category)."""
    return points.rollup(category, brand).agg(F.count("*").alias("n"), F.grouping_id().alias("_g")).where("_g < 3").drop("_g")


def territory_labels(units: DataFrame, *keys: str, first: tuple[str, ...] = (), state: str = "uf") -> DataFrame:
    """Name and header line of the territory that units cover, as found in the data (one row, or one a key).

    States are listed as in first, then by code, then unknown ones by name; null states only count as units.
    """
    every = list(dict.fromkeys([*first, *sorted(tables.STATE_CODES, key=tables.STATE_CODES.get)]))
    rows = units.groupBy(*keys).agg(F.count("*").alias("_n"), F.collect_set(state).alias("_found"))  # states: 27 at most
    order = F.array(*map(F.lit, every))
    found = F.concat(F.array_intersect(order, "_found"), F.array_except(F.array_sort("_found"), order))

    label, where = F.concat(F.size(found).cast("string"), F.lit(" UFs")), F.concat(F.lit("de "), F.array_join(found, ", "))
    named = {**{f"Região {r}": (f"da Região {r}", own) for r, own in tables.REGIONS.items()}, "Brasil": ("do Brasil", every)}
    for name, (place, states) in named.items():
        whole = F.array_sort("_found") == F.array(*map(F.lit, sorted(states)))
        label, where = F.when(whole, name).otherwise(label), F.when(whole, place).otherwise(where)
    line = F.concat(F.lit("Agências e postos de atendimento nos "), number_br(F.col("_n")), F.lit(" municípios "), where, F.lit("."))
    return rows.select(*keys, label.alias("label"), line.alias("subtitle"))
