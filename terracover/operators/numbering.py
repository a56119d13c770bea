"""Exact numbers and medians in an order, without a task that sees a whole group.

Rows are range-partitioned and sorted by group and order, so a hot group lies in many partitions; each partition
numbers its own rows, and the counts of the partitions before are added back. What is summed up in one window is a row
for each partition and group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.files import stored


def numbered(df: DataFrame, order: list[str], within: list[str] = (), position: str = "_pos", size: str | None = None) -> DataFrame:
    """df with the place of each row (from 0) by order, in its group, and the size of the group.

    Nulls in within are a group, nulls in order come first; rows that are equal in both get places of their own.
    """
    keys = [F.col(c) for c in (*within, *order)]
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    parts = rows.groupBy("_part", *within).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    own = W.partitionBy(*within)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    if size:
        parts = parts.withColumn("_size", F.sum("_n").over(own))
    parts = parts.withColumnsRenamed({c: f"_k{k}" for k, c in enumerate(within)}).withColumnRenamed("_part", "_p").drop("_n")
    on = F.col("_part") == F.col("_p")
    for k, c in enumerate(within):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{k}"))
    out = rows.join(parts, on).withColumn(position, F.col("_before") + F.col("_at") - F.col("_first"))
    if size:
        out = out.withColumn(size, F.col("_size"))
    return out.drop("_at", "_part", "_p", "_first", "_before", "_size", *(f"_k{k}" for k in range(len(within))))


def carried(df: DataFrame, order: list[str], within: list[str], columns: list[str]) -> DataFrame:
    """df with each of columns filled with its last value that is not null, up to the row, by order in its group."""
    keys = [F.col(c) for c in (*within, *order)]
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "carried")
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(f"_c{k}") for k, c in enumerate(columns)]
    parts = rows.groupBy("_part", *within).agg(*last)
    before = W.partitionBy(*within).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select(F.col("_part").alias("_p"), *(F.col(c).alias(f"_k{k}") for k, c in enumerate(within)), *(F.last(f"_c{k}", ignorenulls=True).over(before).alias(f"_c{k}") for k in range(len(columns))))
    on = F.col("_part") == F.col("_p")
    for k, c in enumerate(within):
        on = on & F.col(c).eqNullSafe(F.col(f"_k{k}"))
    inside = W.partitionBy("_part", *within).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)  # the rows of one partition
    out = rows.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns}).join(parts, on)
    out = out.withColumns({c: F.coalesce(c, f"_c{k}") for k, c in enumerate(columns)})
    return out.drop("_at", "_part", "_p", *(f"_k{k}" for k in range(len(within))), *(f"_c{k}" for k in range(len(columns))))


def medians(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The exact median of each column by keys (none of them null), with equal values counted together first.

    A value takes the places from the count of lesser ones on; the median is the mean of the values at the two middle places.
    """
    values = rows.select(*keys, F.explode(F.array(*(F.struct(F.lit(c).alias("_axis"), F.col(c).cast("double").alias("_v")) for c in columns))).alias("_e")).select(*keys, "_e.*")
    group = [*keys, "_axis"]
    counted = values.where("_v IS NOT NULL").groupBy(*group, "_v").agg(F.count("*").alias("_n"))
    order = [F.col(c) for c in (*group, "_v")]
    placed = stored(counted.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "medians")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy("_part", *group).agg(F.sum("_n").alias("_sum"))
    own = W.partitionBy(*group)
    parts = parts.select("_part", *group, F.sum("_sum").over(own).alias("_size"), F.coalesce(F.sum("_sum").over(own.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_part", *group).orderBy("_at").rowsBetween(W.unboundedPreceding, 0)  # the rows of one partition
    start = F.col("_before") + F.sum("_n").over(inside) - F.col("_n")
    ranged = placed.join(parts, ["_part", *group]).withColumn("_start", start)
    low, high = F.floor((F.col("_size") - 1) / 2), F.floor(F.col("_size") / 2)
    takes = lambda at: (at >= F.col("_start")) & (at < F.col("_start") + F.col("_n"))
    hit = takes(low).cast("int") + takes(high).cast("int")
    found = ranged.withColumn("_hit", hit).where("_hit > 0").groupBy(*keys).pivot("_axis", columns)
    return found.agg((F.sum(F.col("_v") * F.col("_hit")) / 2))
