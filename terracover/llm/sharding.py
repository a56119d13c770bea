"""Sharding by sampled splitters (operator 4), with DataFrame functions only.

Records are ordered by (hash of the text, doc_id, row number), so equal texts lie side by side. Steps:
  1. draw a sample of keys, each with a chance in proportion to its size, and take quantiles of it as
     splitters of fine ranges;
  2. count rows and bytes of every range exactly; ranges over OVERFULL times the mean are subdivided
     by splitters drawn from inside them, until none of more than one record is overfull (row numbers
     differ, so every range of more records can be divided);
  3. lay the ranges end to end; cumulative bytes give each record its position, and the shard is the
     eighth of all bytes that its position falls in, so shards differ by less than one record;
  4. slots: rows of a shard that lie in earlier ranges, plus the place inside the range.
No task ever sorts more than one fine range. Splitters and counts of ranges reach the driver; a range
holds RANGE_ROWS slim keys, or more where that would make more than MAX_RANGES of them. No side is
forced to be broadcast.

Law: `bytes`. It goes before the grouping of equal texts: a group is cut where the boundary of a shard
falls into it, and nowhere else, so it lies on as few successive shards as its bytes allow, or one more.
Null or empty text has size 1 and crc 0; rows with equal doc_ids and texts are ordered arbitrarily but
once; null doc_id sorts first; an empty table gives no rows; other columns are ignored. Very long texts
are only measured and hashed, by expressions.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import materialize, read_table, shuffle_partitions

N_SHARDS = 8
RANGE_ROWS = 200_000
SAMPLE_PER_RANGE = 24
OVERFULL = 2.0
MAX_RANGES = 20_000
#: Bins of the first hash bits, each with its own short list of splitters.
BINS = 4096


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, the hash that groups equal texts, and a row number."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("r"))


Key = tuple[int, int, int]
LEAST_ID = -(2**63) + 1


def _bin_of(h: Column) -> Column:
    return F.shiftrightunsigned(h.bitwiseXOR(F.lit(-(2**63))), 64 - (BINS.bit_length() - 1)).cast("int")


def range_of(splitters: list[Key]) -> Column:
    """How many splitters lie at or below (h, doc_id, r): one array lookup, then a short list."""
    bins: list[list[Key]] = [[] for _ in range(BINS)]
    for h, d, r in splitters:
        bins[(h + 2**63) >> (64 - (BINS.bit_length() - 1))].append((h, d, r))
    before, at = 0, []
    for b in bins:
        at.append(before)
        before += len(b)
    key = f"named_struct('h', h, 'd', coalesce(doc_id, {LEAST_ID}L), 'r', r)"
    # texts parsed by Spark: one literal array each, so that no expression per splitter is built
    ends = "from_json('[" + ",".join("[" + ",".join(f'{{"h":{h},"d":{d},"r":{r}}}' for h, d, r in b) + "]" for b in bins) + "]', 'array<array<struct<h:bigint,d:bigint,r:bigint>>>')"
    starts = "from_json('[" + ",".join(map(str, at)) + "]', 'array<int>')"
    return F.expr(f"element_at({starts}, _bin + 1) + size(filter(element_at({ends}, _bin + 1), s -> s <= {key}))")


def with_range(rows: DataFrame, splitters: list[Key]) -> DataFrame:
    return rows.withColumn("_bin", _bin_of(F.col("h"))).withColumn("range", range_of(splitters)).drop("_bin")


def draw(rows: DataFrame, mean: Column, per: int) -> DataFrame:
    """A sample of keys, each row taken with the chance per * size / mean (a draw fixed by its key)."""
    chance = F.lit(float(per)) * F.col("size") / mean
    u = F.shiftrightunsigned(F.xxhash64("h", "doc_id", "r", F.lit(17)), 11) / F.lit(float(2**53))
    return rows.where(u < chance).select("h", F.coalesce("doc_id", F.lit(LEAST_ID)).alias("d"), "r")


def quantiles(sample: list[Key], parts: int) -> list[Key]:
    sample = sorted(set(sample))
    if not sample:
        return []
    return sorted({sample[min(len(sample) - 1, k * len(sample) // parts)] for k in range(1, parts)})


def split_ranges(rows: DataFrame, n_shards: int = N_SHARDS, range_rows: int = RANGE_ROWS) -> tuple[list[Key], list]:
    """Splitters, and (range, rows, bytes) of every range between them."""
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if not n:
        return [], []
    parts = max(8 * n_shards, shuffle_partitions(rows.sparkSession), min(MAX_RANGES, math.ceil(n / range_rows)))
    mean, range_rows = total / parts, max(range_rows, math.ceil(n / parts))
    drawn = draw(rows, F.lit(float(mean)), SAMPLE_PER_RANGE).collect()  # about SAMPLE_PER_RANGE keys a range
    splitters = quantiles([(r["h"], r["d"], r["r"]) for r in drawn], parts)
    while True:
        placed = with_range(rows, splitters)
        counts = placed.groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.max("size").alias("most")).orderBy("range").collect()
        over = [c for c in counts if c["n"] > 1 and (c["bytes"] > OVERFULL * mean and c["bytes"] > 2 * c["most"] or c["n"] > OVERFULL * range_rows)]
        if not over:
            return splitters, counts
        inside = placed.where(F.col("range").isin([c["range"] for c in over]))
        # by bytes, and by rows where these are many: about SAMPLE_PER_RANGE keys a wanted range
        heavy = F.least(F.lit(float(mean)), F.col("size") * F.lit(float(range_rows)))
        more = draw(inside, heavy, SAMPLE_PER_RANGE).collect()
        found: dict[int, list] = {}
        for r in more:
            key = (r["h"], r["d"], r["r"])
            found.setdefault(bisect.bisect_right(splitters, key), []).append(key)
        new = set(splitters)
        for c in over:
            new.update(quantiles(found.get(c["range"], []), math.ceil(2 * max(c["bytes"] / mean, c["n"] / range_rows))))
        if len(new) == len(splitters):  # none drawn: the middle record of every such range
            order = W.partitionBy("range").orderBy("h", F.coalesce("doc_id", F.lit(LEAST_ID)), "r")
            middle = inside.withColumn("k", F.row_number().over(order)).withColumn("last", F.count("*").over(W.partitionBy("range"))).where("k = last div 2 + 1")
            new.update((r["h"], r["d"], r["r"]) for r in middle.select("h", F.coalesce("doc_id", F.lit(LEAST_ID)).alias("d"), "r").collect())
        splitters = sorted(new)


def shard(docs: DataFrame, n_shards: int = N_SHARDS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs."""
    rows = materialize(keyed(docs), "shard-keys")
    splitters, counts = split_ranges(rows, n_shards, range_rows)
    total = sum(c["bytes"] for c in counts)
    before, table = 0, []
    for c in counts:  # one row a range
        table.append((c["range"], before))
        before += c["bytes"]
    starts = rows.sparkSession.createDataFrame(table, "range int, before long")
    order = W.partitionBy("range").orderBy("h", "doc_id", "r")
    placed = with_range(rows, splitters).join(starts, "range")
    middle = F.col("before") + F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size") / 2
    placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / F.lit(max(1, total)))).cast("int"))
    placed = placed.withColumn("_in", F.row_number().over(W.partitionBy("range", "shard").orderBy("h", "doc_id", "r")) - 1)
    placed = materialize(placed.select("doc_id", "size", "text_crc32", "range", "shard", "_in"), "shard-places")
    cells = placed.groupBy("shard", "range").agg(F.count("*").alias("n"))  # at most ranges + shards
    before = F.sum("n").over(W.partitionBy("shard").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    firsts = materialize(cells.select("shard", "range", F.coalesce(before, F.lit(0)).alias("first")), "shard-firsts")
    placed = placed.join(firsts, ["shard", "range"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("_in")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str, n_shards: int = N_SHARDS) -> None:
    """Write docs to shard=<k> folders, in slot order inside each file, several files a shard.

    doc_id names a row here; a column of docs called shard is replaced.
    """
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "shard")).alias("row")
    rows = docs.select(F.col("doc_id").alias("id"), own).join(assigned.select(F.col("doc_id").alias("id"), "shard", "slot"), "id")
    files = max(1, shuffle_partitions(docs.sparkSession) // n_shards)
    per = assigned.groupBy("shard").agg((F.max("slot") + 1).alias("rows"))  # one row a shard
    rows = rows.join(per, "shard").withColumn("file", F.floor(F.col("slot") * files / F.col("rows")))
    rows.repartition(n_shards * files, "shard", "file").sortWithinPartitions("shard", "slot").select("row.*", "shard").write.partitionBy("shard").parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read_table(spark, sf_dir, "documents"))
