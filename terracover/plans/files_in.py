"""Queries on the source formats: workbooks and zipped CSV written from the tables, read back and searched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import geocode as G
from ..sources import files as S
from ..sources import json_files as J
from ..sources.fetch import fetch_all
from ..sources.xlsx import XlsxSource
from ..sources.zipcsv import ZipCsvSource, read_addresses
from .registry import query


@query("workbook_register", "SELECT CAST(c_custkey AS VARCHAR) AS \"CUST KEY\", c_name AS \"NAME\", CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) balance, c_mktsegment segment FROM customer")
def workbook_register(spark, sf):
    """Customers written as workbooks with nine lines before the header, and read by ranges of rows."""
    path = S.shared_path(spark, "workbooks")
    spark.dataSource.register(XlsxSource)
    rows = spark.read.parquet(f"{sf}/customer.parquet")
    cells = rows.select(F.col("c_custkey").cast("string").alias(" CUST  KEY "), F.col("c_name").alias("NAME"), F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("balance"), F.col("c_mktsegment").alias("segment"))
    cells.write.format("xlsx").mode("overwrite").save(path)
    return spark.read.format("xlsx").option("rows", 2000).load(path).drop("_rid")


def order_addresses(spark, sf) -> DataFrame:
    """Orders as address rows, all text: nine units, 400 post codes, a third without a coordinate."""
    k = F.col("o_orderkey")
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        (F.lit(4200000) + k % 9).cast("string").alias("COD_MUNICIPIO"), F.lpad((k % 400).cast("string"), 8, "8").alias("CEP"), F.lit("RUA").alias("NOM_TIPO_SEGLOGR"), F.lit(None).cast("string").alias("NOM_TITULO_SEGLOGR"),
        F.concat(F.lit("Número; "), F.col("o_custkey").cast("string")).alias("NOM_SEGLOGR"), k.cast("string").alias("NUM_ENDERECO"), F.when(k % 3 != 0, (k / 8).cast("string")).alias("LATITUDE"), (-k / 4).cast("string").alias("LONGITUDE"),
    )


def zipped_orders(spark, sf) -> str:
    spark.dataSource.register(ZipCsvSource)
    path = S.shared_path(spark, "zipped")
    order_addresses(spark, sf).write.format("zipcsv").mode("overwrite").save(path)
    return path


_UNITS = [f"{4200000 + k}" for k in (1, 2, 5, 7)]
_WANTED = "SELECT DISTINCT CAST(4200000 + o_orderkey % 9 AS VARCHAR) m, lpad(CAST(o_orderkey % 400 AS VARCHAR), 8, '8') c, 'NUMERO ' || o_custkey s, o_totalprice p FROM orders"


@query("zipped_addresses", f"""WITH a AS (SELECT o_orderkey k, CAST(4200000 + o_orderkey % 9 AS VARCHAR) m, lpad(CAST(o_orderkey % 400 AS VARCHAR), 8, '8') c, 'NUMERO ' || o_custkey s FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey % 9 IN (1, 2, 5, 7)), w AS ({_WANTED})
SELECT 'cep' AS kind, m mun, c chave, CAST(k AS DOUBLE) num, CAST(CAST(k / 8.0 AS FLOAT) AS DOUBLE) lat, CAST(CAST(-k / 4.0 AS FLOAT) AS DOUBLE) lon FROM a WHERE EXISTS (SELECT 1 FROM w WHERE w.m = a.m AND w.c = a.c AND p > 400000)
UNION ALL SELECT 'street', m, s, CAST(k AS DOUBLE), CAST(CAST(k / 8.0 AS FLOAT) AS DOUBLE), CAST(CAST(-k / 4.0 AS FLOAT) AS DOUBLE) FROM a WHERE EXISTS (SELECT 1 FROM w WHERE w.m = a.m AND w.s = a.s AND p < 20000)""")
def zipped_addresses(spark, sf):
    """Archives scanned with the units and the coordinate tests pushed down, retained by both key sets."""
    raw = read_addresses(spark, zipped_orders(spark, sf)).where(F.col("COD_MUNICIPIO").isin(_UNITS))
    own = G.reference_addresses(raw)
    orders, asked = spark.read.parquet(f"{sf}/orders.parquet"), G.reference_addresses(order_addresses(spark, sf).withColumns({"LATITUDE": F.lit("0"), "LONGITUDE": F.lit("0")}))
    targets = asked.withColumn("o_orderkey", F.col("num").cast("long")).join(orders.select("o_orderkey", "o_totalprice"), "o_orderkey")
    targets = targets.select(F.col("mun").alias("municipio_ibge"), F.col("cep").alias("cep8"), F.col("logr").alias("chave_logr"), "o_totalprice")
    found = None
    for kind, key, wanted, rule in (("cep", "cep", "cep8", "o_totalprice > 400000"), ("street", "logr", "chave_logr", "o_totalprice < 20000")):
        rows = G.retain(own, key, G.wanted_keys(targets.where(rule), wanted)).select(F.lit(kind).alias("kind"), "mun", "chave", "num", F.col("lat").cast("double").alias("lat"), F.col("lon").cast("double").alias("lon"))
        found = rows if found is None else found.union(rows)
    return found


@query("zipped_scan_counts", "SELECT CAST(count(*) AS BIGINT) AS read, CAST(count(*) FILTER (WHERE o_orderkey % 9 IN (1, 2, 5, 7) AND o_orderkey % 3 <> 0) AS BIGINT) kept FROM orders")
def zipped_scan_counts(spark, sf):
    """Rows that the scan read, and rows that the pushed filters let out of it."""
    counts = S.shared_path(spark, "scan-counts")
    raw = read_addresses(spark, zipped_orders(spark, sf), counts=counts).where(F.col("COD_MUNICIPIO").isin(_UNITS))
    G.reference_addresses(raw).write.format("noop").mode("overwrite").save()
    return spark.read.schema("read long, kept long").json(counts).agg(F.sum("read").alias("read"), F.sum("kept").alias("kept"))


@query("fetched_boundaries", "SELECT r_name AS region, CASE WHEN r_regionkey % 5 = 3 THEN 'failed' ELSE 'fetched' END AS status, CAST(CASE WHEN r_regionkey % 5 <> 3 THEN (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) ELSE 0 END AS BIGINT) features FROM region")
def fetched_boundaries(spark, sf):
    """A collection a region fetched by executors, checked and counted; a bad one is a row, not an error."""
    folder, out = S.shared_path(spark, "served"), S.shared_path(spark, "collections")
    nations, regions = spark.read.parquet(f"{sf}/nation.parquet"), spark.read.parquet(f"{sf}/region.parquet")
    x = F.col("n_nationkey")
    corners = F.concat_ws(",", *(F.concat(F.lit("["), (x + a).cast("string"), F.lit(f",{b}]")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"codarea":"'), F.lpad(x.cast("string"), 7, "0"), F.lit('"},"geometry":{"type":"Polygon","coordinates":[['), corners, F.lit("]]}}"))
    own = nations.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.array_join(F.collect_list(feature), ",").alias("features"))  # one region's features
    kind = F.when(F.col("r_regionkey") % 5 == 3, "Feature").otherwise("FeatureCollection")
    files = regions.join(own, "r_regionkey").select(F.concat("r_name", F.lit(".json")).alias("name"), F.concat(F.lit('{"type":"'), kind, F.lit('","features":['), "features", F.lit("]}")).alias("text"))
    S.write_texts(files, folder)
    requests = regions.select(F.concat(F.lit(f"{folder}/"), "r_name", F.lit(".json")).alias("url"), F.concat(F.lit(f"{out}/"), "r_name", F.lit(".geojson")).alias("target"), F.lit("features").alias("check"))
    answers = fetch_all(requests, 4, tries=2, wait=0.01)
    read = J.read_boundaries(spark, out).withColumn("r_regionkey", F.col("codarea").cast("long")).join(nations.select(x.alias("r_regionkey"), "n_regionkey"), "r_regionkey")
    counts = read.groupBy("n_regionkey").agg(F.count("*").alias("features")).join(regions.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")), "n_regionkey")
    told = answers.select(F.regexp_extract("target", r"([^/]+)\.geojson$", 1).alias("region"), "status")
    return told.join(counts.select("region", "features"), "region", "left").na.fill(0, ["features"])
