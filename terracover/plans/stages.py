"""The five stages over files written from the tables, and the five-rule address cascade over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import geocode as G
from ..scope import Scope
from ..sources import files as S
from ..sources.xlsx import XlsxSource
from ..sources.zipcsv import ZipCsvSource
from .pipeline import Inputs, Pipeline
from .registry import query


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _code(nation: Column) -> Column:
    """A unit of one of three states for each nation."""
    return F.concat(_text(nation % 3 + 41), F.lpad(_text(nation), 5, "0"))


def _state(nation: Column) -> Column:
    return F.element_at(F.array(F.lit("PR"), F.lit("SC"), F.lit("RS")), (nation % 3 + 1).cast("int"))


def line_addresses(spark, sf, unit: Column, latitude: Column, longitude: Column) -> DataFrame:
    """Line items as reference addresses: 97 thousands of post codes, the first of each a generic one."""
    return spark.read.parquet(f"{sf}/lineitem.parquet").select(
        unit.alias("COD_MUNICIPIO"), F.lpad(_text(F.col("l_suppkey") % 97 * 1000 + F.col("l_linenumber") % 3), 8, "0").alias("CEP"), F.lit("RUA").alias("NOM_TIPO_SEGLOGR"), F.lit("").alias("NOM_TITULO_SEGLOGR"),
        F.concat(F.lit("NÚMERO "), _text("l_suppkey")).alias("NOM_SEGLOGR"), _text("l_linenumber").alias("NUM_ENDERECO"), _text(latitude).alias("LATITUDE"), _text(longitude).alias("LONGITUDE"),
    )


_ADDRESSES = "SELECT {unit} mun, lpad(CAST(l_suppkey % 97 * 1000 + l_linenumber % 3 AS VARCHAR), 8, '0') cep, 'NUMERO ' || l_suppkey logr, l_linenumber num, CAST(l_quantity / 4 AS FLOAT) lat, CAST(l_discount * 100 AS FLOAT) lon FROM lineitem"
_ASKED = "{cep} cep, NOT ends_with({cep}, '000') specific, ends_with({cep}, '000') AND {cep} <> '00000000' generic"
_MEDIAN = "CAST(CAST(median(CAST(lat AS DOUBLE)) AS FLOAT) AS DOUBLE) lat, CAST(CAST(median(CAST(lon AS DOUBLE)) AS FLOAT) AS DOUBLE) lon"
_ORDER_CEP = "lpad(CAST(o_orderkey % 101 * 1000 + o_orderkey % 4 AS VARCHAR), 8, '0')"


@query("located_addresses", f"""WITH a AS ({_ADDRESSES.format(unit="CAST(4200000 + l_partkey % 50 AS VARCHAR)")}),
cn AS (SELECT mun, cep, num, {_MEDIAN} FROM a GROUP BY ALL), ln AS (SELECT mun, logr, num, {_MEDIAN} FROM a GROUP BY ALL), c AS (SELECT mun, cep, {_MEDIAN} FROM a GROUP BY ALL), l AS (SELECT mun, logr, {_MEDIAN} FROM a GROUP BY ALL),
t AS (SELECT o_orderkey, CAST(4200000 + o_custkey % 53 AS VARCHAR) mun, 'NUMERO ' || (o_custkey % 150) logr, nullif(o_orderkey % 9, 0) num, {_ASKED.format(cep=_ORDER_CEP)} FROM orders)
SELECT o_orderkey, coalesce(r1.lat, r2.lat, r3.lat, r4.lat, r5.lat) latitude, coalesce(r1.lon, r2.lon, r3.lon, r4.lon, r5.lon) longitude,
CASE WHEN coalesce(r1.lat, r2.lat) IS NOT NULL THEN 'endereço' WHEN coalesce(r3.lat, r4.lat) IS NOT NULL THEN 'logradouro' WHEN r5.lat IS NOT NULL THEN 'localidade' ELSE '' END precisao
FROM t LEFT JOIN cn r1 ON specific AND r1.mun = t.mun AND r1.cep = t.cep AND r1.num = t.num LEFT JOIN ln r2 ON r2.mun = t.mun AND r2.logr = t.logr AND r2.num = t.num
LEFT JOIN c r3 ON specific AND r3.mun = t.mun AND r3.cep = t.cep LEFT JOIN l r4 ON r4.mun = t.mun AND r4.logr = t.logr LEFT JOIN c r5 ON generic AND r5.mun = t.mun AND r5.cep = t.cep""")
def located_addresses(spark, sf):
    """All line items as addresses, all orders as targets, the four tables and the five rules."""
    k = F.col("o_orderkey")
    targets = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", _text(4200000 + F.col("o_custkey") % 53).alias("municipio_ibge"), F.lpad(_text(k % 101 * 1000 + k % 4), 8, "0").alias("cep"), F.concat(F.lit("R.NÚMERO "), _text(F.col("o_custkey") % 150), F.lit(","), _text(k % 9)).alias("endereco"), F.lit(None).cast("string").alias("numero"))
    targets = G.address_keys(targets)
    raw = line_addresses(spark, sf, _text(4200000 + F.col("l_partkey") % 50), F.col("l_quantity") / 4, F.col("l_discount") * 100)
    found = G.locate(targets, G.build_index(targets, G.reference_addresses(raw)))
    return found.select("o_orderkey", "latitude", "longitude", "precisao")


# ---------------------------------------------------------------- the five stages


def _register(rows: DataFrame, installation: str, name: Column, segment: Column, key: Column, nation: Column, number: Column) -> DataFrame:
    values = {
        "CNPJ ": F.lit("99.999.999"), "NOME  INSTITUIÇÃO": name, "SEGMENTO": segment, installation: F.concat(F.lit("PA "), _text(key)), "ENDEREÇO": F.concat(F.lit("R.NÚMERO "), _text(key % 150), number), "NÚMERO": F.lit(None), "BAIRRO": F.lit("CENTRO"),
        "CEP": F.lpad(_text(key % 101 * 1000 + key % 4), 8, "0"), "MUNICíPIO": F.concat(F.lit("Unit "), _text(nation)), "UF": _state(nation), "MUNICIPIO IBGE": F.concat(_code(nation), F.lit(".0")),
    }
    return rows.select(*(v.cast("string").alias(k) for k, v in values.items()))


def stage_inputs(spark, sf) -> Inputs:
    """Registers as workbooks, nations as boundaries by state, line items as zipped addresses."""
    folder = S.shared_path(spark, "five-stages")
    spark.dataSource.register(XlsxSource)
    spark.dataSource.register(ZipCsvSource)
    segment = F.col("c_mktsegment")
    names = {"BUILDING": "BANCO DO BRASIL S.A.", "AUTOMOBILE": "BANCO BRADESCO S.A.", "FURNITURE": "BANCO QUALQUER S.A.", "HOUSEHOLD": "COOPERATIVA DE CRÉDITO - SICOOB SUL", "MACHINERY": "SICREDI SERRANA"}
    name = F.coalesce(*(F.when(segment == k, F.lit(v)) for k, v in names.items()), F.lit("OUTRO BANCO"))
    kind = F.when(name.startswith("COOPERATIVA") | name.startswith("SICREDI"), "Cooperativa de Crédito").otherwise("Banco Múltiplo")
    customers, suppliers = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("customer", "supplier"))
    branches = _register(customers, "NOME AGÊNCIA", name, kind, F.col("c_custkey"), F.col("c_nationkey"), F.concat(F.lit(","), _text(F.col("c_custkey") % 9)))
    posts = _register(suppliers, "NOME INSTALAÇÃO", F.lit("COOPERATIVA DE CRÉDITO DOS FUNCIONÁRIOS"), F.lit("Cooperativa de Crédito"), F.col("s_suppkey"), F.col("s_nationkey"), F.lit(""))
    branches.write.format("xlsx").mode("overwrite").save(f"{folder}/branches")
    posts.write.format("xlsx").mode("overwrite").save(f"{folder}/posts")

    nation = F.col("n_nationkey")
    corners = F.concat_ws(",", *(F.concat(F.lit("["), _text(nation + a), F.lit(f",{b}]")) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))))
    shape = F.concat(F.lit('{"type":"Polygon","coordinates":[['), corners, F.lit("]]}"))
    lines = spark.read.parquet(f"{sf}/nation.parquet").select(_state(nation).alias("state"), F.concat(F.lit('{"type":"Feature","properties":{"codarea":"'), _code(nation), F.lit('"},"geometry":'), shape, F.lit("}")).alias("value"))
    whole = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list("value"), ","), F.lit("]}"))  # one state's features
    lines.groupBy("state").agg(whole.alias("value")).write.partitionBy("state").text(f"{folder}/boundaries")
    addresses = line_addresses(spark, sf, _code(F.col("l_partkey") % 25), F.lit(0.1) + F.col("l_quantity") / 100, F.col("l_partkey") % 25 + 0.05 + F.col("l_linenumber") / 10)
    addresses.write.format("zipcsv").mode("overwrite").save(f"{folder}/addresses")
    return Inputs(f"{folder}/branches", f"{folder}/posts", [f"{folder}/boundaries"], f"{folder}/addresses")


_UNIT = "CAST({n} % 3 + 41 AS VARCHAR) || lpad(CAST({n} AS VARCHAR), 5, '0')"
_CEP = "lpad(CAST({k} % 101 * 1000 + {k} % 4 AS VARCHAR), 8, '0')"
_POINTS = f"""SELECT {_UNIT.format(n='c_nationkey')} mun, c_mktsegment IN ('BUILDING', 'AUTOMOBILE') bank, 'NUMERO ' || (c_custkey % 150) logr, nullif(c_custkey % 9, 0) num, {_ASKED.format(cep=_CEP.format(k='c_custkey'))} FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'HOUSEHOLD', 'MACHINERY')
UNION ALL SELECT {_UNIT.format(n='s_nationkey')}, false, 'NUMERO ' || (s_suppkey % 150), NULL, {_ASKED.format(cep=_CEP.format(k='s_suppkey'))} FROM supplier"""


@query("five_stages", f"""WITH a AS ({_ADDRESSES.format(unit=_UNIT.format(n='(l_partkey % 25)'))}), p AS ({_POINTS}), g AS (SELECT mun, bank, CASE
WHEN specific AND EXISTS (SELECT 1 FROM a WHERE a.mun = p.mun AND a.cep = p.cep AND a.num = p.num) OR EXISTS (SELECT 1 FROM a WHERE a.mun = p.mun AND a.logr = p.logr AND a.num = p.num) THEN 1
WHEN specific AND EXISTS (SELECT 1 FROM a WHERE a.mun = p.mun AND a.cep = p.cep) OR EXISTS (SELECT 1 FROM a WHERE a.mun = p.mun AND a.logr = p.logr) THEN 2
WHEN generic AND EXISTS (SELECT 1 FROM a WHERE a.mun = p.mun AND a.cep = p.cep) THEN 3 ELSE 4 END level FROM p)
SELECT u.mun municipio_ibge, CAST(count(g.mun) AS BIGINT) total_geral, CAST(count(g.mun) FILTER (WHERE bank) AS BIGINT) total_bancos, {', '.join(f"CAST(count(g.mun) FILTER (WHERE level = {k}) AS BIGINT) level_{k}" for k in (1, 2, 3, 4))}
FROM (SELECT {_UNIT.format(n='n_nationkey')} mun FROM nation) u LEFT JOIN g ON g.mun = u.mun GROUP BY u.mun""")
def five_stages(spark, sf):
    """Registers to map payload through files; totals of the aggregate and precision of the geocoded points by unit."""
    done = Pipeline(spark, Scope.parse("Sul"), stage_inputs(spark, sf), S.shared_path(spark, "five-out"))
    done.run()
    levels = ["endereço", "logradouro", "localidade", "município"]
    found = spark.read.parquet(done.path("geocoded")).groupBy("municipio_ibge").agg(*(F.count_if(F.col("precisao") == v).alias(f"level_{k}") for k, v in enumerate(levels, 1)))
    totals = spark.read.parquet(done.path("aggregate")).select("municipio_ibge", F.col("total_geral").cast("long").alias("total_geral"), F.col("total_bancos").cast("long").alias("total_bancos"))
    return totals.join(found, "municipio_ibge", "left").na.fill(0)


@query("stage_manifest", f"""WITH n AS (SELECT CAST(count(*) AS BIGINT) n FROM ({_POINTS})), u AS (SELECT CAST(count(*) AS BIGINT) n FROM nation)
SELECT k AS number, title, CASE WHEN k IN (2, 3) THEN u.n ELSE n.n END AS rows, true AS skipped FROM n, u, (VALUES (1, 'registers'), (2, 'boundaries'), (3, 'aggregate'), (4, 'geocode'), (5, 'map payload')) v(k, title)""")
def stage_manifest(spark, sf):
    """Rows that each stage left, and that a second run skips all five, since nothing has changed."""
    done = Pipeline(spark, Scope.parse("Sul"), stage_inputs(spark, sf), S.shared_path(spark, "five-out"))
    done.run()
    done.run(reuse=True)
    return done.manifest.table().select("number", "title", "rows", F.col("title").isin(done.skipped).alias("skipped"))
