"""Cases that only larger tables or other settings bring about."""

import itertools
import zipfile

import duckdb
from pyspark.sql import functions as F

from terracover.functions import text as X
from terracover.operators import geocode as G
from terracover.plans import queries as Q
from terracover.plans import registry
from terracover.schema import ADDRESS_COLUMNS
from terracover.sources.fetch import fetch
from terracover.sources.zipcsv import ZipCsvReader, ZipCsvSource, read_addresses


def test_seven_digit_part_keys_are_bad_codes(spark, tmp_path):
    spark.createDataFrame([(k,) for k in (7, 10, 99, 100, 1_234_567)], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    assert [r["n"] for r in Q.bad_codes(spark, str(tmp_path)).collect()] == [3]


def test_brand_lines_with_plain_numbers(spark):
    one = lambda **more: spark.range(1).select(X.brand_lines({"A": F.lit(12_345), "B": F.lit(0)}, "B", **more)).first()[0]
    assert one(shown_as=lambda n: n.cast("string")) == "A: 12345" and one() == "A: 12.345"


def test_fetch_from_a_plain_path(tmp_path):
    (tmp_path / "A B.json").write_text('{"type":"FeatureCollection","features":[{}]}')
    found = fetch(f"{tmp_path}/A B.json", f"{tmp_path}/out/a.geojson", "features", tries=1)
    assert found["status"] == "fetched" and (tmp_path / "out/a.geojson").read_bytes() == (tmp_path / "A B.json").read_bytes()
    assert fetch(f"{tmp_path}/none.json", f"{tmp_path}/out/b.geojson", tries=1)["status"] == "failed"


def test_compact_numbers_round_the_exact_value(spark):
    k = [*range(1_050_000, 60_000_000, 100_000), 2_650_000, 1_234_550_000_000, 1_049_999, 999_950_001]
    found = spark.createDataFrame([(v,) for v in k], "v long").select("v", X.compact_br(F.col("v")).alias("t")).collect()
    assert [r["t"] for r in found] == [f"{v / 1e6:.1f}".replace(".", ",") + " mi" for v in k]


def test_address_files_are_read_once(spark, tmp_path):
    spark.dataSource.register(ZipCsvSource)
    rows = [("4200001", "90000001", "RUA", "", f"AV. {k % 3}", str(k % 2), str(k / 8), str(-k)) for k in range(20)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ADDRESS_COLUMNS)).coalesce(1).write.format("zipcsv").mode("overwrite").save(f"{tmp_path}/a")
    raw = read_addresses(spark, f"{tmp_path}/a", counts=f"{tmp_path}/counts")
    asked = G.address_keys(spark.createDataFrame([("4200001", "90000001", "Rua Av. 1, 1", None)], "municipio_ibge string, cep string, endereco string, numero string"))
    found = G.locate(asked, G.build_index(asked, G.reference_addresses(raw))).collect()
    assert [(r["latitude"], r["longitude"], r["precisao"]) for r in found] == [(1.25, -10.0, "endereço")]
    assert len(list((tmp_path / "counts").glob("*.json"))) == 1


def test_medians_of_sparse_and_null_coordinates(spark):
    nan = float("nan")
    rows = [(1, 1.0, None), (1, 2.0, 5.0), (1, 4.0, 7.0), (2, None, None), (3, 1.0, nan), (3, 8.0, 2.0), (3, 3.0, 1.0)]
    df = spark.createDataFrame(rows, "k int, lat float, lon float")
    assert sorted(map(tuple, G.consolidate(df, "k").collect())) == [(1, 2.0, 6.0), (2, None, None), (3, 3.0, 2.0)]
    assert G.hot_keys(df, ["k"], 3) is None and [r["k"] for r in G.hot_keys(df.where("k <> 3"), ["k"], 2).collect()] == [1]


def odd_lines(spark, path):
    """Line items that meet in every rule, some with null keys, amounts or both."""
    rows = [(o, p, s, n, q, d) for o, (p, s, n, q, d) in enumerate(itertools.product((1, 2, None), (5, 6, None), (1, 2, None), (1.0, 9.0, None), (0.05, None)))]
    rows += [(1000 + k, 3, 1000 + k, 1, float(k), None if k < 4 else k / 100) for k in range(8)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double").write.parquet(f"{path}/lineitem.parquet")


def test_lookup_cascade_of_odd_lines_equals_sql(spark, tmp_path):
    odd_lines(spark, tmp_path)
    found = map(tuple, Q.lookup_cascade(spark, str(tmp_path)).collect())
    db = duckdb.connect()
    db.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    assert sorted(found, key=str) == sorted(db.execute(registry.ORACLE_SQL["lookup_cascade"]).fetchall(), key=str)


def test_lookup_cascade_deals_and_sorts_its_rows_once(spark, tmp_path):
    odd_lines(spark, tmp_path)
    plan = Q.lookup_cascade(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert [plan.count(step) for step in ("Exchange hashpartitioning(", "+- Sort ", "Join ")] == [1, 1, 0]


def test_nested_cascade_of_units_of_many_rows(spark):
    nan = float("nan")
    rows = [(u, c, float(k % 3), float(k), None if k % 4 else float(-k)) for u in (1, 2, None) for c in ("a", "b", None) for k in range(u or 2)]
    rows += [(9, f"c{k % 7}", float(k % 5), float(k % 11), nan if k % 6 == 0 else float(k % 13)) for k in range(60)]
    known = spark.createDataFrame(rows, "mun int, chave string, num double, lat float, lon float")
    points = spark.createDataFrame([(u, c, n) for u in (1, 2, 9, 10, None) for c in ("a", "c1", "c6", None) for n in (-0.0, 1.0, 7.0, None)], "u int, c string, n double")
    asked, rules = {"mun": F.col("u"), "chave": F.col("c"), "num": F.col("n")}, [("exact", 3), ("street", 2), ("locality", 1)]
    index = [(level, G.consolidate(known, *list(asked)[:depth]), list(asked.values())[:depth]) for level, depth in rules]
    expected = sorted(map(str, G.cascade(points, index).collect()))
    for hot_rows in (100_000, 24):
        assert sorted(map(str, G.nested_cascade(points, known, asked, rules, hot_rows=hot_rows).collect())) == expected


def test_zipped_lines_longer_than_a_block(tmp_path):
    lines = [f"{k};{'x' * (3 << 20 if k == 30_000 else 40)}" for k in range(60_000)]
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.csv", "\n".join(["k;v", *lines]))
    reader = ZipCsvReader([f"{tmp_path}/a.zip"], ["k", "v"], ";", None)
    batches = list(reader.read(reader.partitions()[0]))
    assert [f"{k};{v}" for b in batches for k, v in zip(*(c.to_pylist() for c in b.columns), strict=True)] == lines
    assert max(b.num_rows for b in batches[:1]) < 40_000  # blocks of 1 MB while lines are short
