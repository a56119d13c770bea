"""Numbers, medians and GeoParquet files against plain Python and foreign files."""

import json
import random
import statistics
import struct

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terracover.operators import geocode as G
from terracover.operators import numbering
from terracover.operators import spatial as P
from terracover.operators.numbering import medians, numbered
from terracover.sources import files
from terracover.sources.geoparquet import CRS84


def test_numbered(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "a", "a", "b", None, "c"]), r.choice([None, 0.0, -0.0, 1.5]), r.randint(0, 40), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, h double, v int, id int").repartition(7)
    got = {x["id"]: (x["p"], x["n"]) for x in numbered(df, ["v", "id"], ["g", "h"], "p", "n").collect()}
    for group in {(x[0], x[1]) for x in rows}:
        own = sorted((x[2], x[3]) for x in rows if (x[0], x[1]) == group)
        assert [got[i] for _, i in own] == [(k, len(own)) for k in range(len(own))]
    whole = {x["id"]: x["_pos"] for x in numbered(df, ["v", "id"]).collect()}
    assert [whole[i] for _, i in sorted((x[2], x[3]) for x in rows)] == list(range(3000))
    ties = numbered(df, ["v"]).select("_pos").collect()
    assert sorted(x[0] for x in ties) == list(range(3000))
    assert numbered(df.limit(0), ["v"], ["g"]).count() == 0


def test_a_hot_group_is_numbered_by_many_tasks(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(numbering, "stored", lambda df, name: kept.append(files.stored(df, name)) or kept[-1])
    df = spark.range(200_000).select("id", F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") / 7 + 2).alias("x"), F.lit(2.0).alias("y"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = numbered(df, ["id"], ["x", "y"], "_i", "_n")
        assert rows.where("_n > 1").groupBy("_n").agg(F.max("_i").alias("m"), F.countDistinct("_i").alias("d")).collect() == [(66_667, 66_666, 66_667)]
        assert kept[0].where("x = 1").select(F.shiftright("_at", 33)).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_medians_of_hot_keys(spark):
    r = random.Random(5)
    rows = [(r.choice(["h", "h", "h", "a", "b"]), r.choice(["k", "l"]), None if r.random() < 0.1 else float(np.float32(r.uniform(-9, 9))), float(r.randint(0, 9))) for _ in range(4000)] + [("one", "k", 1.0, None), ("two", "k", 1.0, 2.0), ("two", "k", 2.0, 2.0), (None, "k", 5.0, 5.0)]
    df = spark.createDataFrame(rows, "mun string, chave string, lat float, lon float").repartition(5)
    want = {}
    for key in {x[:2] for x in rows if x[0]}:
        own = [x for x in rows if x[:2] == key]
        want[key] = tuple(None if not v else float(np.float32(statistics.median(v))) for v in ([x[k] for x in own if x[k] is not None] for k in (2, 3)))
    for hot_rows in (0, 500, 10**6):
        got = {(x["mun"], x["chave"]): (x["lat"], x["lon"]) for x in G.consolidate(df, "mun", "chave", hot_rows=hot_rows).collect()}
        assert got == want
    assert medians(df.limit(0), ["mun"], ["lat"]).count() == 0


def test_fan_out_with_nulls_and_a_hot_place(spark):
    df = spark.range(5000).select(F.col("id").alias("_rid"), F.when(F.col("id") % 2 == 0, -30.0).alias("latitude"), F.when(F.col("id") % 2 == 0, -51.0).alias("longitude"), F.lit("endereço").alias("precisao"))
    rows = P.fan_out(df)
    assert rows.where("latitude IS NULL AND lat_nova IS NULL").count() == 2500
    first = rows.where("_rid = 0").first()
    assert (first.lat_nova, first.lon_nova) == (-30.0, -51.0) and rows.where("latitude = -30").select("lat_nova", "lon_nova").distinct().count() == 2500


GEOMETRY = "struct<type:string, rings:array<struct<part:int, ring:int, pts:array<struct<x:double,y:double>>>>>"
RING = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)]


def test_geoparquet_footers(spark, tmp_path):
    rows = [("1", ("Polygon", [(0, 0, RING)])), ("2", ("MultiPolygon", [(0, 0, RING), (1, 0, RING)])), ("3", None)]
    df = spark.createDataFrame(rows, f"municipio_ibge string, geometry {GEOMETRY}").repartition(3)
    path = f"{tmp_path}/own"
    for _ in range(2):  # overwritten
        files.write_geo(df, path)
    parts = sorted(p for p in (tmp_path / "own").iterdir() if p.suffix == ".parquet")
    assert not (tmp_path / "own" / "_temporary").exists() and (tmp_path / "own" / "_SUCCESS").exists() and parts
    kinds = set()
    for p in parts:
        geo = json.loads(pq.read_metadata(p).metadata[b"geo"])
        assert geo["primary_column"] == "geometry" and geo["columns"]["geometry"]["encoding"] == "WKB" and geo["columns"]["geometry"]["crs"]["id"]["code"] == "CRS84"
        kinds |= set(geo["columns"]["geometry"]["geometry_types"])
    assert kinds == {"Polygon", "MultiPolygon"}
    assert sorted(map(str, files.read_geo(spark, path).collect())) == sorted(map(str, df.collect()))
    files.write_geo(df.limit(0), f"{tmp_path}/none")
    assert files.read_geo(spark, f"{tmp_path}/none", ["municipio_ibge"]).count() == 0


def foreign(path, geo, column="geom"):
    wkb = struct.pack(">BII", 0, 3, 1) + struct.pack(">I", len(RING)) + b"".join(struct.pack(">dd", *p) for p in RING)
    table = pa.table({"code": ["7"], column: pa.array([wkb], pa.binary())})
    if geo is not None:
        table = table.replace_schema_metadata({"geo": json.dumps(geo)})
    path.parent.mkdir(exist_ok=True)
    pq.write_table(table, path)


def declared(**own):
    return {"version": "1.0.0", "primary_column": "geom", "columns": {"geom": {"encoding": "WKB", "geometry_types": ["Polygon"]} | own}}


def test_geoparquet_of_other_writers(spark, tmp_path):
    for name, own in (("epsg", {"crs": CRS84 | {"id": {"authority": "EPSG", "code": 4326}}}), ("left-out", {})):
        foreign(tmp_path / name / "a.parquet", declared(**own))
        row = files.read_geo(spark, f"{tmp_path}/{name}", ["code"]).first()
        assert row.code == "7" and row.geometry.type == "Polygon" and [tuple(p) for p in row.geometry.rings[0].pts] == RING
    bad = {"plain": (None, "declares no geometry"), "null": (declared(crs=None), "no reference system"), "metres": (declared(crs={"id": {"authority": "EPSG", "code": 31982}}), "unsupported reference system"), "arrow": (declared(encoding="polygon"), "unsupported encoding")}
    for name, (geo, message) in bad.items():
        foreign(tmp_path / name / "a.parquet", geo)
        with pytest.raises(ValueError, match=message):
            files.read_geo(spark, f"{tmp_path}/{name}")
    foreign(tmp_path / "epsg" / "b.parquet", None)  # one file of several lacks the key
    with pytest.raises(ValueError, match="declares no geometry"):
        files.read_geo(spark, f"{tmp_path}/epsg")
    with pytest.raises(KeyError):
        files.read_geo(spark, f"{tmp_path}/left-out", ["absent"])


def test_a_failed_write_commits_nothing(spark, tmp_path):
    df = spark.range(8).repartition(4).select(F.when(F.col("id") == 5, F.raise_error(F.lit("stop"))).otherwise(F.col("id").cast("string")).alias("municipio_ibge"), F.lit(None).cast(GEOMETRY).alias("geometry"))
    with pytest.raises(Exception, match="stop"):
        files.write_geo(df, f"{tmp_path}/failed")
    left = [p for p in (tmp_path / "failed").iterdir() if p.name != "_temporary"] if (tmp_path / "failed").exists() else []
    assert left == []  # tasks that were still running may leave a file there, which no reader looks at
