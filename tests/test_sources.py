"""Workbooks, zipped CSV and the manifest: round trips, ranges, pushed filters, reruns."""

import io
import json
import os
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from terracover.plans.manifest import Manifest, Store, is_stale
from terracover.plans.pipeline import StageFailed
from terracover.sources import xlsx
from terracover.sources.xlsx import XlsxSource
from terracover.sources.zipcsv import ZipCsvSource, read_addresses

AWKWARD = [None, "", " a  b ", "é<&>\"'", "line\nbreak", "1.0", "中文👍", ";", "x" * 3000, "null", "NA"]


def test_workbook_round_trip(spark, tmp_path, monkeypatch):
    spark.dataSource.register(XlsxSource)
    r = random.Random(2)
    rows = [(str(k), r.choice(AWKWARD), r.choice(AWKWARD)) for k in range(3001)]
    df = spark.createDataFrame(rows, "`Código  A` string, b string, `c&d` string").repartition(3)
    for lines in (9, 0):
        path = f"{tmp_path}/w{lines}"
        df.write.format("xlsx").option("headerRow", lines).mode("overwrite").save(path)
        out = spark.read.format("xlsx").option("headerRow", lines).option("rows", 97).load(path)
        assert out.columns == ["Código A", "b", "c&d", "_rid"] and out.rdd.getNumPartitions() > 10
        assert sorted(map(str, out.drop("_rid").collect())) == sorted(map(str, df.toDF("Código A", "b", "c&d").collect()))
        assert out.select("_rid").distinct().count() == 3001
        books = [p for p in os.listdir(path) if p.endswith(".xlsx")]
        assert len(books) == 3 and all(zipfile.ZipFile(f"{path}/{p}").testzip() is None for p in books)
    one = spark.read.format("xlsx").option("headerRow", 0).option("rows", 10).load(f"{tmp_path}/w0/{books[0]}")
    rid = [x["_rid"] for x in one.orderBy("_rid").collect()]
    assert rid == list(range(len(rid)))
    df.limit(0).write.format("xlsx").mode("overwrite").save(f"{tmp_path}/none")
    assert spark.read.format("xlsx").load(f"{tmp_path}/none").count() == 0
    os.mkdir(tmp_path / "nothing")
    with pytest.raises(Exception, match="holds no workbook"):
        spark.read.format("xlsx").load(f"{tmp_path}/nothing").count()


def test_workbook_of_another_writer(spark, tmp_path, monkeypatch):
    spark.dataSource.register(XlsxSource)
    strings = "".join(f"<x:si><x:r><x:t>s{k}</x:t></x:r><x:r><x:t>!</x:t></x:r></x:si>" for k in range(500))
    rows = ['<x:row r="10"><x:c r="A10" t="s"><x:v>0</x:v></x:c><x:c r="C10" t="inlineStr"><x:is><x:t>third</x:t></x:is></x:c></x:row>']
    for k in range(11, 600):  # sparse cells, blank rows, numbers, shared strings
        rows.append("" if k % 7 == 0 else f'<x:row r="{k}" spans="1:3"/>' if k % 11 == 0 else f'<x:row r="{k}" spans="1:3"><x:c r="A{k}"><x:v>{k}.5</x:v></x:c><x:c r="C{k}" t="s"><x:v>{k % 500}</x:v></x:c></x:row>')
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/sharedStrings.xml", f'<x:sst xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{strings}</x:sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<x:worksheet xmlns:x="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><x:cols/><x:sheetData>{"".join(rows)}</x:sheetData><x:pageMargins/></x:worksheet>')
    want = [(f"{k}.5", None, f"s{k % 500}!", k - 11) for k in range(11, 600) if k % 7 and k % 11]
    for step in (64, 1 << 20):
        monkeypatch.setattr(xlsx, "STEP", step)
        for every in (1, 50, 20_000):
            out = xlsx.XlsxReader([str(tmp_path / "a.xlsx")], 9, 0, every, 3)
            assert [row for p in out.partitions() for row in out.read(p)] == want
    monkeypatch.undo()
    df = spark.read.format("xlsx").option("rows", 60).load(str(tmp_path / "a.xlsx"))
    assert df.columns == ["s0!", "_c1", "third", "_rid"] and [tuple(x) for x in df.orderBy("_rid").collect()] == want


def test_zipped_csv_round_trip_and_pushdown(spark, tmp_path):
    spark.dataSource.register(ZipCsvSource)
    r = random.Random(3)
    rows = [(str(k), r.choice(["1", "2", "3", None]), r.choice(AWKWARD)) for k in range(2000)]
    df = spark.createDataFrame(rows, "id string, unit string, t string").repartition(4)
    df.write.format("zipcsv").mode("overwrite").save(f"{tmp_path}/z")
    back = read_addresses(spark, f"{tmp_path}/z", columns="id,t,unit")
    blank = df.select("id", F.expr("nullif(t, '') t"), "unit")  # empty text reads as null
    assert sorted(map(str, back.collect())) == sorted(map(str, blank.collect()))
    tests = {
        "unit IN ('1', '3')": True, "unit = '2' AND t IS NOT NULL": True, "t LIKE 'x%'": True, "unit IS NULL": True, "NOT (t IS NULL)": True,
        "unit <> '1'": False, "unit <=> '1'": False, "length(t) > 4": False, "unit = '1' OR t = '1.0'": False, "unit NOT IN ('1', '2')": False, "unit = '9'": True,
    }
    for k, (rule, pushed) in enumerate(tests.items()):
        counts = f"{tmp_path}/counts{k}"
        own = read_addresses(spark, f"{tmp_path}/z", columns="id,t,unit", counts=counts).where(rule)
        assert sorted(map(str, own.collect())) == sorted(map(str, blank.where(rule).collect())), rule
        read, kept = spark.read.schema("read long, kept long").json(counts).agg(F.sum("read"), F.sum("kept")).first()
        assert read == 2000
        match = blank.where(rule).count()
        assert kept == match if pushed else match <= kept <= 2000, rule
    plan = read_addresses(spark, f"{tmp_path}/z", columns="id,t,unit").where("unit = '2'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("PushedFilters", "").replace("RuntimeFilters", "")  # the scan alone decides it
    df.limit(0).write.format("zipcsv").mode("overwrite").save(f"{tmp_path}/none")
    assert read_addresses(spark, f"{tmp_path}/none", columns="id,t,unit").count() == 0


def test_manifest(spark, tmp_path):
    m = Manifest(spark, f"file://{tmp_path}/m")
    source, made = f"file://{tmp_path}/in.txt", f"file://{tmp_path}/out"
    (tmp_path / "in.txt").write_text("1")
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "part-0").write_text("2")
    assert not m.fresh(1, [source], [made])
    m.end(1, "a", 1.5, [source], [made], 7)
    assert m.fresh(1, [source], [made]) and not m.fresh(2, [source], [made]) and not m.fresh(1, [source], [])
    assert [tuple(x) for x in m.table().collect()] == [(1, "a", 1.5, 7)]
    (tmp_path / "in.txt").write_text("changed")
    assert not m.fresh(1, [source], [made])
    m.end(1, "a", 1.5, [source], [made], 7)
    os.utime(tmp_path / "out" / "part-0", (1, 1))  # older than its source
    m.end(1, "a", 1.5, [source], [made], 7)
    assert not m.fresh(1, [source], [made]) and is_stale(spark, made, source) and not is_stale(spark, source, made)
    os.remove(tmp_path / "out" / "part-0")
    assert not m.fresh(1, [source], [made])
    m.begin(1)
    assert Store(spark).get(f"file://{tmp_path}/m/stage-1.json") is None and is_stale(spark, f"file://{tmp_path}/absent", source)
    assert sorted(p for p in os.listdir(tmp_path / "m") if not p.endswith(".crc")) == []


def test_reuse_runs_what_has_changed(spark, tmp_path):
    from terracover.plans.pipeline import Pipeline

    ran = []

    class Small(Pipeline):
        def __init__(self):
            self.spark, self.manifest = spark, Manifest(spark, f"{tmp_path}/m")

        def stages(self):
            def write(name, text):
                ran.append(name)
                if text == "fail":
                    raise ValueError(text)
                spark.range(3).write.mode("overwrite").parquet(f"{tmp_path}/{name}")

            return [("a", lambda: write("a", ""), [f"{tmp_path}/src"], [f"{tmp_path}/a"]), ("b", lambda: write("b", (tmp_path / "src").read_text()), [f"{tmp_path}/a"], [f"{tmp_path}/b"])]

    (tmp_path / "src").write_text("x")
    p = Small()
    assert [t for t, _ in p.run()] == ["a", "b"] and ran == ["a", "b"] and p.skipped == []
    p.run(reuse=True)
    assert ran == ["a", "b"] and p.skipped == ["a", "b"]
    (tmp_path / "src").write_text("fail")
    with pytest.raises(StageFailed) as e:
        p.run(reuse=True)
    assert e.value.number == 2 and ran == ["a", "b", "a", "b"]
    (tmp_path / "src").write_text("y")
    p.run(reuse=True)
    assert ran[4:] == ["a", "b"] and json.loads(Store(spark).get(f"{tmp_path}/m/stage-2.json"))["rows"] == 3


def test_forward_only_zip():
    raw = io.BytesIO()
    with zipfile.ZipFile(xlsx._Forward(raw), "w", zipfile.ZIP_DEFLATED) as z, z.open("a", "w") as f:
        f.write(b"text")
    assert zipfile.ZipFile(io.BytesIO(raw.getvalue())).read("a") == b"text"
