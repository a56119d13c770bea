"""Sources, sinks and the five stages on small files, and the invariants of what they leave."""

import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from terracover.functions import tables
from terracover.operators import aggregate as A
from terracover.operators import checks
from terracover.operators.spatial import inside_own_unit
from terracover.plans import cli
from terracover.plans.pipeline import Inputs, Pipeline, StageFailed, run_stages
from terracover.schema import first_column, require_columns, resolve_column
from terracover.scope import Scope
from terracover.sources import files, json_files
from terracover.sources.xlsx import XlsxSource
from terracover.sources.zipcsv import ZipCsvSource

HEADERS = ["CNPJ ", "NOME  INSTITUIÇÃO", "SEGMENTO", "NOME AGÊNCIA", "ENDEREÇO", "NÚMERO", "BAIRRO", "CEP", "MUNICíPIO", "UF", "MUNICIPIO IBGE"]
BANK, COOP = "Banco Múltiplo", "Cooperativa de Crédito"
BRANCHES = [
    ["00.000.000", " BANCO DO  BRASIL S.A. ", BANK, "AG CENTRO", "R.GAL.SAMPAIO,10", None, "CENTRO", "90010-901", "Porto Alegre", "RS", "4314902"],
    ["60.746.948", "BANCO BRADESCO BBI S.A.", BANK, "AG", "X", None, None, None, "Porto Alegre", "RS", "4314902"],
    ["60.746.948", "BANCO BRADESCO S.A.", BANK, "AG SP", "X", None, None, None, "São Paulo", "SP", "3550308"],
    ["Fonte: registro", None, None, None, None, None, None, None, None, None, None],
]
POSTS = [
    ["82.639.451", "COOPERATIVA - VIACREDI", COOP, "PA 1", "AV XV DE NOVEMBRO", "5", "B", "89000-000", "Blumenau", "SC", "4202404.0"],
    ["11.111.111", "COOPERATIVA - SISPRIME", COOP, "PA 2", "RUA NENHUMA", "", "", "", "Blumenau", "SC", "4202404"],
    ["11.111.111", "COOPERATIVA X", COOP, "SICOOB PA", "RUA NENHUMA", "", "", "", "Blumenau", "SC", None],
]


def write_xlsx(path, rows, blank=9):
    def cell(k, r, v):
        return "" if v is None else f'<c r="{chr(65 + k)}{r}" t="inlineStr"><is><t xml:space="preserve">{v.replace("&", "&amp;")}</t></is></c>'

    lines = [f'<row r="{r}">' + "".join(cell(k, r, v) for k, v in enumerate(row)) + "</row>" for r, row in enumerate(rows, blank + 1)]
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData><row r="1"><c r="A1" t="inlineStr"><is><t>title</t></is></c></row>' + "".join(lines) + "</sheetData></worksheet>")


def square(x, y):
    return [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]]


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    d = tmp_path_factory.mktemp("inputs")
    write_xlsx(d / "branches.xlsx", [HEADERS, *BRANCHES])
    write_xlsx(d / "posts.xlsx", [[h.replace("AGÊNCIA", "INSTALAÇÃO") for h in HEADERS], *POSTS])
    features = [{"type": "Feature", "properties": {"codarea": c}, "geometry": {"type": t, "coordinates": g}} for c, t, g in (("4314902", "Polygon", square(-51, -30)), ("4202404", "MultiPolygon", [square(-49, -27), square(-47, -27)]), ("4200000", "Polygon", square(-45, -27)))]
    (d / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    (d / "names.json").write_text(json.dumps([{"id": 4314902, "nome": "Porto Alegre"}, {"id": 4202404, "nome": "Blumenau"}]))
    (d / "people.json").write_text(json.dumps([{"resultados": [{"series": [{"localidade": {"id": "4314902"}, "serie": {"2024": "1", "2025": "4251"}}, {"localidade": {"id": "4202404"}, "serie": {"2025": "..."}}, {"localidade": {"id": "4200000"}, "serie": {}}]}]}]))
    columns = "EXTRA;COD_MUNICIPIO;CEP;NOM_TIPO_SEGLOGR;NOM_TITULO_SEGLOGR;NOM_SEGLOGR;NUM_ENDERECO;LATITUDE;LONGITUDE"
    lines = ["x;4314902;90010901;RUA;GENERAL;SAMPAIO;10;-29.5;-50.5", "x;4314902;90010901;RUA;GENERAL;SAMPAIO;12;-29.4;-50.4", "x;4202404;89010000;AVENIDA;;QUINZE DE NOVEMBRO;5;-26.5;-48.5", "x;4202404;89010000;RUA;;OUTRA;1;;", "x;4202404;89000000;RUA;;OUTRA;1;-26.4;-48.4"]
    with zipfile.ZipFile(d / "a.zip", "w") as z:
        z.writestr("a.csv", "\n".join([columns, *lines[:2]]))
        z.writestr("b.csv", "\n".join([columns, *lines[2:]]))
    return d


@pytest.fixture(scope="module")
def done(spark, inputs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    p = Pipeline(spark, Scope.parse("Sul"), Inputs(str(inputs / "branches.xlsx"), str(inputs / "posts.xlsx"), [str(inputs / "b.geojson")], str(inputs / "a.zip"), [str(inputs / "names.json")], [str(inputs / "people.json")]), out)
    assert [t for t, _ in p.run()] == ["registers", "boundaries", "aggregate", "geocode", "map payload"]
    return p


def test_xlsx_and_zip(spark, inputs):
    spark.dataSource.register(XlsxSource)
    spark.dataSource.register(ZipCsvSource)
    rows = spark.read.format("xlsx").load(str(inputs / "branches.xlsx"))
    assert rows.columns[:2] == ["CNPJ", "NOME INSTITUIÇÃO"] and rows.count() == 4
    csv = spark.read.format("zipcsv").option("path", str(inputs)).load()
    assert csv.count() == 5 and csv.columns[0] == "COD_MUNICIPIO" and csv.rdd.getNumPartitions() == 2
    with zipfile.ZipFile(inputs / "empty.zip", "w") as z:
        z.writestr("x.txt", "")
    with pytest.raises(Exception, match="no CSV"):
        spark.read.format("zipcsv").option("path", str(inputs / "empty.zip")).load().count()
    os.remove(inputs / "empty.zip")


def test_registers(spark, done):
    rows = {r.nome_instalacao: r for r in spark.read.parquet(done.path("categorised")).collect()}
    assert {k: (r.sub_categoria, r.marca_exibicao, r.municipio_ibge) for k, r in rows.items()} == {
        "AG CENTRO": ("Banco do Brasil", "Banco do Brasil", "4314902"), "PA 1": ("Ailos", "Ailos", "4202404"),
        "PA 2": ("Outra Cooperativa", "Sisprime", "4202404"), "SICOOB PA": ("Sicoob", "Sicoob", None),
    }
    assert rows["AG CENTRO"].nome_instituicao == "BANCO DO BRASIL S.A." and rows["PA 1"]._rid > rows["AG CENTRO"]._rid


def test_aggregate(spark, done):
    units = files.read_geo(spark, done.path("aggregate"))
    rows = {r.municipio_ibge: r for r in units.collect()}
    assert (rows["4314902"].populacao, rows["4314902"].populacao_ano, rows["4314902"].municipio_nome, rows["4314902"].regiao) == (4251, "2025", "Porto Alegre", "Sul")
    assert rows["4202404"].populacao is None and rows["4202404"].outras_coops_detalhe == "Sisprime 1" and rows["4202404"].total_geral == 2
    assert rows["4200000"].total_geral == 0 and rows["4200000"].uf == "SC"
    points = spark.read.parquet(done.path("categorised"))
    assert sum(r.total_geral for r in rows.values()) == points.count() - A.unmatched(points, units).count()
    assert checks.incomplete_states(units, ["RS", "SC", "PR"]).count() == 3


def test_geocoded(spark, done):
    points = spark.read.parquet(done.path("geocoded"))
    rows = {r.nome_instalacao: r for r in points.collect()}
    assert set(rows) == {"AG CENTRO", "PA 1", "PA 2"} and "cep8" not in points.columns
    assert rows["AG CENTRO"].precisao == tables.EXACT and abs(rows["AG CENTRO"].latitude + 29.5) < 1e-5
    assert rows["PA 1"].precisao == tables.EXACT and rows["PA 2"].precisao == tables.UNIT
    units = files.read_geo(spark, done.path("aggregate"))
    assert inside_own_unit(points.drop("dentro"), units).where("not dentro").count() == 0
    assert points.where(~F.col("precisao").isin(*tables.PRECISION_LEVELS)).count() == 0


def test_reports_and_payload(spark, done):
    for name, df in done.reports().items():
        assert df.count() >= 0, name
    assert spark.read.json(done.path("map") + "/points").count() == 3
    assert spark.read.json(done.path("map") + "/uf").count() == 2
    assert not checks.is_stale(done.path("aggregate"), done.path("categorised"))


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("4314902", 298)], "municipio_ibge string, total_geral long")
    files.export(df, f"{tmp_path}/new/a.parquet")
    files.export(df, f"{tmp_path}/new/a.csv")
    assert spark.read.parquet(f"{tmp_path}/new/a.parquet").first().total_geral == 298
    assert spark.read.option("header", True).csv(f"{tmp_path}/new/a.csv").first().municipio_ibge == "4314902"
    files.write_text(f"{tmp_path}/new/x.html", "a\rb\n")
    assert files.read_text(spark, f"{tmp_path}/new/x.html").first().text == "a\rb\n"
    features = df.select(F.struct("municipio_ibge").alias("properties"), F.lit('{"type":"Point"}').alias("geometry_json"))
    files.write_features(features, f"{tmp_path}/new/f")
    assert json.loads(spark.read.text(f"{tmp_path}/new/f").first()[0])["properties"]["municipio_ibge"] == "4314902"
    with pytest.raises(ValueError):
        files.read_geo(spark, f"{tmp_path}/new/a.parquet")


def test_cached_fetch(tmp_path):
    calls, waits = [], []

    def fetch(path):
        calls.append(path)
        if len(calls) < 3:
            raise OSError("again")
        with open(path, "w") as f:
            f.write("x")

    target = str(tmp_path / "d" / "f")
    assert files.ensure_cached(target, fetch, sleep=waits.append) == target and waits == [5.0, 10.0] and os.listdir(tmp_path / "d") == ["f"]
    files.ensure_cached(target, fetch)
    assert len(calls) == 3
    with pytest.raises(ValueError):
        files.ensure_cached(str(tmp_path / "g"), fetch, valid=files.is_zip, sleep=waits.append)

    def refused(path):
        raise files.CertificateError

    with pytest.raises(files.CertificateError):
        files.ensure_cached(str(tmp_path / "h"), refused, sleep=lambda s: pytest.fail("retried"))


def test_schema_helpers(spark, inputs, tmp_path):
    assert resolve_column(["Município ", "x"], ["nope", "MUNICIPIO"]) == "Município " and first_column(["GEOCODIGO", "CD_MUN"], ["CD_MUN", "GEOCODIGO"]) == "CD_MUN"
    for f in (lambda: resolve_column(["a"], ["b"]), lambda: first_column(["a"], ["b"]), lambda: require_columns(spark.range(1), ["x"])):
        with pytest.raises(KeyError):
            f()
    assert json_files.read_unit_names(spark).count() == 0 and json_files.read_population(spark).count() == 0
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "EPSG:31982"}}, "features": [{"type": "Feature", "properties": {"CD_MUN": "1"}, "geometry": {"type": "Polygon", "coordinates": square(0, 0)}}]}))
    with pytest.raises(Exception, match="unsupported reference system"):
        json_files.read_boundaries(spark, str(tmp_path / "c.geojson")).collect()


def test_command_line(spark, inputs, tmp_path, capsys):
    args = ["--branches", str(inputs / "branches.xlsx"), "--posts", str(inputs / "posts.xlsx"), "--boundaries", str(inputs / "b.geojson"), "--addresses", str(inputs / "a.zip"), "--out", str(tmp_path)]
    assert cli.main([*args, "--ufs", "Sul"], spark) == 0
    assert cli.main([*args, "--ufs", "XX"], spark) == 2 and cli.main(["--ufs"], spark) == 2
    args[1] = str(inputs / "absent.xlsx")
    assert cli.main(args, spark) == 1 and "stage 1 (registers) failed" in capsys.readouterr().err

    def broken():
        raise KeyError("x")

    with pytest.raises(StageFailed) as e:
        run_stages([("a", lambda: None), ("b", broken)])
    assert (e.value.number, e.value.title) == (2, "b") and isinstance(e.value.__cause__, KeyError)
