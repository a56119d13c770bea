import pytest
from pyspark.sql import functions as F

from terracover.functions import text as X
from terracover.functions.html import absolute_css, declare_language, inline, remaining
from terracover.operators.geocode import address_keys


def values(spark, f, inputs):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(inputs)], "k int, x string")
    return [r[0] for r in df.select("k", f(F.col("x")).alias("y")).orderBy("k").select("y").collect()]


@pytest.mark.parametrize(("left", "right"), [
    ("R.GAL.SAMPAIO", "RUA GENERAL SAMPAIO"), ("R CONS. LAURINDO", "RUA CONSELHEIRO LAURINDO"), ("PCA.QUINZE DE NOVEMBRO", "PRAÇA QUINZE DE NOVEMBRO"),
    ("AV XV DE NOVEMBRO", "AVENIDA QUINZE DE NOVEMBRO"), ("AVENIDA DA VINDIMA", "AVENIDA VINDIMA"), ("RUA GETULIO VARGAS", "AVENIDA GETÚLIO VARGAS"),
])
def test_equal_street_keys(spark, left, right):
    a, b = values(spark, X.street_key, [left, right])
    assert a == b != ""


def test_street_keys(spark):
    x, ten, v, five, pedro, paulo, none, empty, xxi, square = values(spark, X.street_key, ["RUA X", "RUA DEZ", "RUA V", "AVENIDA CINCO", "RUA SAO PEDRO", "RUA SAO PAULO", None, "", "RUA XXI DE ABRIL", "RUA DA PRACA"])
    assert x != ten and v != five and pedro != paulo and none == empty == ""
    assert xxi == "VINTE UM ABRIL" and square == "PRACA"


def test_fold_and_names(spark):
    assert values(spark, X.fold, ["Bagé", "ßø", None, "é"]) == ["BAGE", "SSØ", None, "E"]
    assert values(spark, X.transliterate, [" Bagé ", "Straße Øst", "Passo Fundo"]) == ["BAGE", "STRASSE OST", "PASSO FUNDO"]
    assert [X.snake_case(c) for c in ("Município", "Nome do Campus")] == ["municipio", "nome_do_campus"]
    assert values(spark, X.squeeze, ["  a  b\t", None]) == ["a b", None]


def test_codes(spark):
    assert values(spark, X.unit_code, [" 123.0 ", "", None, "12345678", "4314902"]) == ["0000123", None, None, "12345678", "4314902"]
    assert values(spark, X.id_root, ["82.639.451/0001-38", "82.639.451", "1", None]) == ["82639451", "82639451", None, None]
    assert values(spark, X.series_value, ["4251", "-", "..", "X", None, " 7 "]) == [4251, None, None, None, None, 7]


def test_numbers(spark):
    assert values(spark, lambda x: X.number_br(x.cast("double")), ["1234567.9", "-1500", "12"]) == ["1.234.567", "-1.500", "12"]
    assert values(spark, lambda x: X.compact_br(x.cast("long")), ["1412883", "12500", "9999"]) == ["1,4 mi", "13 mil", "9.999"]
    assert values(spark, lambda x: X.population_text(x.cast("long"), F.lit("2025")), ["1234567", None]) == ["1.234.567 hab. (2025)", "dado indisponível"]


def test_display(spark):
    row = spark.range(1).select(
        X.display_address(F.lit("RUA A,185"), F.lit("185"), F.lit(""), F.lit(None).cast("string")).alias("a"),
        X.display_address(F.lit("RUA A"), F.lit("18.5"), F.lit("C"), F.lit("1")).alias("b"),
        X.tooltip(F.lit("Sisprime"), F.lit("Outra"), F.lit("PA"), F.lit("<x>")).alias("c"),
        X.html_escape(F.lit("<a href='b'>&\"")).alias("d"),
        X.resource_name(F.lit("https://cdn.ex/dist/x.css?v=1")).alias("e"),
    ).first()
    assert row.a == "RUA A,185" and row.b == "RUA A, 18.5 — C, 1" and row.c == "Sisprime (Outra) · PA\n&lt;x&gt;"
    assert row.d == "&lt;a href=&#39;b&#39;&gt;&amp;&quot;" and row.e == "cdn.ex_dist_x.css_v_1"


def test_address_split(spark):
    rows = [("ROD.SC-401,KM 5,4756", "", "88050-000", "4205407"), ("R.URUGUAI,185", "", "90010-901", "4314902"), ("AV BRASIL,0", "0", "99999-000", "4314902"), (None, None, None, None), ("ROD X,KM 3", "12", "00000000", "1")]
    out = address_keys(spark.createDataFrame(rows, "endereco string, numero string, cep string, municipio_ibge string").coalesce(1)).collect()
    assert [r.numero_imovel for r in out] == [None, 185, None, None, 12]
    assert [r.cep8 for r in out] == ["88050000", "90010901", "99999000", "", ""] and [r.cep_generico for r in out] == [True, False, True, False, False]


def test_html(spark):
    css = "a{b:url(images/l.png)}c{d:url(../w/f.woff2)}e{f:url(\"images/m.png\")}g{h:url(data:x)}i{j:url(#default#VML)}k{l:url(//z/q)}"
    out = absolute_css(css, "https://cdn.ex/dist/x.css")
    assert "https://cdn.ex/dist/images/l.png" in out and "https://cdn.ex/w/f.woff2" in out and '"https://cdn.ex/dist/images/m.png"' in out
    assert "url(data:x)" in out and "url(#default#VML)" in out and "url(//z/q)" in out
    page = '<html>\r<head><script src="https://c/x.js"></script><link rel="stylesheet" href="https://c/x.css"><link rel="icon" href="https://c/i.ico"></head>{z}/{x}</html>'
    pages = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    resources = spark.createDataFrame([("https://c/x.js", "f('</script>')"), ("https://c/x.css", "a{}")], "url string, body string")
    one = inline(pages, resources).where("page_id = 1")
    row = one.select("html", "scripts", "stylesheets", F.size(remaining(F.col("html"))).alias("left"), declare_language(F.col("html")).alias("l"), declare_language(declare_language(F.col("html"))).alias("ll")).first()
    assert (row.scripts, row.stylesheets, row.left) == (1, 1, 0) and "https://c/i.ico" in row.html and "{z}/{x}" in row.html and "\r" in row.html
    assert "<\\/script>')" in row.html and row.l.startswith('<html lang="pt-BR">') and row.l == row.ll


def test_sql_names(spark):
    from terracover.functions.register import register

    assert len(register(spark)) == 9
    row = spark.sql("SELECT fold_text('Bagé') a, squeeze_text(' a  b ') b, digits_of('1.2') c, zero_fill('12345678', 7) d, zero_fill('1', 3) e, number_br(1234.5) f, interior_point(array(named_struct('part', 0, 'ring', 0, 'pts', array(named_struct('x', 0d, 'y', 0d), named_struct('x', 2d, 'y', 0d), named_struct('x', 2d, 'y', 2d))))) g").first()
    assert tuple(row)[:6] == ("BAGE", "a b", "12", "12345678", "001", "1.234") and row.g.y == 1.0
