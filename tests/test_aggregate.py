import pytest
from pyspark.sql import functions as F

from terracover.functions import tables
from terracover.operators import aggregate as A
from terracover.operators import analytics as N
from terracover.operators import checks as C
from terracover.operators import encode as E
from terracover.scope import Selection

COOP, BANK = tables.CATEGORY_COOPERATIVE, tables.CATEGORY_BANK


@pytest.fixture(scope="module")
def points(spark):
    rows = [("1", COOP, "Sicredi", "Sicredi")] * 3 + [("1", BANK, "Caixa", "Caixa"), ("2", COOP, "Outra Cooperativa", "Zeta"), ("2", COOP, "Outra Cooperativa", "Alfa"), ("2", COOP, "Outra Cooperativa", "Alfa"), (None, BANK, "Itaú", "Itaú"), ("9", COOP, "Nova União", "Nova União")]
    return spark.createDataFrame(rows, "municipio_ibge string, categoria_if string, sub_categoria string, marca_exibicao string")


@pytest.fixture(scope="module")
def units(spark):
    return spark.createDataFrame([("1", "RS", 10), ("2", "RS", 20), ("3", "SC", None), ("4", "SC", 40)], "municipio_ibge string, uf string, populacao long")


def test_pivot_and_join(points, units):
    counts = A.count_points(points)
    assert counts.where("municipio_ibge is null").first().pontos == 1
    wide = A.pivot_counts(counts.where("municipio_ibge is not null"))
    assert wide.columns[:4] == ["municipio_ibge", "total_geral", "total_cooperativas", "total_bancos"] and wide.columns[-1] == "total_nova_uniao"
    out = A.join_detail(A.join_dimension(units, wide), A.bucket_detail(points))
    rows = {r.municipio_ibge: r for r in out.collect()}
    assert len(rows) == 4 and (rows["1"].total_geral, rows["1"].total_sicredi, rows["1"].total_caixa) == (4, 3, 1)
    assert rows["2"].outras_coops_detalhe == "Alfa 2 · Zeta 1" and rows["3"].outras_coops_detalhe == "" and rows["3"].total_geral == 0
    assert C.unreconciled(out, "total_geral", ["total_cooperativas", "total_bancos"]).count() == 0
    assert C.unreconciled(out.withColumn("total_geral", F.lit(9)), "total_geral", ["total_cooperativas", "total_bancos"]).count() == 4
    assert out.where("(outras_coops_detalhe <> '') <> (total_outra_coop > 0)").count() == 0
    assert A.unmatched(points, units).count() == 2
    one = A.coverage_summary(out, points).first()
    assert (one.units, one.served, one.unserved, one.unserved_population, one.points_outside) == (4, 2, 2, 40, 2)
    assert {r.uf: r.unserved_pct for r in A.coverage_by(out, "uf").collect()} == {"RS": 0.0, "SC": 100.0}


def test_empty(spark, points, units):
    none = points.limit(0)
    wide = A.pivot_counts(A.count_points(none))
    assert wide.count() == 0 and A.join_dimension(units, wide).agg(F.sum("total_geral")).first()[0] == 0
    assert A.bucket_detail(none).count() == 0


def test_keys(spark):
    df = spark.createDataFrame([("1234567",), ("1234567",), ("12",), (None,)], "municipio_ibge string")
    assert C.duplicate_keys(df, "municipio_ibge").first().n == 2
    bad = C.bad_codes(df).first()
    assert bad.n == 2 and bad.examples == ["12"]
    assert C.excess_unmatched(df, df.limit(2)).count() == 1 and C.excess_unmatched(df, df.limit(3)).count() == 0


@pytest.mark.parametrize(("totals", "cuts"), [([0, 1, 2, 2, 3, 0], [1, 2, 3]), ([1] * 6 + [2, 3, 4, 5, 9, 65], [1, 3, 5, 12, 28]), ([0, 0], []), ([], []), ([7], [7]), (list(range(1, 101)), [1, 21, 41, 61, 81])])
def test_breaks(spark, totals, cuts):
    df = spark.createDataFrame([(t,) for t in totals], "total long")
    assert N.class_breaks(df).first().cuts == cuts


def test_classes_and_legend(spark):
    df = spark.createDataFrame([(t,) for t in (0, 1, 4, 28, 65)], "total long")
    cuts = spark.createDataFrame([([1, 3, 5, 12, 28],)], "cuts array<long>")
    assert sorted(r[0] for r in df.crossJoin(cuts).select(N.class_of(F.col("total"), F.col("cuts"))).collect()) == [-1, 0, 1, 4, 4]
    legend = {r["class"]: (r.label, r.n) for r in N.legend(df, cuts).collect()}
    assert legend == {-1: ("0", 1), 0: ("1–2", 1), 1: ("3–4", 1), 2: ("5–11", 0), 3: ("12–27", 0), 4: ("28+", 2)}


def test_kpis_and_ranking(spark):
    df = spark.createDataFrame([("b", 3, 10), ("a", 0, 20), ("c", 0, None)], "municipio_ibge string, total long, populacao long")
    k = N.kpis(df).first()
    assert (k.points, k.served, k.served_pct, k.unserved, k.unserved_pct, k.unserved_population, k.without_population) == (3, 1, 33, 2, 67, 20, 1)
    tied = spark.createDataFrame([("b", 5), ("a", 5), ("z", 0), ("y", 100)], "municipio_ibge string, total long")
    assert [(r.municipio_ibge, r.width) for r in N.ranking(tied).orderBy("place").collect()] == [("y", 100), ("a", 5), ("b", 5)]


def test_search(spark):
    df = spark.createDataFrame([("1", "São X"), ("2", "Bom Sao"), ("3", "sao A"), ("4", "Zeta")], "municipio_ibge string, municipio_nome string")
    assert [r.municipio_nome for r in N.search(df, " SÃO").orderBy("place").collect()] == ["sao A", "São X", "Bom Sao"]
    assert N.search(df, "s").count() == 0
    states = spark.createDataFrame([(uf, n, k) for k, (uf, n) in enumerate(tables.STATE_NAMES.items())], "uf string, nome string, ordem int")
    assert [r.uf for r in N.search_states(states, "rio").collect()] == ["RN", "RJ", "RS"] and N.search_states(states, "").count() == 27


def test_selection_answers(spark, points, units):
    aggregate = A.join_dimension(units, A.pivot_counts(A.count_points(points)))
    answer = N.coverage(aggregate, Selection.all({COOP: ["Sicredi"], BANK: ["Caixa"]}))
    assert answer.kpis.first().points == 4 and answer.ranking.count() == 1 and answer.breaks.first().cuts == [4]


def test_encoding(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a"), (2, "b"), (3, "c"), (4, None)], "_pos long, v string")
    assert {r.value: r.code for r in E.dictionary(df, "v").collect()} == {"b": 0, "a": 1, "c": 2, "": 3}
    rows = spark.createDataFrame([(9, "A", "s", 1.23456789, 2.0), (1, "B", "s", 0.0, 0.0), (3, "A", None, 0.0, 0.0), (2, "Q", "t", 0.0, 0.0)], "_rid long, sub_categoria string, v string, latitude double, longitude double")
    order = E.emission_order(rows, ["B", "A"])
    assert [r._rid for r in order.orderBy("_pos").collect()] == [1, 3, 9, 2]
    out, dictionaries = E.encode(order, ["v"], ["sub_categoria"])
    assert out.where("_pos = 2").first().latitude == 1.2345679 and dictionaries["v"].count() == 3


def test_levels(spark):
    df = spark.createDataFrame([("a",), ("a",), ("c",), ("x",)], "level string")
    assert [(r.level, r.n, r.running, r.running_pct) for r in A.cumulative_levels(df, "level", ["a", "b", "c"]).collect()] == [("a", 2, 2, 66.7), ("b", 0, 2, 66.7), ("c", 1, 3, 100.0)]


def test_territory_labels(spark):
    def labels(states, **kw):
        return tuple(A.territory_labels(spark.createDataFrame([(s,) for s in states], "uf string"), **kw).first())

    line = "Agências e postos de atendimento nos {} municípios {}."
    south = ["PR", "SC", "RS"]
    assert labels([*south, "RS", None]) == ("Região Sul", line.format(5, "da Região Sul"))
    assert labels([*tables.STATE_CODES] * 50) == ("Brasil", line.format("1.350", "do Brasil"))
    assert labels(["RS", "PR", "AC", "ZZ", "XX"]) == ("5 UFs", line.format(5, "de AC, PR, RS, XX, ZZ"))
    assert labels(["PR", "RS", "AC"], first=("RS", "SC", "PR")) == ("3 UFs", line.format(3, "de RS, PR, AC"))
    assert labels([]) == ("0 UFs", line.format(0, "de "))
