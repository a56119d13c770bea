import pytest

from terracover.functions.rules import classify
from terracover.operators import checks

COOP = "Cooperativa de Crédito"
CASES = [
    ("COOPERATIVA DE CRÉDITO ... - SICOOB CREDISC", "PA CENTRO", None, COOP, "Sicoob", "Sicoob"),
    ("COOPERATIVA DOS MILITARES ESTADUAIS DE SANTA CATARINA - CREDPOM", "SICOOB PA - JOINVILLE", "04.572.960", COOP, "Sicoob", "Sicoob"),
    ("COOPERATIVA ... - SICREDI SERRANA", "SICOOB PA - QUALQUER", None, COOP, "Sicredi", "Sicredi"),
    ("COOPERATIVA ... - VIACREDI", "PA CENTRO", "82.639.451", COOP, "Ailos", "Ailos"),
    ("COOPERATIVA ... SICREDI", "PA CENTRO", "82.639.451", COOP, "Ailos", "Ailos"),
    ("SISPRIME DO BRASIL - COOPERATIVA DE CRÉDITO", "PA CENTRO", None, COOP, "Outra Cooperativa", "Sisprime"),
    ("LAR COOPERATIVA DE CRÉDITO - LAR CREDI", "PA CENTRO", None, COOP, "Outra Cooperativa", "Lar Credi"),
    ("CREDI&GENTE - COOPERATIVA DE CRÉDITO E INVESTIMENTOS", "PA CENTRO", None, COOP, "Outra Cooperativa", "Credi&Gente"),
    ("CREDISIS CREDIPLAN - COOPERATIVA", "PA CENTRO", None, COOP, "Outra Cooperativa", "Credisis"),
    ("COOPERATIVA DE CREDITO RURAL SEARA - CREDISEARA", "PA CENTRO", None, COOP, "Outra Cooperativa", "Crediseara"),
    ("COOPERATIVA DOS FUNCIONÁRIOS DE ALGO LTDA", "PAC 1", None, COOP, "Outra Cooperativa", "Outra Cooperativa"),
    ("COOPERATIVA ... SICREDI ... COOPAVEL REGIÃO", None, None, COOP, "Sicredi", "Sicredi"),
    ("BANCO DO BRASIL S.A.", "AG CENTRO", None, "Banco Múltiplo", "Banco do Brasil", "Banco do Brasil"),
]


@pytest.fixture(scope="module")
def classified(spark):
    rows = [(c or "99.999.999", i, n, s) for i, n, c, s, _, _ in CASES]
    return classify(spark.createDataFrame(rows, "cnpj string, nome_instituicao string, nome_instalacao string, segmento string")).coalesce(1)


def test_brands(classified):
    assert [(r.sub_categoria, r.marca_exibicao) for r in classified.collect()] == [(b, m) for *_, b, m in CASES]


def test_all_classified(spark, classified):
    assert checks.unclassified(classified).count() == 0
    other = classify(spark.createDataFrame([("1", "BANCO BRADESCO BBI S.A.", "x", "Banco")], "cnpj string, nome_instituicao string, nome_instalacao string, segmento string"))
    assert checks.unclassified(other).count() == 1


def test_display_differs_in_the_bucket_only(classified):
    assert classified.where("marca_exibicao <> sub_categoria and sub_categoria <> 'Outra Cooperativa'").count() == 0
    assert classified.where("upper(nome_instalacao) rlike '\\\\bSICOOB\\\\b' and sub_categoria not in ('Sicoob', 'Sicredi')").count() == 0
