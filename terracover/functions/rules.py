"""Ordered rules, first match wins (W7), and the three classifications built from them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables
from .text import fold, id_root, lookup


def first_match(rules: Iterable[tuple[str, Column]], default: Column) -> Column:
    """The label of the first rule whose condition holds (a null condition does not)."""
    return F.coalesce(*(F.when(condition, F.lit(label)) for label, condition in rules), default)


def pattern_rules(x: Column, rules: Iterable[tuple[str, str]]) -> list[tuple[str, Column]]:
    return [(label, x.rlike(pattern)) for label, pattern in rules]


def category(segment: Column, institution: Column) -> Column:
    """Co-operative by segment, bank by exact name; null for anything else (see checks.unclassified)."""
    return F.when(segment == tables.COOPERATIVE_SEGMENT, F.lit(tables.CATEGORY_COOPERATIVE)).when(institution.isin(*tables.BANK_BRANDS), F.lit(tables.CATEGORY_BANK))


def classify(df: DataFrame) -> DataFrame:
    """Adds categoria_if, sub_categoria and marca_exibicao.

    A bank's brand comes from the closed map. A co-operative's comes from its id root, then from its
    folded institution name, then from its folded installation name; what is left is the bucket, and
    only there may the display brand differ.
    """
    df = df.withColumn("categoria_if", category(F.col("segmento"), F.col("nome_instituicao")))
    institution, installation = fold(F.col("nome_instituicao")), fold(F.col("nome_instalacao"))
    root = id_root(F.col("cnpj"))
    ordered = [(brand, root.isin(*roots)) for brand, roots in tables.AFFILIATE_ROOTS.items()]
    ordered += pattern_rules(institution, tables.BRAND_RULES) + pattern_rules(installation, tables.BRAND_RULES)
    brand = F.when(F.col("categoria_if") == tables.CATEGORY_BANK, lookup(F.col("nome_instituicao"), tables.BANK_BRANDS)).when(
        F.col("categoria_if") == tables.CATEGORY_COOPERATIVE, first_match(ordered, F.lit(tables.OTHER_COOPERATIVE))
    )
    df = df.withColumn("sub_categoria", brand)
    shown = [(label, F.coalesce(institution.rlike(p), F.lit(False)) | F.coalesce(installation.rlike(p), F.lit(False))) for label, p in tables.DISPLAY_RULES]
    return df.withColumn("marca_exibicao", F.when(F.col("sub_categoria") == tables.OTHER_COOPERATIVE, first_match(shown, F.lit(tables.OTHER_COOPERATIVE))).otherwise(F.col("sub_categoria")))
