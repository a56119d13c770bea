"""Schemas of the pipeline's tables and tolerant column resolution."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .functions.text import plain_fold, snake_case

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

#: Names of the common columns.
COMMON_COLUMNS = ["cnpj", "nome_instituicao", "segmento", "nome_instalacao", "endereco", "numero", "bairro", "cep", "municipio", "uf", "municipio_ibge", "tipo_instalacao", "fonte_arquivo"]
COMMON = T.StructType([T.StructField(c, _S) for c in COMMON_COLUMNS])
POINT = T.StructType([T.StructField("x", _D), T.StructField("y", _D)])
#: Rings of a polygon or multi-polygon: part and ring numbers (ring 0 is the shell), and vertices.
RINGS = T.ArrayType(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("ring", T.IntegerType()), T.StructField("pts", T.ArrayType(POINT))]))
GEOMETRY = T.StructType([T.StructField("type", _S), T.StructField("rings", RINGS)])
BOUNDARIES = T.StructType([T.StructField("municipio_ibge", _S), T.StructField("municipio_nome", _S), T.StructField("uf", _S), T.StructField("regiao", _S), T.StructField("populacao", _L), T.StructField("populacao_ano", _S), T.StructField("geometry", GEOMETRY)])
#: Headers of the address files.
ADDRESS_COLUMNS = ["COD_MUNICIPIO", "CEP", "NOM_TIPO_SEGLOGR", "NOM_TITULO_SEGLOGR", "NOM_SEGLOGR", "NUM_ENDERECO", "LATITUDE", "LONGITUDE"]
ADDRESSES = T.StructType([T.StructField(c, _S) for c in ADDRESS_COLUMNS])
UNIT_NAMES = T.StructType([T.StructField("municipio_ibge", _S), T.StructField("municipio_nome", _S)])
POPULATION = T.StructType([T.StructField("municipio_ibge", _S), T.StructField("populacao", _L), T.StructField("populacao_ano", _S)])

#: Accepted headers of the register spreadsheets for each target column.
REGISTER_HEADERS = {
    "cnpj": ["CNPJ"],
    "nome_instituicao": ["NOME INSTITUIÇÃO"],
    "segmento": ["SEGMENTO"],
    "nome_instalacao": ["NOME AGÊNCIA", "NOME INSTALAÇÃO"],
    "endereco": ["ENDEREÇO"],
    "numero": ["NÚMERO", "NUMERO"],
    "bairro": ["BAIRRO"],
    "cep": ["CEP"],
    "municipio": ["MUNICÍPIO", "MUNICIPIO"],
    "uf": ["UF"],
    "municipio_ibge": ["MUNICIPIO IBGE", "MUNICÍPIO IBGE"],
}
#: Columns that the address keys add, for the lookup only.
WORK_COLUMNS = ["cep8", "cep_generico", "logradouro", "numero_imovel", "chave_logr"]
#: Accepted names of the unit code.
UNIT_CODE_COLUMNS = ["codarea", "CD_MUN", "CD_GEOCMU", "GEOCODIGO", "geocodigo", "CD_MUNICIPIO"]


def require_columns(df: DataFrame, wanted, what: str = "table") -> DataFrame:
    if missing := [c for c in wanted if c not in df.columns]:
        raise KeyError(f"{what} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df


def resolve_column(columns: list[str], candidates: list[str]) -> str:
    """The column whose folded name equals the first matching candidate's (of equal names, the last)."""

    def plain(name: str) -> str:
        return plain_fold(re.sub(r"\s+", " ", name).strip())

    known = {plain(c): c for c in columns}
    for candidate in candidates:
        if plain(candidate) in known:
            return known[plain(candidate)]
    raise KeyError(f"none of {', '.join(candidates)} among {', '.join(columns)}")


def first_column(columns: list[str], candidates: list[str]) -> str:
    """The first candidate that is there under its exact name."""
    for candidate in candidates:
        if candidate in columns:
            return candidate
    raise KeyError(f"none of {', '.join(candidates)} among {', '.join(columns)}")


def snake_columns(df: DataFrame) -> DataFrame:
    """P3."""
    return df.toDF(*map(snake_case, df.columns))
