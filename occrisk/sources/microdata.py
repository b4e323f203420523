"""Aggregation of warehouse microdata into raw tables, and plain projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: column contract of the raw dimension tables.
DIMENSION_COLUMNS = {
    "dim_cnae": [
        "subclasse", "descricao_subclasse", "classe", "descricao_classe", "grupo",
        "descricao_grupo", "divisao", "descricao_divisao", "secao", "descricao_secao",
    ],
    "dim_cbo": [
        "cbo_2002", "descricao", "grande_grupo", "descricao_grande_grupo", "indicador_cbo_2002_ativa",
    ],
    "dim_municipio": ["id_municipio", "id_municipio_6", "nome", "sigla_uf", "nome_uf", "nome_regiao"],
}

# FIXED VALUES: microdata column -> raw column of the deaths table.
DEATH_COLUMNS = {
    "ano": "ano",
    "sigla_uf": "sigla_uf",
    "id_municipio_residencia": "id_municipio",
    "ocupacao": "cbo_2002",
    "causa_basica": "cid_10_causa",
    "acidente_trabalho": "acidente_trabalho",
    "sexo": "sexo",
    "idade": "idade",
    "linha_a": "linha_a",
    "linha_b": "linha_b",
    "linha_c": "linha_c",
    "linha_d": "linha_d",
    "linha_ii": "linha_ii",
}


def dimension(df: DataFrame, name: str) -> DataFrame:
    return df.select(*DIMENSION_COLUMNS[name])


def aggregate_bonds(microdata: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Active bonds per year, state, subclass and occupation.

    Billions of rows in, one row per key out: the count combines map-side, and
    the year range prunes partitions of a table stored by ``ano``.
    """
    active = (
        F.col("ano").between(first_year, last_year)
        & (F.col("vinculo_ativo_3112") == "1")
        & F.col("cnae_2_subclasse").isNotNull()
        & F.col("cbo_2002").isNotNull()
    )
    keys = ["ano", "sigla_uf", "cnae_2_subclasse", "cbo_2002"]
    return microdata.filter(active).groupBy(*keys).agg(F.count(F.lit(1)).alias("quantidade_vinculos"))


def aggregate_deaths(microdata: DataFrame, states: Sequence[str], first_year: int, last_year: int) -> DataFrame:
    """Deaths with a known occupation, counted per distinct combination.

    NULL key columns form groups of their own.
    """
    wanted = (
        F.col("sigla_uf").isin(*states)
        & F.col("ano").between(first_year, last_year)
        & F.col("ocupacao").isNotNull()
    )
    renamed = microdata.filter(wanted).select(*[F.col(src).alias(dst) for src, dst in DEATH_COLUMNS.items()])
    return renamed.groupBy(*DEATH_COLUMNS.values()).agg(F.count(F.lit(1)).alias("total_obitos"))
