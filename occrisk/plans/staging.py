"""Staging views: cleaned, typed and code-normalised relations.

Each takes the raw layer and returns a plan; nothing is executed or stored, so
column pruning and filters reach the raw scans through these projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occrisk.functions import ages, codes, text
from occrisk.functions import labels as L
from occrisk.functions.text import blank_to_null, lookup
from occrisk.operators.expand import explode_codes
from occrisk.plans.layers import Layer


def dim_cnae(raw: Layer) -> DataFrame:
    """Economic activities, one row per subclass."""
    levels = ["subclasse", "classe", "grupo", "divisao", "secao"]
    cols = []
    for level in levels:
        cols.append(F.trim(level).alias(f"cnae_{level}"))
        cols.append(F.trim(f"descricao_{level}").alias(f"cnae_descricao_{level}"))
    return raw["dim_cnae"].filter(F.col("subclasse").isNotNull()).select(*cols)


def dim_cbo(raw: Layer) -> DataFrame:
    """Occupations with their sub-group code."""
    code = F.trim("cbo_2002")
    return raw["dim_cbo"].filter(F.col("cbo_2002").isNotNull()).select(
        code.alias("cbo_codigo"),
        F.trim("descricao").alias("cbo_descricao"),
        F.trim("grande_grupo").alias("cbo_grande_grupo_codigo"),
        F.trim("descricao_grande_grupo").alias("cbo_grande_grupo_descricao"),
        F.left(code, F.lit(4)).alias("cbo_subgrupo_codigo"),
        F.col("indicador_cbo_2002_ativa").alias("cbo_ativa"),
    )


def dim_municipio(raw: Layer) -> DataFrame:
    """Municipalities."""
    return raw["dim_municipio"].filter(F.col("id_municipio").isNotNull()).select(
        F.trim("id_municipio").alias("municipio_id"),
        F.trim("id_municipio_6").alias("municipio_id_6"),
        F.trim("nome").alias("municipio_nome"),
        F.upper(F.trim("sigla_uf")).alias("sigla_uf"),
        F.trim("nome_uf").alias("uf_nome"),
        F.trim("nome_regiao").alias("regiao_nome"),
    )


def dim_grau_risco(raw: Layer) -> DataFrame:
    """Statutory risk grade per activity class."""
    grade = F.col("grau_risco")
    return raw["dim_grau_risco"].filter(F.col("cnae_classe").isNotNull() & grade.isNotNull()).select(
        F.trim("cnae_classe").alias("cnae_classe"),
        grade,
        lookup(L.RISK_GRADE_LABEL, grade).alias("grau_risco_descricao"),
    )


def dim_cid(raw: Layer) -> DataFrame:
    """Diagnosis dictionary."""
    return raw["dim_cid"].select("cid_codigo", "cid_descricao").dropna()


def fact_rais(raw: Layer) -> DataFrame:
    """Employment bonds per year, state, subclass and occupation."""
    subclass = F.trim("cnae_2_subclasse")
    return raw["rais_vinculos"].dropna(subset=["cnae_2_subclasse", "cbo_2002", "sigla_uf"]).select(
        F.col("ano").cast("int").alias("ano"),
        F.upper(F.trim("sigla_uf")).alias("sigla_uf"),
        subclass.alias("cnae_subclasse"),
        F.left(subclass, F.lit(5)).alias("cnae_classe"),
        F.trim("cbo_2002").alias("cbo_codigo"),
        F.col("quantidade_vinculos").cast("bigint").alias("quantidade_vinculos"),
    )


def age_dates() -> list[Column]:
    """Dates of accident and birth, parsed once ahead of ``with_age``."""
    return [
        ages.day_month_year(F.col("data_acidente")).alias("_event"),
        ages.day_month_year(F.col("data_nascimento")).alias("_birth"),
    ]


def with_age(df: DataFrame) -> DataFrame:
    """Whole years from birth to accident as ``_age``."""
    return df.withColumn("_age", ages.whole_years_between(F.col("_event"), F.col("_birth"))).drop("_event", "_birth")


def fact_cat(raw: Layer) -> DataFrame:
    """Work-accident notices, one row per notice.

    Rows whose competence month is malformed stay, with NULL year and month.
    """
    prefix = text.activity_prefix(F.col("cnae_empregador_cod"))
    period = F.col("data_competencia")
    typed = (
        raw["cat_microdados"]
        .filter(prefix.isNotNull() & (prefix != L.BLANK_ACTIVITY) & period.isNotNull())
        .select(
            text.competence_part(period, 1).alias("ano"),
            text.competence_part(period, 2).alias("mes"),
            text.occupation_code(F.col("cbo")).alias("cbo_codigo"),
            prefix.alias("cnae_cod_4"),
            F.left(F.trim("munic_empregador"), F.lit(6)).alias("municipio_id_6"),
            text.accident_type(F.col("tipo_acidente")).alias("tipo_acidente"),
            text.placeholder_to_null(F.col("cid_10")).alias("cid_10"),
            text.says_yes(F.col("indica_obito")).alias("obito"),
            F.trim("uf_empregador").alias("uf_empregador"),
            F.trim("_source_file").alias("source_file"),
            lookup(L.CAT_SEX, F.col("sexo")).alias("sexo"),
            *[
                text.placeholder_to_null(F.col(name)).alias(name)
                for name in ("natureza_lesao", "parte_corpo", "agente_causador")
            ],
            *age_dates(),
        )
    )
    return with_age(typed).withColumn("faixa_etaria", ages.age_band(F.col("_age"))).drop("_age")


def fact_sim(raw: Layer) -> DataFrame:
    """Deaths with occupation; each row stands for ``total_obitos`` deaths."""
    age = F.col("idade").cast("double")
    return raw["fact_sim"].dropna(subset=["cbo_2002", "sigla_uf"]).select(
        F.col("ano").cast("int").alias("ano"),
        F.upper(F.trim("sigla_uf")).alias("sigla_uf"),
        F.trim("id_municipio").alias("municipio_id"),
        F.trim("cbo_2002").alias("cbo_codigo"),
        codes.basic_cause(F.col("cid_10_causa")).alias("cid_10_causa"),
        lookup(L.SIM_WORK_ACCIDENT, F.left(F.trim("acidente_trabalho"), F.lit(1))).alias("acidente_trabalho"),
        F.col("total_obitos").cast("bigint").alias("total_obitos"),
        lookup(L.SIM_SEX, F.trim("sexo")).alias("sexo"),
        ages.age_band(age, L.OLDEST_CREDIBLE_AGE).alias("faixa_etaria"),
        *[blank_to_null(F.col(f"linha_{x}")).alias(f"linha_{x}_raw") for x in L.CERTIFICATE_LINES],
    )


DEATH_ATTRIBUTES = [
    "ano", "sigla_uf", "municipio_id", "cbo_codigo", "causa_basica",
    "acidente_trabalho", "total_obitos", "sexo", "faixa_etaria",
]


def classify_codes(df: DataFrame, code: str) -> DataFrame:
    """Category, chapter label and condition label of a normalised code."""
    letter = codes.chapter(F.col(code))
    return df.withColumns(
        {
            "cid_categoria": codes.category(F.col(code)),
            "capitulo_cid": lookup(L.CHAPTER_LABEL, letter, L.UNCLASSIFIED),
            "tipo_condicao": lookup(L.CONDITION_LABEL, letter, L.UNCLASSIFIED),
        }
    )


def death_lines(sim: DataFrame, keep: list[str]) -> DataFrame:
    """Certificate lines as (line, raw code, normalised code); unusable codes drop."""
    *part_one, part_two = L.CERTIFICATE_LINES
    long = explode_codes(
        sim,
        singles={f"linha_{x}_raw": x for x in part_one},
        multiples={f"linha_{part_two}_raw": part_two},
        separator="*", line="fonte_linha", code="cid_raw", keep=keep,
    )
    normal = long.withColumn("cid_normalizado", codes.certificate_code(F.col("cid_raw")))
    return normal.filter(F.col("cid_normalizado").isNotNull())


def sim_linhas(raw: Layer) -> DataFrame:
    """All diagnosis codes of the certificates in long form."""
    sim = fact_sim(raw).withColumnRenamed("cid_10_causa", "causa_basica")
    return classify_codes(death_lines(sim, DEATH_ATTRIBUTES), "cid_normalizado")


STAGING = {
    "stg_dim_cnae": dim_cnae,
    "stg_dim_cbo": dim_cbo,
    "stg_dim_municipio": dim_municipio,
    "stg_dim_grau_risco": dim_grau_risco,
    "stg_dim_cid": dim_cid,
    "stg_fact_rais": fact_rais,
    "stg_fact_cat": fact_cat,
    "stg_fact_sim": fact_sim,
    "stg_sim_linhas": sim_linhas,
}


def staging_layer(raw: Layer) -> Layer:
    return Layer(lambda name: STAGING[name](raw))
