"""Marts: the analytic tables, as plans over the staging layer.

Shape shared by all of them: reduce the fact to its smallest useful grain with
a map-side-combined aggregation, then join the dictionaries to the reduced
rows.  Dictionary joins carry no broadcast hint: AQE broadcasts a side when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and
otherwise sort-merges with skew splitting.  Presentation order belongs to the
export (see ``export.PRESENTATION_ORDER``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occrisk.functions import codes, rates
from occrisk.functions import labels as L
from occrisk.functions.text import lookup
from occrisk.operators import keyed, ranking, relations
from occrisk.operators.expand import explode_codes
from occrisk.operators.stored import stored
from occrisk.plans.layers import Layer
from occrisk.plans.staging import classify_codes, death_lines

# Names of relations that a build stores once and several marts read.
SHARED_BONDS, SHARED_DOMINANT = "shared_bonds", "shared_dominant_"

TOP_OCCUPATIONS = 10
TOP_DIAGNOSES = 5

CLASS_COLUMNS = ["cnae_classe", "cnae_descricao_classe", "cnae_secao", "cnae_descricao_secao"]
OCCUPATION_COLUMNS = ["cbo_descricao", "cbo_grande_grupo_codigo", "cbo_grande_grupo_descricao"]


# --- shared building blocks ------------------------------------------------------

def _prefix(code: str = "cnae_classe") -> Column:
    return F.left(code, F.lit(4))


def _classes(stg: Layer, columns: list[str] = CLASS_COLUMNS) -> DataFrame:
    """Class-level rows out of the subclass dictionary."""
    return stg["stg_dim_cnae"].select(*columns).distinct()


def _with_prefix(classes: DataFrame) -> DataFrame:
    return classes.withColumn("cnae_cod_4", _prefix())


def _graded(df: DataFrame, stg: Layer) -> DataFrame:
    """Keep classes that have a statutory grade, and attach it."""
    return df.join(stg["stg_dim_grau_risco"], "cnae_classe", "inner")


def _with_occupation(df: DataFrame, stg: Layer) -> DataFrame:
    return df.join(stg["stg_dim_cbo"].select("cbo_codigo", *OCCUPATION_COLUMNS), "cbo_codigo", "left")


def _with_diagnosis(df: DataFrame, stg: Layer, code: str | Column, out: str) -> DataFrame:
    """Description of a diagnosis code, under the name ``out``."""
    key = F.col(code) if isinstance(code, str) else code
    cid = stg["stg_dim_cid"].select(F.col("cid_codigo").alias("_cid"), F.col("cid_descricao").alias(out))
    return df.join(cid, key == F.col("_cid"), "left").drop("_cid")


def dominant_class(stg: Layer, mode: str = "max_row") -> DataFrame:
    """Occupation -> activity class that employs it most."""
    if f"{SHARED_DOMINANT}{mode}" in stg:
        return stg[f"{SHARED_DOMINANT}{mode}"]
    weight = "maior_linha" if mode == "max_row" and SHARED_BONDS in stg else "quantidade_vinculos"
    return keyed.dominant_key(bonds(stg), "cbo_codigo", "cnae_classe", weight, mode)


def _attributed(df: DataFrame, stg: Layer, mode: str = "max_row") -> DataFrame:
    return keyed.attribute(df, dominant_class(stg, mode), "cbo_codigo", "cnae_classe")


def bonds(stg: Layer) -> DataFrame:
    """Bonds by class, occupation and year (columns of the fact), reduced where a build has stored that."""
    return stg[SHARED_BONDS] if SHARED_BONDS in stg else stg["stg_fact_rais"]


def shared_bonds(stg: Layer) -> DataFrame:
    """The reduced relation that all marts on bonds start from; ``maior_linha`` is the largest single row."""
    return stg["stg_fact_rais"].groupBy("cnae_classe", "cbo_codigo", "ano").agg(
        F.sum("quantidade_vinculos").alias("quantidade_vinculos"), F.max("quantidade_vinculos").alias("maior_linha")
    )


def bonds_by_class(stg: Layer) -> DataFrame:
    return bonds(stg).groupBy("cnae_classe").agg(F.sum("quantidade_vinculos").alias("total_vinculos"))


def common_years(stg: Layer) -> Column:
    """Condition on ``ano``: inside the years covered by notices and by bonds.

    Scalar subqueries over the year column alone; as a filter on a fact stored
    by year they prune its partitions at run time.
    """
    return F.col("ano").between(*relations.year_intersection(stg["stg_fact_cat"], bonds(stg)))


def _at_work() -> Column:
    return F.col("tipo_acidente").isin(*L.WORK_ACCIDENT_TYPES)


def _commuting() -> Column:
    return F.col("tipo_acidente") == L.COMMUTE_ACCIDENT_TYPE


# --- accident notices ------------------------------------------------------------

def cat_cnae_cbo_mes(stg: Layer) -> DataFrame:
    """Monthly accidents by state, activity, occupation, type and diagnosis.

    Activities, occupations and diagnoses without a dictionary entry stay.
    """
    keys = ["ano", "mes", "uf_empregador", "cnae_cod_4", "cbo_codigo", "tipo_acidente", "cid_10"]
    counted = stg["stg_fact_cat"].groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_acidentes"), F.count_if(F.col("obito")).alias("total_obitos")
    )
    classes = _with_prefix(_classes(stg, ["cnae_classe", "cnae_descricao_classe", "cnae_descricao_secao"]))
    rows = _with_occupation(counted.join(classes, "cnae_cod_4", "left"), stg)
    rows = _with_diagnosis(rows, stg, "cid_10", "cid_descricao")
    return rows.select(
        "ano", "mes", "uf_empregador", "cnae_cod_4", "cnae_classe",
        F.col("cnae_descricao_classe").alias("cnae_descricao"),
        F.col("cnae_descricao_secao").alias("cnae_secao"),
        "cbo_codigo", *OCCUPATION_COLUMNS, "tipo_acidente", "cid_10", "cid_descricao",
        "total_acidentes", "total_obitos",
    )


def risco_acidente(stg: Layer) -> DataFrame:
    """Accident frequency and injury profile by activity and occupation."""
    keys = [
        "cnae_cod_4", "cbo_codigo", "tipo_acidente", "natureza_lesao", "parte_corpo",
        "agente_causador", "cid_10", "sexo", "faixa_etaria",
    ]
    counted = stg["stg_fact_cat"].filter(F.col("cnae_cod_4").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_acidentes"), F.count_if(F.col("obito")).alias("total_obitos_acidente")
    )
    described = keyed.first_per_key(
        stg["stg_dim_cnae"].filter(F.col("cnae_classe").isNotNull()),
        ["cnae_classe"], [], CLASS_COLUMNS[1:],
    )
    rows = counted.join(_graded(_with_prefix(described), stg), "cnae_cod_4", "inner")
    rows = _with_diagnosis(_with_occupation(rows, stg), stg, "cid_10", "cid_descricao")
    return rows.select(
        "grau_risco", "grau_risco_descricao", *CLASS_COLUMNS, "cbo_codigo", "cbo_descricao",
        "cbo_grande_grupo_codigo", "tipo_acidente", "natureza_lesao", "parte_corpo", "agente_causador",
        "cid_10", "cid_descricao", "sexo", "faixa_etaria", "total_acidentes", "total_obitos_acidente",
        rates.share_pct(F.col("total_obitos_acidente"), F.col("total_acidentes"), 2).alias("pct_obito_no_acidente"),
    )


def severidade_cat_cnae(stg: Layer) -> DataFrame:
    """Severity per class: fatality, sex split, most frequent injury traits."""
    traits = ["natureza_lesao", "parte_corpo", "agente_causador", "faixa_etaria"]
    sex = F.col("sexo")
    per_prefix = keyed.modes_per_group(
        stg["stg_fact_cat"].filter(F.col("cnae_cod_4").isNotNull()),
        "cnae_cod_4",
        traits,
        {
            "total_acidentes": F.lit(1).cast("bigint"),
            "total_obitos": F.when(F.col("obito"), 1).otherwise(0).cast("bigint"),
            # NULL, not 0, for a class without any notice of that sex.
            "acidentes_m": F.when(sex == "M", 1).cast("bigint"),
            "acidentes_f": F.when(sex == "F", 1).cast("bigint"),
        },
    )
    rows = per_prefix.join(_graded(_with_prefix(_classes(stg)), stg), "cnae_cod_4", "inner")
    total = F.col("total_acidentes")

    def mode(trait: str, value_name: str, share_name: str) -> list[Column]:
        return [
            F.col(f"{trait}.value").alias(value_name),
            rates.share_pct(F.col(f"{trait}.n"), total, 1).alias(share_name),
        ]

    return rows.select(
        "grau_risco", "grau_risco_descricao", "cnae_classe",
        F.col("cnae_descricao_classe").alias("cnae_descricao"), "cnae_secao", "cnae_descricao_secao",
        "total_acidentes", "total_obitos",
        rates.share_pct(F.col("total_obitos"), total, 2).alias("taxa_obito_pct"),
        "acidentes_m", "acidentes_f",
        rates.share_pct(F.col("acidentes_m"), total, 1).alias("pct_masculino"),
        *mode("natureza_lesao", "top_natureza_lesao", "pct_top_natureza"),
        *mode("parte_corpo", "top_parte_corpo", "pct_top_parte"),
        *mode("agente_causador", "top_agente_causador", "pct_top_agente"),
        *mode("faixa_etaria", "faixa_etaria_dominante", "pct_faixa_dominante"),
    )


def perfil_risco_cnae(stg: Layer) -> DataFrame:
    """Top 10 occupations per activity with the top 5 diagnoses of each.

    The sex counts per occupation include notices without a diagnosis while
    the occupation's accident count does not, so the male share may pass 100.
    """
    sex, diagnosed = F.col("sexo"), F.col("cid_10").isNotNull()
    cells = (
        stg["stg_fact_cat"]
        .filter(F.col("cbo_codigo").isNotNull())
        .groupBy("cnae_cod_4", "cbo_codigo", "cid_10")
        .agg(
            F.count(F.lit(1)).alias("acidentes_cid"),
            F.count_if(F.col("obito")).alias("obitos_cid"),
            F.count_if(sex == "M").alias("acidentes_cid_m"),
            F.count_if(sex == "F").alias("acidentes_cid_f"),
        )
    )
    occupations = (
        cells.groupBy("cnae_cod_4", "cbo_codigo")
        .agg(
            F.sum(F.when(diagnosed, F.col("acidentes_cid"))).alias("acidentes_cbo"),
            F.sum(F.when(diagnosed, F.col("obitos_cid"))).alias("obitos_cbo"),
            F.sum("acidentes_cid_m").alias("acidentes_cbo_m"),
            F.sum("acidentes_cid_f").alias("acidentes_cbo_f"),
        )
        .filter(F.col("acidentes_cbo").isNotNull())
    )
    heads = ranking.top_n(
        occupations, ["cnae_cod_4"], [F.desc("acidentes_cbo"), F.asc("cbo_codigo")], TOP_OCCUPATIONS, "rank_cbo"
    )
    # Notices without a diagnosis rank last and are cut afterwards: filtered
    # here, they would give this branch a scan and a shuffle of its own.
    leaves = ranking.top_n(
        cells, ["cnae_cod_4", "cbo_codigo"],
        [F.desc(diagnosed), F.desc("acidentes_cid"), F.asc("cid_10")], TOP_DIAGNOSES, "rank_cid",
    ).filter(diagnosed)
    exposure = (
        bonds(stg).groupBy("cnae_classe", "cbo_codigo").agg(F.sum("quantidade_vinculos").alias("_v"))
    )
    rows = leaves.join(heads, ["cnae_cod_4", "cbo_codigo"], "inner")
    rows = rows.join(_graded(_with_prefix(_classes(stg)), stg), "cnae_cod_4", "inner")
    rows = rows.join(exposure, ["cnae_classe", "cbo_codigo"], "left")
    rows = _with_diagnosis(_with_occupation(rows, stg), stg, "cid_10", "cid_descricao")
    return rows.select(
        "grau_risco", "grau_risco_descricao", "cnae_classe",
        F.col("cnae_descricao_classe").alias("cnae_descricao"), "cnae_secao", "cnae_descricao_secao",
        "rank_cbo", "cbo_codigo", *OCCUPATION_COLUMNS,
        F.coalesce("_v", F.lit(0)).alias("vinculos_cbo"), "acidentes_cbo", "obitos_cbo",
        rates.rate_per_mille(F.col("acidentes_cbo"), F.col("_v"), 2).alias("taxa_acidentes_por_mil"),
        "acidentes_cbo_m", "acidentes_cbo_f",
        rates.share_pct(F.col("acidentes_cbo_m"), F.col("acidentes_cbo"), 1).alias("pct_masculino_cbo"),
        "rank_cid", "cid_10", "cid_descricao", "acidentes_cid", "obitos_cid",
        rates.share_pct(F.col("acidentes_cid"), F.col("acidentes_cbo"), 1).alias("pct_acidentes_no_cbo"),
        "acidentes_cid_m", "acidentes_cid_f",
    )


# --- exposure --------------------------------------------------------------------

def risco_teorico_vs_observado(stg: Layer) -> DataFrame:
    """Statutory grade against observed accidents, per graded class."""
    notices = stg["stg_fact_cat"].groupBy("cnae_cod_4").agg(
        F.count(F.lit(1)).alias("_a"), F.count_if(F.col("obito")).alias("_d")
    )
    classes = _classes(stg, ["cnae_classe", "cnae_descricao_classe", "cnae_descricao_secao"])
    described = classes.select(_prefix().alias("cnae_cod_4"), "cnae_descricao_classe", "cnae_descricao_secao")
    rows = (
        _with_prefix(stg["stg_dim_grau_risco"])
        .join(described, "cnae_cod_4", "left")
        .join(notices, "cnae_cod_4", "left")
        .join(bonds_by_class(stg).withColumnRenamed("total_vinculos", "_v"), "cnae_classe", "left")
        .withColumns({
            "total_vinculos": F.coalesce("_v", F.lit(0)),
            "total_acidentes": F.coalesce("_a", F.lit(0)),
            "total_obitos": F.coalesce("_d", F.lit(0)),
        })
    )
    return ranking.global_rank(rows, "total_acidentes", "rank_por_acidentes").select(
        "cnae_classe",
        F.col("cnae_descricao_classe").alias("cnae_descricao"),
        F.col("cnae_descricao_secao").alias("cnae_secao"),
        "grau_risco", "grau_risco_descricao", "total_vinculos", "total_acidentes", "total_obitos",
        rates.rate_per_mille(F.col("_a"), F.col("_v"), 2).alias("taxa_acidentes_por_mil"),
        "rank_por_acidentes",
    )


def top_cbo_por_cnae(stg: Layer) -> DataFrame:
    """Ten occupations with most bonds per graded class.

    The share refers to the whole class, so class totals come from their own
    small aggregate instead of a window that would gather a hot class.
    """
    pairs = bonds(stg).filter(F.col("cbo_codigo").isNotNull()).groupBy("cnae_classe", "cbo_codigo").agg(
        F.sum("quantidade_vinculos").alias("total_vinculos"),
        F.min("ano").alias("ano_inicio"),
        F.max("ano").alias("ano_fim"),
    )
    totals = pairs.groupBy("cnae_classe").agg(F.sum("total_vinculos").alias("total_vinculos_cnae"))
    top = ranking.top_n(
        pairs, ["cnae_classe"], [F.desc("total_vinculos"), F.asc("cbo_codigo")], TOP_OCCUPATIONS, "rank_cbo"
    )
    rows = _graded(top, stg).join(totals, "cnae_classe", "inner").join(_classes(stg), "cnae_classe", "left")
    return _with_occupation(rows, stg).select(
        "grau_risco", "grau_risco_descricao", "cnae_classe",
        F.col("cnae_descricao_classe").alias("cnae_descricao"), "cnae_secao", "cnae_descricao_secao",
        "rank_cbo", "cbo_codigo", *OCCUPATION_COLUMNS, "total_vinculos", "total_vinculos_cnae",
        rates.share_pct(F.col("total_vinculos"), F.col("total_vinculos_cnae"), 2).alias("pct_vinculos_na_classe"),
        "ano_inicio", "ano_fim",
    )


# --- deaths ----------------------------------------------------------------------

def risco_morte(stg: Layer) -> DataFrame:
    """Deaths by activity, occupation, coverage category, age, sex and cause."""
    keys = ["cbo_codigo", "categoria_morte", "faixa_etaria", "sexo", "cid_10_causa"]
    counted = (
        stg["stg_fact_sim"]
        .filter(F.col("cid_10_causa").isNotNull())
        .withColumn("categoria_morte", codes.death_category(F.col("cid_10_causa"), F.col("acidente_trabalho")))
        .groupBy(*keys)
        .agg(F.sum("total_obitos").alias("total_obitos"))
    )
    rows = _graded(_attributed(counted, stg), stg).join(_classes(stg), "cnae_classe", "left")
    rows = _with_diagnosis(_with_occupation(rows, stg), stg, "cid_10_causa", "causa_descricao")
    return rows.select(
        "grau_risco", "grau_risco_descricao", *CLASS_COLUMNS, "cbo_codigo", "cbo_descricao",
        "cbo_grande_grupo_codigo", "categoria_morte", "faixa_etaria", "sexo", "cid_10_causa",
        "causa_descricao", "total_obitos",
    )


def risco_doenca(stg: Layer) -> DataFrame:
    """Conditions on the certificates by activity, occupation and line.

    The base counts code occurrences on the line, not deaths.
    """
    lines = death_lines(stg["stg_fact_sim"], ["cbo_codigo", "total_obitos"])
    counted = lines.groupBy("cbo_codigo", "fonte_linha", "cid_normalizado").agg(
        F.sum("total_obitos").alias("total_obitos_com_condicao")
    )
    # An occupation has exactly one class, so (occupation, line) is the group
    # of (class, occupation, line).
    measured = ranking.rank_in_group(
        _attributed(counted, stg), ["cbo_codigo", "fonte_linha"], "total_obitos_com_condicao", "cid_normalizado",
        "rank_na_fonte", total="total_obitos_na_fonte",
    )
    rows = _graded(classify_codes(measured, "cid_normalizado"), stg).join(_classes(stg), "cnae_classe", "left")
    rows = _with_diagnosis(_with_occupation(rows, stg), stg, "cid_normalizado", "cid_descricao")
    rows = _with_diagnosis(rows, stg, "cid_categoria", "categoria_descricao")
    return rows.select(
        "grau_risco", "grau_risco_descricao", *CLASS_COLUMNS, "cbo_codigo", "cbo_descricao",
        "cbo_grande_grupo_codigo", "fonte_linha",
        lookup(L.CERTIFICATE_LINE_LABEL, F.col("fonte_linha")).alias("fonte_linha_descricao"),
        "cid_normalizado", "cid_categoria", "cid_descricao", "categoria_descricao", "capitulo_cid",
        "tipo_condicao", "total_obitos_com_condicao", "total_obitos_na_fonte",
        rates.share_pct(F.col("total_obitos_com_condicao"), F.col("total_obitos_na_fonte"), 2).alias("pct_na_fonte"),
        "rank_na_fonte",
    )


def mortalidade_por_cnae(stg: Layer) -> DataFrame:
    """Deaths per 1000 bonds by sex and age.

    One row per occupation, sex and age, labelled by the occupation's class
    (largest total of bonds); the occupation itself is not shown.
    """
    deaths = F.col("total_obitos")
    counted = (
        stg["stg_fact_sim"]
        .groupBy(
            "cbo_codigo",
            F.coalesce("sexo", F.lit(L.SEX_NOT_INFORMED)).alias("sexo"),
            F.coalesce("faixa_etaria", F.lit(L.AGE_NOT_INFORMED)).alias("faixa_etaria"),
        )
        .agg(
            F.sum(deaths).alias("total_obitos"),
            F.sum(F.when(F.col("acidente_trabalho") == "Sim", deaths).otherwise(0)).alias("obitos_acidente_trabalho"),
        )
    )
    # one reduced relation of the bonds gives both the dominant class and the exposure
    reduced = stored(
        bonds(stg).groupBy("cbo_codigo", "cnae_classe").agg(F.sum("quantidade_vinculos").alias("vinculos")), "bonds"
    )
    dominant = keyed.dominant_key(reduced, "cbo_codigo", "cnae_classe", "vinculos", "sum")
    exposure = reduced.groupBy("cnae_classe").agg(F.sum("vinculos").alias("total_vinculos"))
    rows = _graded(keyed.attribute(counted, dominant, "cbo_codigo", "cnae_classe"), stg)
    rows = rows.join(_classes(stg), "cnae_classe", "inner").join(exposure, "cnae_classe", "left")
    return rows.select(
        "grau_risco", "grau_risco_descricao", "cnae_classe",
        F.col("cnae_descricao_classe").alias("cnae_descricao"), "cnae_secao", "cnae_descricao_secao",
        "sexo", "faixa_etaria", "total_obitos", "obitos_acidente_trabalho",
        rates.share_pct(F.col("obitos_acidente_trabalho"), deaths, 1).alias("pct_acidente_trabalho"),
        F.coalesce("total_vinculos", F.lit(0)).alias("vinculos_cnae"),
        rates.rate_per_mille(deaths, F.col("total_vinculos"), 3).alias("taxa_obitos_por_mil_vinculos"),
    )


def comorbidades_por_cnae(stg: Layer) -> DataFrame:
    """Comorbidities (Part II) by activity.

    The base counts each death with a Part II once, whatever its codes.
    """
    with_part_two = (
        stg["stg_fact_sim"]
        .filter(F.col("linha_ii_raw").isNotNull())
        .groupBy("cbo_codigo", "linha_ii_raw")
        .agg(F.sum("total_obitos").alias("total_obitos"))
    )
    tokens = explode_codes(
        with_part_two, {}, {"linha_ii_raw": "ii"}, "*", "fonte_linha", "token", ["cbo_codigo", "total_obitos"]
    )
    by_occupation = (
        tokens.withColumn("cid_comorbidade", codes.comorbidity_code(F.col("token")))
        .filter(F.col("cid_comorbidade").isNotNull())
        .groupBy("cbo_codigo", "cid_comorbidade")
        .agg(F.sum("total_obitos").alias("_n"))
    )
    # deaths without a code beside them are the base: both are attributed once
    base_by_occupation = with_part_two.groupBy("cbo_codigo").agg(F.sum("total_obitos").alias("_n"))
    both = by_occupation.unionByName(base_by_occupation, allowMissingColumns=True)
    by_class = stored(
        _attributed(both, stg).groupBy("cnae_classe", "cid_comorbidade").agg(F.sum("_n").alias("total_obitos_com_comorbidade")),
        "comorbidities",
    )
    ranked = ranking.rank_in_group(
        by_class.filter(F.col("cid_comorbidade").isNotNull()), ["cnae_classe"], "total_obitos_com_comorbidade", "cid_comorbidade",
        "rank_comorbidade",
    )
    base = by_class.filter(F.col("cid_comorbidade").isNull()).select(
        "cnae_classe", F.col("total_obitos_com_comorbidade").alias("total_obitos_com_linhaii")
    )
    rows = _graded(ranked, stg).join(_classes(stg), "cnae_classe", "inner").join(base, "cnae_classe", "left")
    rows = rows.withColumn("cid_categoria", codes.category(F.col("cid_comorbidade")))
    rows = _with_diagnosis(rows, stg, "cid_comorbidade", "comorbidade_descricao")
    rows = _with_diagnosis(rows, stg, "cid_categoria", "categoria_descricao")
    chapter = lookup(
        L.COMORBIDITY_CHAPTER_LABEL, codes.chapter(F.col("cid_comorbidade")), L.COMORBIDITY_CHAPTER_OTHER
    )
    return rows.select(
        "grau_risco", "grau_risco_descricao", "cnae_classe",
        F.col("cnae_descricao_classe").alias("cnae_descricao"), "cnae_secao", "cnae_descricao_secao",
        "rank_comorbidade", "cid_comorbidade", "comorbidade_descricao", "cid_categoria", "categoria_descricao",
        chapter.alias("capitulo_cid"), "total_obitos_com_comorbidade", "total_obitos_com_linhaii",
        rates.share_pct(F.col("total_obitos_com_comorbidade"), F.col("total_obitos_com_linhaii"), 2).alias(
            "pct_obitos_com_comorbidade"
        ),
    )


def causas_externas_por_cnae(stg: Layer) -> DataFrame:
    """External causes of death by activity."""
    deaths = F.col("total_obitos")
    by_occupation = (
        stg["stg_fact_sim"]
        .filter(codes.chapter(F.col("cid_10_causa")).isin(*L.EXTERNAL_CAUSE_LABEL))
        .groupBy("cbo_codigo", F.col("cid_10_causa").alias("cid_causa"))
        .agg(F.sum(deaths).alias("_n"), F.sum(F.when(F.col("acidente_trabalho") == "Sim", deaths).otherwise(0)).alias("_work"))
    )
    by_class = _attributed(by_occupation, stg).groupBy("cnae_classe", "cid_causa").agg(
        F.sum("_n").alias("total_obitos"), F.sum("_work").alias("total_obitos_trabalho")
    )
    measured = ranking.rank_in_group(
        by_class, ["cnae_classe"], "total_obitos", "cid_causa", "rank_causa", total="total_obitos_causa_ext_cnae"
    )
    rows = _graded(measured, stg).join(_classes(stg), "cnae_classe", "left").withColumns({
        "capitulo": codes.chapter(F.col("cid_causa")),
        "cid_categoria": codes.category(F.col("cid_causa")),
    })
    rows = _with_diagnosis(rows, stg, "cid_causa", "causa_descricao")
    rows = _with_diagnosis(rows, stg, "cid_categoria", "categoria_descricao")
    return rows.select(
        "grau_risco", "grau_risco_descricao", *CLASS_COLUMNS, "rank_causa", "capitulo",
        lookup(L.EXTERNAL_CAUSE_LABEL, F.col("capitulo")).alias("tipo_causa_externa"),
        "cid_causa", "causa_descricao", "cid_categoria", "categoria_descricao",
        "total_obitos", "total_obitos_trabalho", "total_obitos_causa_ext_cnae",
        rates.share_pct(F.col("total_obitos"), F.col("total_obitos_causa_ext_cnae"), 2).alias("pct_causa_no_cnae"),
        rates.share_pct(F.col("total_obitos_trabalho"), F.col("total_obitos"), 2).alias("pct_trabalho_na_causa"),
    )


# --- score -----------------------------------------------------------------------

def score_risco_cnae(stg: Layer) -> DataFrame:
    """Risk score 1..5 per class with at least one work accident.

    Accidents and bonds are restricted to the years that both sources cover.
    Rates are rounded to parts per million before they meet the limits.
    """
    first, last = relations.year_intersection(stg["stg_fact_cat"], bonds(stg))
    in_window = F.col("ano").between(first, last)
    died = F.col("obito")
    accidents = (
        stg["stg_fact_cat"]
        .filter(F.col("cnae_cod_4").isNotNull() & in_window)
        .groupBy("cnae_cod_4")
        .agg(
            F.count_if(_at_work()).alias("acidentes_trabalho"),
            F.count_if(_commuting()).alias("acidentes_trajeto"),
            F.count_if(died).alias("obitos"),
            F.count_if(died & _at_work()).alias("obitos_trabalho"),
        )
        .filter(F.col("acidentes_trabalho") > 0)
    )
    exposure = (
        bonds(stg).filter(in_window)
        .groupBy(_prefix().alias("cnae_cod_4"))
        .agg(F.sum("quantidade_vinculos").alias("total_vinculos"))
    )
    classes = keyed.first_per_key(
        _with_prefix(stg["stg_dim_cnae"]),
        ["cnae_cod_4"], [], ["cnae_classe", "cnae_descricao_classe"],
    )
    rows = accidents.join(classes, "cnae_cod_4", "inner").join(exposure, "cnae_cod_4", "left").withColumns({
        "_rate": rates.ppm(F.col("acidentes_trabalho"), F.col("total_vinculos")),
        "_fatality": rates.ppm(F.col("obitos_trabalho"), F.col("acidentes_trabalho")),
    })
    rate, fatality = F.col("_rate"), F.col("_fatality")
    return rows.select(
        "cnae_classe", "cnae_descricao_classe", first.alias("ano_inicio"), last.alias("ano_fim"),
        "acidentes_trabalho", "acidentes_trajeto", "obitos", "obitos_trabalho", "total_vinculos",
        rates.from_ppm(rate).alias("taxa_acidente"),
        rates.from_ppm(fatality).alias("taxa_obito"),
        rates.base_score(rate).alias("score_base"),
        rates.fatality_aggravator(fatality).alias("agravante_obito"),
        rates.risk_score(rate, fatality).alias("score_risco"),
    )


def cnae_sem_score(stg: Layer, score: DataFrame | None = None) -> DataFrame:
    """Classes without a score, with the evidence why.

    The evidence counts all years, unlike the score.  This is the null-aware
    complement of the score table, which is taken as stored or built here.
    """
    scored = (score_risco_cnae(stg) if score is None else score).select(_prefix().alias("_scored")).distinct()
    classes = _with_prefix(_classes(stg, ["cnae_classe", "cnae_descricao_classe"]))
    classes = relations.null_aware_anti(classes, F.col("cnae_cod_4"), scored, "_scored")
    evidence = stg["stg_fact_cat"].filter(F.col("cnae_cod_4").isNotNull()).groupBy("cnae_cod_4").agg(
        F.count(F.lit(1)).alias("total_cat"),
        F.count_if(_at_work()).alias("acidentes_trabalho"),
        F.count_if(_commuting()).alias("acidentes_trajeto"),
    )
    rows = classes.join(evidence, "cnae_cod_4", "left").join(bonds_by_class(stg), "cnae_classe", "left")
    return rows.select(
        "cnae_classe", "cnae_descricao_classe",
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("total_cat", "acidentes_trabalho", "acidentes_trajeto", "total_vinculos")
        ],
        F.lit(L.REASON_WITHOUT_SCORE).alias("motivo_exclusao"),
    )


MARTS = {
    "mart_cat_cnae_cbo_mes": cat_cnae_cbo_mes,
    "mart_risco_teorico_vs_observado": risco_teorico_vs_observado,
    "mart_top_cbo_por_cnae": top_cbo_por_cnae,
    "mart_perfil_risco_cnae": perfil_risco_cnae,
    "mart_severidade_cat_cnae": severidade_cat_cnae,
    "mart_mortalidade_por_cnae": mortalidade_por_cnae,
    "mart_comorbidades_por_cnae": comorbidades_por_cnae,
    "mart_causas_externas_por_cnae": causas_externas_por_cnae,
    "mart_risco_morte": risco_morte,
    "mart_risco_acidente": risco_acidente,
    "mart_risco_doenca": risco_doenca,
    "mart_score_risco_cnae": score_risco_cnae,
    "mart_cnae_sem_score": cnae_sem_score,
}
