"""Invariants of the marts, and edge cases on hand-made staging relations."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from occrisk.plans import marts
from occrisk.plans.layers import Layer
from occrisk.plans.marts import MARTS
from occrisk.plans.staging import staging_layer
from occrisk.sources.adapter import raw_layer


def share_sums(df, keys, column):
    return [r[0] for r in df.groupBy(*keys).agg(F.sum(column).alias("s")).select("s").collect()]


def test_shares_of_a_group_add_up(layers):
    _, stg = layers
    doenca = MARTS["mart_risco_doenca"](stg)
    assert all(abs(s - 100) < 5 for s in share_sums(doenca, ["cbo_codigo", "fonte_linha"], "pct_na_fonte"))
    externas = MARTS["mart_causas_externas_por_cnae"](stg)
    assert all(abs(s - 100) < 1 for s in share_sums(externas, ["cnae_classe"], "pct_causa_no_cnae"))


@pytest.mark.parametrize(
    "name, keys, rank",
    [
        ("mart_risco_doenca", ["cnae_classe", "cbo_codigo", "fonte_linha"], "rank_na_fonte"),
        ("mart_causas_externas_por_cnae", ["cnae_classe"], "rank_causa"),
        ("mart_comorbidades_por_cnae", ["cnae_classe"], "rank_comorbidade"),
        ("mart_top_cbo_por_cnae", ["cnae_classe"], "rank_cbo"),
        ("mart_perfil_risco_cnae", ["cnae_classe", "cbo_codigo"], "rank_cid"),
    ],
)
def test_ranks_run_from_one(layers, name, keys, rank):
    _, stg = layers
    groups = MARTS[name](stg).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(rank).alias("lo"), F.max(rank).alias("hi"), F.count_distinct(rank).alias("d")
    )
    assert groups.filter("lo <> 1 or hi <> n or d <> n").count() == 0


def test_scored_and_unscored_classes_partition_the_dictionary(layers):
    _, stg = layers
    scored = MARTS["mart_score_risco_cnae"](stg).select("cnae_classe")
    unscored = MARTS["mart_cnae_sem_score"](stg).select("cnae_classe")
    classes = stg["stg_dim_cnae"].select("cnae_classe").distinct()
    assert scored.intersect(unscored).count() == 0
    assert rows(scored.union(unscored)) == rows(classes)


def test_complement_is_the_same_from_the_stored_score(layers):
    _, stg = layers
    score = MARTS["mart_score_risco_cnae"](stg)
    assert rows(marts.cnae_sem_score(stg, score)) == rows(marts.cnae_sem_score(stg))


def test_attribution_keeps_the_deaths_of_mapped_occupations(layers):
    _, stg = layers
    graded = marts._graded(marts.dominant_class(stg), stg).select("cbo_codigo")
    want = stg["stg_fact_sim"].join(graded, "cbo_codigo", "left_semi").agg(F.sum("total_obitos")).first()[0]
    got = MARTS["mart_risco_morte"](stg).agg(F.sum("total_obitos")).first()[0]
    assert got == want


@pytest.mark.parametrize("name", ["mart_perfil_risco_cnae", "mart_risco_doenca", "mart_severidade_cat_cnae", "mart_score_risco_cnae"])
def test_partitioning_does_not_change_the_result(spark, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(rows(MARTS[name](staging_layer(raw_layer(spark, SF_DIR)))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_results_without_any_broadcast(spark):
    """Beyond the broadcast threshold the joins sort-merge to the same rows."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    build = MARTS["mart_risco_morte"]
    want = rows(build(staging_layer(raw_layer(spark, SF_DIR))))
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = build(staging_layer(raw_layer(spark, SF_DIR)))
        assert "SortMergeJoin" in plan._jdf.queryExecution().executedPlan().toString()
        assert rows(plan) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", MARTS)
def test_plans_have_no_cross_join_and_no_python(layers, name):
    _, stg = layers
    plan = MARTS[name](stg)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "MapInPandas"):
        assert word not in plan


def test_scans_read_only_the_needed_columns(layers):
    _, stg = layers
    plan = marts.bonds_by_class(stg)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "l_suppkey" in plan
    plan = MARTS["mart_top_cbo_por_cnae"](stg)._jdf.queryExecution().executedPlan().toString()
    assert "s_acctbal" not in plan and "p_name" not in plan


# --- hand-made relations ---------------------------------------------------------

def staging(spark, cat=(), rais=(), sim=(), classes=("41204", "86101")):
    tables = {
        "stg_dim_cnae": spark.createDataFrame(
            [(f"{c}{i:02d}", c, f"Classe {c}", "F", "Secao F") for c in classes for i in range(2)],
            "cnae_subclasse string, cnae_classe string, cnae_descricao_classe string, cnae_secao string, cnae_descricao_secao string",
        ),
        "stg_dim_grau_risco": spark.createDataFrame(
            [(c, 3, "Alto") for c in classes], "cnae_classe string, grau_risco int, grau_risco_descricao string"
        ),
        "stg_dim_cbo": spark.createDataFrame(
            [], "cbo_codigo string, cbo_descricao string, cbo_grande_grupo_codigo string, cbo_grande_grupo_descricao string"
        ),
        "stg_dim_cid": spark.createDataFrame([], "cid_codigo string, cid_descricao string"),
        "stg_fact_cat": spark.createDataFrame(
            list(cat), "ano int, cnae_cod_4 string, cbo_codigo string, cid_10 string, tipo_acidente string, obito boolean, sexo string"
        ),
        "stg_fact_rais": spark.createDataFrame(
            list(rais), "ano int, sigla_uf string, cnae_classe string, cbo_codigo string, quantidade_vinculos bigint"
        ),
        "stg_fact_sim": spark.createDataFrame(list(sim), "cbo_codigo string, total_obitos bigint, linha_ii_raw string"),
    }
    return Layer(tables.__getitem__)


def test_score_uses_the_common_years_and_the_complement_all_years(spark):
    stg = staging(
        spark,
        cat=[
            (2018, "4120", "1", "A", "típico", True, "M"),  # before the bonds start
            (2020, "8610", "1", "A", "típico", None, "M"),
            (2020, "8610", "1", "A", "doença", True, "M"),
            (2020, "8610", "1", "A", "trajeto", True, "M"),
            (None, "8610", "1", "A", "típico", False, "M"),
        ],
        rais=[(2019, "SP", "86101", "1", 500), (2021, "SP", "86101", "1", 7), (2020, "SP", "41204", "1", 9)],
    )
    (row,) = MARTS["mart_score_risco_cnae"](stg).collect()
    assert row.asDict() == {
        "cnae_classe": "86101", "cnae_descricao_classe": "Classe 86101", "ano_inicio": 2019, "ano_fim": 2020,
        "acidentes_trabalho": 2, "acidentes_trajeto": 1, "obitos": 2, "obitos_trabalho": 1, "total_vinculos": 500,
        "taxa_acidente": 0.004, "taxa_obito": 0.5, "score_base": 2, "agravante_obito": 1, "score_risco": 3,
    }
    assert rows(MARTS["mart_cnae_sem_score"](stg)) == [
        ("41204", "Classe 41204", 1, 1, 0, 9, "Sem acidentes típicos/doença registrados")
    ]


def test_score_without_exposure_is_null(spark):
    stg = staging(
        spark, cat=[(2020, "8610", "1", "A", "típico", True, "M")], rais=[(2020, "SP", "41204", "1", 9)]
    )
    (row,) = MARTS["mart_score_risco_cnae"](stg).collect()
    assert (row.total_vinculos, row.taxa_acidente, row.score_base, row.agravante_obito, row.score_risco) == (None, None, None, 1, None)


def test_no_common_year_scores_nothing(spark):
    stg = staging(spark, cat=[(2010, "8610", "1", "A", "típico", True, "M")], rais=[(2020, "SP", "41204", "1", 9)])
    assert MARTS["mart_score_risco_cnae"](stg).count() == 0
    assert MARTS["mart_cnae_sem_score"](stg).count() == 2


def test_male_share_may_pass_one_hundred(spark):
    stg = staging(
        spark,
        cat=[(2020, "8610", "1", "A", "típico", False, "M"), (2020, "8610", "1", None, "típico", True, "M"), (2020, "8610", "2", None, "típico", True, "M")],
        rais=[(2020, "SP", "86101", "1", 100)],
    )
    (row,) = MARTS["mart_perfil_risco_cnae"](stg).collect()
    assert (row.cbo_codigo, row.acidentes_cbo, row.obitos_cbo, row.acidentes_cbo_m, row.pct_masculino_cbo) == ("1", 1, 0, 2, 200.0)


def test_dominance_by_row_and_by_sum_differ(spark):
    stg = staging(
        spark,
        rais=[(2020, "SP", "41204", "1", 10), (2020, "SP", "86101", "1", 6), (2021, "SP", "86101", "1", 6), (2020, "RJ", "41204", "2", 5), (2020, "RJ", "11111", "2", 5)],
    )
    assert rows(marts.dominant_class(stg).select("cbo_codigo", "cnae_classe")) == [("1", "41204"), ("2", "11111")]
    assert rows(marts.dominant_class(stg, "sum").select("cbo_codigo", "cnae_classe")) == [("1", "86101"), ("2", "11111")]


def test_comorbidity_base_counts_each_death_once(spark):
    stg = staging(
        spark,
        rais=[(2020, "SP", "86101", "1", 10)],
        sim=[("1", 3, "*I10X*E149"), ("1", 1, "*S720"), ("1", 2, "* i10x * I10X"), ("1", 4, None), ("9", 5, "*I10X")],
    )
    got = MARTS["mart_comorbidades_por_cnae"](stg).select(
        "cid_comorbidade", "total_obitos_com_comorbidade", "total_obitos_com_linhaii", "pct_obitos_com_comorbidade", "rank_comorbidade"
    )
    assert rows(got) == [("E14.9", 3, 6, 50.0, 2), ("I10", 7, 6, 116.67, 1)]
