"""Ledger, incremental reload, export, materialisation."""

import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from occrisk.plans import export, loads, quality, warehouse
from occrisk.plans.layers import Layer
from occrisk.plans.marts import MARTS
from occrisk.plans.staging import staging_layer
from occrisk.sources import profile
from occrisk.sources.adapter import raw_layer


def fail():
    raise RuntimeError("x" * 3000)


def test_ledger_life_cycle(spark, tmp_path):
    ledger, target = str(tmp_path / "ledger"), str(tmp_path / "t")
    loads.create_ledger(spark, ledger)
    build = lambda: spark.range(7)
    assert loads.load_table(spark, ledger, "t", "src:2020-2023", build, target) == "loaded"
    assert loads.load_table(spark, ledger, "t", "src:2020-2023", fail, target) == "skipped"
    assert loads.load_table(spark, ledger, "t", "src:2020-2023", lambda: spark.range(3), target, force=True) == "loaded"
    assert spark.read.parquet(target).count() == 3
    with pytest.raises(RuntimeError):
        loads.load_table(spark, ledger, "t", "src:2020-2024", fail, target)
    assert loads.load_table(spark, ledger, "t", "src:2020-2024", build, target) == "loaded"
    state = loads.ledger_state(loads.read_ledger(spark, ledger))
    assert rows(state.select("status", "rows_loaded", F.length("error_msg"))) == [
        ("error", None, 2000), ("success", 3, None), ("success", 7, None), ("success", 7, None),
    ]
    assert state.filter("finished_at < started_at").count() == 0
    sums = {r[0] for r in state.select("checksum").collect()}
    assert hashlib.md5(b"src:2020-2023").hexdigest() in sums


def test_a_running_load_is_not_done(spark, tmp_path):
    events = spark.createDataFrame(
        [("1", "t", loads.RUNNING), ("2", "t", loads.FAILED)], "id string, table_name string, status string"
    ).withColumns({"checksum": loads.checksum("a"), "started_at": F.current_timestamp(), "finished_at": F.lit(None).cast("timestamp")})
    manifest = spark.createDataFrame([("t", "a"), ("t", "b")], "table_name string, label string")
    assert loads.pending(manifest, events, "label").count() == 2


def deaths(spark, years, filled):
    return spark.createDataFrame(
        [(y, f"c{i}", f"*A{i}" if filled else None) for y in years for i in range(3)], "ano int, cbo string, linha_a string"
    )


def test_only_pending_years_are_replaced(spark, tmp_path):
    path = tmp_path / "sim"
    old = deaths(spark, [2020, 2022], True).unionByName(deaths(spark, [2021], False)).drop("dummy")
    old.write.partitionBy("ano").parquet(str(path))
    def files(year):
        return {p.name: p.read_bytes() for p in (path / f"ano={year}").glob("*.parquet")}

    before = {y: files(y) for y in (2020, 2021, 2022)}
    assert rows(loads.pending_years(spark.read.parquet(str(path)), 2020, 2023)) == [(2021,), (2023,)]
    fresh = deaths(spark, range(2020, 2024), True).withColumn("linha_b", F.lit("*B"))
    summary = loads.reload_pending_years(spark, str(path), fresh, 2020, 2023)
    assert rows(summary) == [(12, 2020, 2023, 12, 100)]
    assert files(2020) == before[2020] and files(2022) == before[2022] and files(2021) != before[2021]
    table = spark.read.option("mergeSchema", "true").parquet(str(path))
    assert "linha_b" in table.columns and table.filter("linha_b is not null").count() == 6
    assert loads.pending_years(table, 2020, 2023).count() == 0


def test_summary_of_an_empty_or_old_table(spark):
    old = deaths(spark, [2020], True).drop("linha_a")
    assert rows(loads.load_summary(old)) == [(3, 2020, 2020, 0, 0)]
    assert rows(loads.load_summary(old.limit(0))) == [(0, None, None, 0, None)]
    assert loads.with_later_columns(old).columns == ["ano", "cbo", *loads.LATER_COLUMNS]


def test_export_is_ordered_and_marked(spark, tmp_path):
    df = spark.createDataFrame(
        [("b", 'di"z', 1), ("a", None, 2), ("c", "", None)], "cnae_classe string, texto string, n int"
    )
    export.export_csv("mart_cnae_sem_score", df.repartition(3), str(tmp_path))
    file = tmp_path / "mart_cnae_sem_score.csv"
    assert file.read_bytes().startswith(b"\xef\xbb\xbfcnae_classe,texto,n")
    assert file.read_text("utf-8-sig").splitlines() == ["cnae_classe,texto,n", "a,,2", 'b,"di""z",1', "c,,"]


def test_presentation_order_covers_the_marts():
    assert set(export.PRESENTATION_ORDER) == set(MARTS) - {"mart_cat_cnae_cbo_mes"}
    assert set(export.EXPORTED_MARTS) <= set(MARTS) and len(export.EXPORTED_MARTS) == 11


def test_score_is_presented_by_score_then_accidents(spark):
    df = spark.createDataFrame([(None, 9), (5, 1), (5, 7), (2, 3)], "score_risco int, acidentes_trabalho int")
    assert [tuple(r) for r in export.presented("mart_score_risco_cnae", df).collect()] == [(5, 7), (5, 1), (2, 3), (None, 9)]


def test_stored_marts_equal_the_plans(spark, tmp_path):
    raw = raw_layer(spark, SF_DIR)
    stg, marts = warehouse.build(spark, raw, str(tmp_path))
    views = staging_layer(raw)
    for name, build in MARTS.items():
        assert rows(marts[name]) == rows(build(views)), name
    plan = MARTS["mart_score_risco_cnae"](stg)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan  # the common years prune both facts
    results = quality.report(quality.tables_of(stg, marts))
    assert results.count() == len(quality.CHECKS) == 33
    assert rows(quality.summary(results)) == [(32, 1, 0)]


def test_checks_count_failures(spark):
    tables = {
        "stg_dim_cid": spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "cid_codigo string"),
        "stg_sim_linhas": spark.createDataFrame([("a",), ("x",), ("x",), ("y",), (None,)], "fonte_linha string"),
        "stg_fact_rais": spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "cnae_subclasse string"),
        "stg_dim_cnae": spark.createDataFrame([("1",), (None,)], "cnae_subclasse string"),
    }
    chosen = [
        c for c in quality.CHECKS
        if (c.model, c.kind) in {("stg_dim_cid", "unique"), ("stg_dim_cid", "not_null"), ("stg_sim_linhas", "accepted_values"), ("stg_fact_rais", "relationships")}
    ]
    got = {(r["modelo"], r["teste"]): (r["falhas"], r["status"]) for r in quality.report(tables.__getitem__, chosen).collect()}
    assert got == {
        ("stg_dim_cid", "unique"): (1, "ERROR"),
        ("stg_dim_cid", "not_null"): (2, "ERROR"),
        ("stg_sim_linhas", "accepted_values"): (2, "ERROR"),
        ("stg_fact_rais", "relationships"): (2, "WARN"),
    }


def test_profile_and_sample(spark):
    good = spark.createDataFrame([(1, None), (2, "x"), (3, "y"), (4, "z")], "a int, b string")
    layer = Layer(lambda name: good if name == "t" else spark.read.parquet(f"/no/such/{name}"))
    assert rows(profile.profile(layer, ["gone", "t"])) == [
        ("gone", 0, None, None, None, None, None, "PATH_NOT_FOUND"),
        ("t", 1, "a", "inteiro", 4, 4, "1 | 2 | 3", None), ("t", 2, "b", "texto", 4, 3, "x | y", None),
    ]
