"""Exported files, intermediate tables."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from occrisk.operators import stored as tables
from occrisk.plans import export

NAME = "mart_top_cbo_por_cnae"


@pytest.fixture()
def mart(spark):
    """Rows of every type, with separators, quotes, breaks and NULLs."""
    n = F.col("id")
    return spark.range(0, 5000, 1, 7).select(
        F.when(n % 11 > 0, (n % 4).cast("int")).alias("grau_risco"),
        F.format_string("%05d", n % 900).alias("cnae_classe"),
        n.alias("rank_cbo"),
        F.when(n % 5 > 0, F.concat(F.lit('Fábrica, "Nº'), n.cast("string"), F.lit('"\nde aço;'))).alias("texto"),
        F.when(n % 3 > 0, n / 7).alias("taxa"),
        F.when(n % 2 > 0, n % 4 == 1).alias("marca"),
        F.date_add(F.lit("2020-01-01").cast("date"), (n % 900).cast("int")).alias("dia"),
    )


@pytest.fixture()
def many_parts(spark):
    """Small ranges stay apart, as large ones do."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def expected(mart) -> bytes:
    got = [r.asDict() for r in mart.collect()]
    got.sort(key=lambda r: (r["grau_risco"] is None, -(r["grau_risco"] or 0), r["cnae_classe"], r["rank_cbo"]))
    frame = pd.DataFrame(got, columns=mart.columns, dtype=object)
    return ("﻿" + frame.to_csv(index=False, lineterminator="\n")).encode()


def test_one_file_from_many_tasks(spark, mart, many_parts, tmp_path):
    export.export_csv(NAME, mart, str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out") == [f"{NAME}.csv"]
    assert (tmp_path / "out" / f"{NAME}.csv").read_bytes() == expected(mart)
    pieces = export.rendered(export.presented(NAME, mart))
    assert pieces.select("part").distinct().count() > 1
    # a second export replaces the file
    export.export_csv(NAME, mart.limit(0), f"file://{tmp_path}/out")
    assert (tmp_path / "out" / f"{NAME}.csv").read_bytes() == "﻿grau_risco,cnae_classe,rank_cbo,texto,taxa,marca,dia\n".encode()


def test_parts_are_the_file_cut(mart, many_parts, tmp_path):
    export.export_parts(NAME, mart, str(tmp_path / "parts"))
    parts = sorted((tmp_path / "parts").glob("part-*"))
    assert len(parts) > 1 and b"".join(p.read_bytes() for p in parts) == expected(mart)


def test_a_failed_export_leaves_the_old_file(spark, mart, tmp_path):
    export.export_csv(NAME, mart, str(tmp_path))
    before = (tmp_path / f"{NAME}.csv").read_bytes()
    with pytest.raises(Exception):
        export.export_csv(NAME, mart.withColumn("texto", F.raise_error(F.lit("broken")).cast("string")), str(tmp_path))
    assert (tmp_path / f"{NAME}.csv").read_bytes() == before and os.listdir(tmp_path) == [f"{NAME}.csv"]


def test_intermediate_tables_go_with_their_job(spark, tmp_path):
    with tables.intermediate_tables(spark, str(tmp_path / "root" / "work")) as folder:
        assert tables.stored(spark.range(5), "t").count() == 5
        assert os.listdir(folder)
    assert not os.path.exists(folder)


def test_executors_need_a_common_folder(spark, monkeypatch):
    context = type("Context", (), {"master": "yarn"})
    session = type("Session", (), {"conf": type("Conf", (), {"get": staticmethod(lambda *a: None)}), "sparkContext": context})
    with pytest.raises(ValueError, match="no common folder"):
        tables.shared_folder(session)
