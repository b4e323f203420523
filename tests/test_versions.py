"""Tables of snapshots: years of one load appear together."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from test_records import _files_read
from occrisk.plans import loads, versions
from occrisk.plans.layers import Layer


def table(spark, years, mark, **more):
    return spark.createDataFrame([(y, f"{mark}{i}") for y in years for i in range(3)], "ano int, v string").withColumns({k: F.lit(v) for k, v in more.items()})


def marks(df):
    return rows(df.groupBy("ano").agg(F.min(F.left("v", F.lit(1))).alias("m")))


@pytest.fixture()
def path(spark, tmp_path):
    target = str(tmp_path / "t")
    assert versions.replace_years(table(spark, [2020, 2021, 2022], "a"), target) == 1
    return target


def test_years_of_a_load_appear_together(spark, path):
    assert marks(versions.read(spark, path)) == [(2020, "a"), (2021, "a"), (2022, "a")]
    assert versions.replace_years(table(spark, [2021, 2022, 2023], "b", w="x"), path) == 2
    now = versions.read(spark, path)
    assert marks(now) == [(2020, "a"), (2021, "b"), (2022, "b"), (2023, "b")]
    # a column that came later is NULL before; earlier snapshots stay as they were
    assert now.filter("w is null").count() == 3
    assert marks(versions.read(spark, path, 1)) == [(2020, "a"), (2021, "a"), (2022, "a")]
    assert marks(Layer.of_parquet(spark, os.path.dirname(path))["t"]) == marks(now)


def test_years_prune_files(spark, path):
    whole, one = _files_read(versions.read(spark, path)), _files_read(versions.read(spark, path).filter("ano = 2021"))
    assert 0 < one < whole


def test_a_job_that_dies_leaves_the_old_state(spark, path):
    broken = table(spark, [2021, 2022], "b").repartition(4).withColumn(
        "v", F.when(F.col("ano") == 2022, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        versions.replace_years(broken, path)
    assert marks(versions.read(spark, path)) == [(2020, "a"), (2021, "a"), (2022, "a")]


def test_a_job_that_dies_before_its_snapshot(spark, path, monkeypatch):
    def die(*args):
        raise SystemExit

    monkeypatch.setattr(versions, "_add_snapshot", die)
    with pytest.raises(SystemExit):
        versions.replace_years(table(spark, [2020, 2021, 2022], "b"), path)
    monkeypatch.undo()
    assert marks(versions.read(spark, path)) == [(2020, "a"), (2021, "a"), (2022, "a")]
    # the next load goes on, and what the dead one wrote can be removed
    versions.replace_years(table(spark, [2022], "c"), path)
    assert len(versions.clean(spark, path)) == 1
    assert marks(versions.read(spark, path)) == [(2020, "a"), (2021, "a"), (2022, "c")]


def test_two_writers_are_told_apart(spark, path):
    number = versions.snapshots(spark, path)[-1] + 1
    versions._add_snapshot(spark, path, number, {"2020": "x"})
    with pytest.raises(RuntimeError, match="another job"):
        versions._add_snapshot(spark, path, number, {"2020": "y"})
    assert versions.years_of(spark, path, number) == {"2020": "x"}


def test_whole_replacement_drops_other_years(spark, path):
    loads.replace_table(table(spark, [2030], "w"), path, "ano")
    assert marks(versions.read(spark, path)) == [(2030, "w")]
    assert rows(versions.years_present(spark, path).select("ano")) == [(2030,)]
    assert len(versions.clean(spark, path)) == 1 and versions.snapshots(spark, path) == [2]
    loads.replace_table(table(spark, [2030], "w").limit(0), path, "ano")
    assert versions.read(spark, path).count() == 0 and "v" in versions.read(spark, path).columns


def test_reload_of_pending_years(spark, tmp_path):
    target = str(tmp_path / "sim")
    old = table(spark, [2020, 2021], "a").withColumn("linha_a", F.when(F.col("ano") == 2020, "*A"))
    loads.replace_table(old, target, "ano")
    fresh = table(spark, [2020, 2021, 2022], "b").withColumn("linha_a", F.lit("*B"))
    assert rows(loads.reload_pending_years(spark, target, fresh, 2020, 2023)) == [(9, 2020, 2022, 9, 100)]
    assert marks(versions.read(spark, target)) == [(2020, "a"), (2021, "b"), (2022, "b")]


def test_a_year_that_is_null(spark, tmp_path):
    target = str(tmp_path / "t")
    versions.replace_years(spark.createDataFrame([(None, "n1"), (2020, "a1")], "ano int, v string"), target)
    assert marks(versions.read(spark, target)) == [(2020, "a"), (None, "n")]
    assert rows(versions.years_present(spark, target).select("ano")) == [(2020,), (None,)]
