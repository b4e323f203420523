"""The batch jobs end to end, from microdata and landed files to CSV."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR, rows
from test_landing import zip_to
from occrisk import jobs
from occrisk.config import LoadConfig
from occrisk.plans.marts import MARTS
from occrisk.plans.staging import staging_layer
from occrisk.plans.layers import Layer
from occrisk.sources.adapter import LAYOUT_CELLS, raw_layer

CONFIG = LoadConfig(
    rais_first_year=1900, rais_last_year=2100, cat_first_year=1900, cat_last_year=2100, sim_first_year=1900, sim_last_year=2100
)


@pytest.fixture()
def sources(spark, tmp_path):
    """Microdata tables and files written out from the adapter's raw tables."""
    raw, source, files = raw_layer(spark, SF_DIR), tmp_path / "source", tmp_path / "files"
    for table in ("dim_cnae", "dim_cbo", "dim_municipio"):
        raw[table].write.parquet(str(source / jobs.MICRODATA[table]))
    raw["rais_microdados"].write.partitionBy("ano").parquet(str(source / "rais"))
    raw["sim_microdados"].write.partitionBy("ano").parquet(str(source / "sim"))
    (files / "CAT").mkdir(parents=True)
    (files / "CID").mkdir()
    sheet = raw["grau_risco_sheet"].orderBy("linha").select(
        "nivel", "codigo", F.coalesce("gr", F.lit("")).alias("gr")
    )
    lines = ["Nível;Código;GR"] + [";".join(r) for r in sheet.collect()]
    (files / "grau_risco.csv").write_bytes("\n".join(lines).encode("cp1252"))
    for name, table, code in (("SUBCATEGORIAS", "dim_cid_subcat", "SUBCAT"), ("CATEGORIAS", "dim_cid_cat", "CAT")):
        body = [f"{code};DESCRICAO"] + [";".join(r) for r in raw[table].collect()]
        (files / "CID" / f"CID-10-{name}.CSV").write_bytes("\n".join(body).encode("cp1252"))
    by_file: dict[str, list] = {}
    for record in raw["landed_records"].collect():
        by_file.setdefault(record["path"], []).append(record["cells"])
    headers = {r["path"]: r["header"] for r in raw["landed_headers"].collect()}
    for path, records in by_file.items():
        width = len(headers[path])
        body = [headers[path]] + [[c or "" for c in (r if r[width] else r[:width])] for r in records]
        text = "\n".join(";".join(r) for r in body).encode("latin-1")
        zip_to(files / "CAT" / path.split("/")[-1], "CAT.CSV", text)
    assert set(LAYOUT_CELLS) == {"A", "B", "C"}
    return str(source), str(files)


def test_jobs_end_to_end(spark, sources, tmp_path):
    source, files = sources
    root = str(tmp_path / "root")
    first = jobs.ingest(spark, source, files, root, CONFIG)
    assert len(first) == 8 and set(first.values()) == {"loaded"}
    assert set(jobs.ingest(spark, source, files, root, CONFIG).values()) == {"skipped"}

    raw = raw_layer(spark, SF_DIR)
    stored = Layer.of_parquet(spark, f"{root}/raw")
    for table in ("dim_cnae", "dim_cbo", "dim_cid", "fact_sim"):
        columns = raw[table].columns
        assert rows(stored[table].select(columns)) == rows(raw[table]), table
    good = raw["landed_notices"].filter("c_extra is null and trim(c_cnae) <> '' and trim(c_dmy) <> 'NaN'").count()
    assert stored["cat_microdados"].count() == good
    assert "ano" in stored["rais_vinculos"].columns

    stg, marts = jobs.build(spark, root)
    views = staging_layer(stored)
    # marts on bonds start from the reduced relation, which was made once
    for name in ("mart_score_risco_cnae", "mart_top_cbo_por_cnae", "mart_risco_doenca", "mart_mortalidade_por_cnae", "mart_perfil_risco_cnae"):
        assert not any("stg_fact_rais" in f for f in MARTS[name](stg).inputFiles()), name
    for name in MARTS:
        assert rows(marts[name]) == rows(MARTS[name](views)), name

    results = jobs.check(spark, root)
    assert results.count() == 33 and results.filter("status = 'ERROR'").count() == 0

    jobs.export_marts(spark, root)
    assert len(list((tmp_path / "root" / "export").glob("*.csv"))) == 11

    summary = jobs.reload_deaths(spark, source, root, CONFIG)
    assert summary.first()["pct"] == 100


def test_config_from_the_environment():
    assert LoadConfig.from_env({}) == LoadConfig()
    got = LoadConfig.from_env({"INGEST_UF": "RJ", "INGEST_ANO_INICIO": "2015", "INGEST_CAT_ANO_FIM": "2022"})
    assert (got.state, got.first_year, got.sim_first_year, got.cat_last_year, got.rais_first_year) == ("RJ", 2015, 2015, 2022, 2018)
