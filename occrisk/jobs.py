"""Batch jobs: ingest, land new files, build, check, export, reload deaths.

    spark-submit --py-files occrisk.zip occrisk/jobs.py build --root s3a://...

Each job reads and writes below one root folder: ``raw``, ``stg``, ``mart``,
``ledger``, ``export``.  Sources are two folders: Parquet microdata tables and
landed files.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.config import LoadConfig
from occrisk.operators.stored import intermediate_tables, stored
from occrisk.plans import export, loads, quality, versions, warehouse
from occrisk.plans.layers import Layer
from occrisk.sources import catalogue, dictionaries, landing, microdata, notices
from occrisk.streaming.landing import checkpoint_dir, land_new_files
from occrisk.streaming.ledger import STUCK, known_outcomes, watch_ledger

# Folders below the microdata source.
MICRODATA = {
    "dim_cnae": "cnae_2", "dim_cbo": "cbo_2002", "dim_municipio": "municipio",
    "rais_vinculos": "rais", "fact_sim": "sim",
}
# Facts stored by year, so that year filters prune and years can be replaced.
STORED_BY_YEAR = {"rais_vinculos": "ano", "fact_sim": "ano"}


def _deaths(spark: SparkSession, source: str, config: LoadConfig) -> DataFrame:
    table = spark.read.parquet(f"{source}/{MICRODATA['fact_sim']}")
    return microdata.aggregate_deaths(table, [config.state], config.sim_first_year, config.sim_last_year)


def _grades(spark: SparkSession, path: str) -> DataFrame:
    sheet = landing.named_records(spark, path, ["Nível", "Código", "GR"]).withColumnsRenamed(
        {"Nível": "nivel", "Código": "codigo", "GR": "gr"}
    )
    return dictionaries.risk_grades(sheet, F.col("record"))


def _diagnoses(spark: SparkSession, files: str) -> DataFrame:
    return dictionaries.diagnosis_dictionary(
        landing.named_records(spark, f"{files}/CID-10-SUBCATEGORIAS.CSV", ["SUBCAT", "DESCRICAO"]),
        landing.named_records(spark, f"{files}/CID-10-CATEGORIAS.CSV", ["CAT", "DESCRICAO"]),
    )


def raw_tables(
    spark: SparkSession, source: str, files: str, root: str, config: LoadConfig, listed: str | None = None
) -> dict[str, tuple[str, Callable[[], DataFrame]]]:
    """Raw table -> (source label, builder); the label decides what counts as loaded."""
    tables = {
        name: (f"microdata:{MICRODATA[name]}", lambda n=name: microdata.dimension(spark.read.parquet(f"{source}/{MICRODATA[n]}"), n))
        for name in ("dim_cnae", "dim_cbo", "dim_municipio")
    }
    tables["dim_grau_risco"] = ("file:grau_risco.csv", lambda: _grades(spark, f"{files}/grau_risco.csv"))
    tables["dim_cid"] = ("file:cid", lambda: _diagnoses(spark, f"{files}/CID"))
    tables["rais_vinculos"] = (
        f"rais.BR.{config.rais_first_year}-{config.rais_last_year}",
        lambda: microdata.aggregate_bonds(
            spark.read.parquet(f"{source}/{MICRODATA['rais_vinculos']}"), config.rais_first_year, config.rais_last_year
        ),
    )
    tables["fact_sim"] = (
        f"sim.{config.state}.{config.sim_first_year}-{config.sim_last_year}", lambda: _deaths(spark, source, config)
    )
    tables["cat_microdados"] = (
        f"cat.BR.{config.cat_first_year}-{config.cat_last_year}",
        lambda: notices.land_notices(
            spark, f"{files}/CAT", f"{root}/landed", config.cat_first_year, config.cat_last_year, date.today().isoformat(),
            catalogue.file_names(spark, listed, config.cat_first_year, config.cat_last_year) if listed else None,
        ),
    )
    return tables


def ingest(
    spark: SparkSession, source: str, files: str, root: str, config: LoadConfig, force: bool = False, listed: str | None = None
) -> dict[str, str]:
    """Load every raw table that the ledger does not list as loaded.

    With ``listed``, a folder of landed catalogues, only notice files that they list are opened.
    """
    ledger = f"{root}/ledger"
    loads.create_ledger(spark, ledger)
    return {
        name: loads.load_table(
            spark, ledger, name, label, build, f"{root}/raw/{name}", force, STORED_BY_YEAR.get(name)
        )
        for name, (label, build) in raw_tables(spark, source, files, root, config, listed).items()
    }


def build(spark: SparkSession, root: str) -> tuple[Layer, Layer]:
    """Stored staging relations and all marts."""
    return warehouse.build(spark, Layer.of_parquet(spark, f"{root}/raw"), root)


def check(spark: SparkSession, root: str) -> DataFrame:
    """Result of every data check on the stored relations."""
    raw, stored = Layer.of_parquet(spark, f"{root}/raw"), Layer.of_parquet(spark, f"{root}/stg")
    stg = warehouse.stored_layer(stored, raw)
    return quality.report(quality.tables_of(stg, Layer.of_parquet(spark, f"{root}/mart")))


def export_marts(spark: SparkSession, root: str) -> None:
    marts = Layer.of_parquet(spark, f"{root}/mart")
    for name in export.EXPORTED_MARTS:
        export.export_csv(name, marts[name], f"{root}/export")


def reload_deaths(spark: SparkSession, source: str, root: str, config: LoadConfig) -> DataFrame:
    """Replace the years whose certificate lines are still missing."""
    return loads.reload_pending_years(
        spark, f"{root}/raw/fact_sim", _deaths(spark, source, config), config.sim_first_year, config.sim_last_year
    )


def clean(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Remove replaced versions of the tables stored by year; run it when no job reads them."""
    folders = [f"{root}/raw/{name}" for name in STORED_BY_YEAR] + [f"{root}/stg/{name}" for name in warehouse.STORED_BY_YEAR]
    return {folder: versions.clean(spark, folder) for folder in folders}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["ingest", "land-new", "build", "check", "export", "reload-deaths", "clean", "watch-ledger"])
    parser.add_argument("--root", required=True)
    parser.add_argument("--source", help="folder of Parquet microdata tables")
    parser.add_argument("--files", help="folder of landed files")
    parser.add_argument("--catalogue", help="folder of landed catalogues; only files that they list are opened")
    parser.add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    spark, config = SparkSession.builder.getOrCreate(), LoadConfig.from_env()
    with intermediate_tables(spark, f"{args.root}/work"):
        return run(spark, args, config)


def run(spark: SparkSession, args: argparse.Namespace, config: LoadConfig) -> int:
    """One job; what it stores on the way is removed when it ends."""
    if args.job == "ingest":
        for name, outcome in ingest(spark, args.source, args.files, args.root, config, args.force, args.catalogue).items():
            print(name, outcome)
    elif args.job == "land-new":
        land_new_files(spark, f"{args.files}/CAT", f"{args.root}/stream", checkpoint_dir(spark, "notices", f"{args.root}/checkpoints"))
    elif args.job == "build":
        build(spark, args.root)
    elif args.job == "check":
        results = stored(check(spark, args.root), "checks")  # listed and summed from one run
        results.filter(F.col("falhas") > 0).show(100, truncate=False)
        totals = quality.summary(results).first()
        print(f"PASS={totals['pass']} WARN={totals['warn']} ERROR={totals['error']}")
        return 1 if totals["error"] else 0
    elif args.job == "watch-ledger":
        outcomes = f"{args.root}/outcomes"
        watch_ledger(spark, f"{args.root}/ledger", outcomes, checkpoint_dir(spark, "ledger", f"{args.root}/checkpoints"))
        known_outcomes(spark, outcomes).filter(F.col("status") == STUCK).show(truncate=False)
    elif args.job == "clean":
        for folder, gone in clean(spark, args.root).items():
            print(folder, len(gone))
    elif args.job == "export":
        export_marts(spark, args.root)
    else:
        reload_deaths(spark, args.source, args.root, config).show()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
