"""Landed catalogues of published files: which files a load wants.

A catalogue is a JSON document per package, landed as published:
``{"result": {"resources": [{"url": ..., "format": ..., "name": ...}, ...]}}``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.functions import text
from occrisk.sources import landing

SCHEMA = "result struct<resources: array<struct<url: string, format: string, name: string>>>"
# FIXED VALUES: formats that are loaded.
FORMATS = ("CSV", "ZIP")


def read_catalogues(spark: SparkSession, directory: str) -> DataFrame:
    """Entries of all documents: url, formato, nome, and their order (catalogo, posicao)."""
    documents = spark.read.schema(SCHEMA).option("multiLine", "true").json(directory)
    entries = documents.select(F.col("_metadata.file_name").alias("catalogo"), F.posexplode("result.resources").alias("posicao", "r"))
    return entries.select("catalogo", "posicao", F.coalesce("r.url", F.lit("")).alias("url"), F.col("r.format").alias("formato"), F.col("r.name").alias("nome"))


def wanted(entries: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """First entry of every URL, if its format is one that is loaded and its URL tells a year in the range."""
    once = landing.first_per_url(entries, [F.col("catalogo"), F.col("posicao")])
    year = text.year_of_file(F.col("url"))
    return once.withColumn("ano", year).filter(F.upper("formato").isin(*FORMATS) & F.col("ano").between(first_year, last_year))


def file_names(spark: SparkSession, directory: str, first_year: int, last_year: int) -> list[str]:
    """Names of the wanted files.  Spark plans a scan from the names of its files, so these reach the driver anyway."""
    chosen = wanted(read_catalogues(spark, directory), first_year, last_year)
    names = [r[0] for r in chosen.select(F.substring_index("url", "/", -1)).distinct().collect()]
    if not names:
        raise ValueError(f"no wanted files for {first_year}-{last_year} in the catalogues of {directory}")
    return names
