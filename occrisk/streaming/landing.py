"""Incremental landing of notice files.

The streaming form of "skip what is already loaded": the file source remembers
in its checkpoint which files it has taken, and each run handles the new ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.functions import text
from occrisk.sources import landing, notices


def checkpoint_dir(spark: SparkSession, name: str, default: str | None = None) -> str:
    """Folder for a query's checkpoint below the session's shared folder."""
    shared = spark.conf.get("spark.checkpoint.dir", default)
    if not shared:
        raise ValueError("spark.checkpoint.dir is not set")
    return f"{shared.rstrip('/')}/{name}"


def landed(spark: SparkSession, target: str, first_year: int, last_year: int) -> DataFrame:
    """Landed rows, flagged, of the files whose name tells a year in the range."""
    rows = spark.read.parquet(f"{target}/rows")
    return rows.filter(text.year_of_file(F.col("_source_file")).between(first_year, last_year)).drop("batch")


def land_new_files(spark: SparkSession, directory: str, target: str, checkpoint: str) -> None:
    """Unify every new file of ``directory`` into ``target`` and stop.

    Files of all years are landed: the checkpoint remembers what it has taken,
    so a range applied here could never be widened.  ``landed`` applies it.

    Writes ``target/rows`` (good and quarantined rows in partitions of their
    own) and ``target/status``, partitioned by micro-batch.  A batch repeated
    after a failure overwrites its own partitions, so files are neither lost
    nor landed twice.
    """
    stream = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", "true")
        .load(directory)
    )
    name = F.substring_index("path", "/", -1)
    chosen = stream.filter(
        text.file_format(name).isin("CSV", "ZIP") & text.year_of_file(name).isNotNull()
    )

    def store(part: DataFrame, folder: str, batch_id: int, *more: str) -> None:
        (
            part.withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch", *more)
            .parquet(f"{target}/{folder}")
        )

    def land(batch: DataFrame, batch_id: int) -> None:
        cells = f"{target}/cells/batch={batch_id}"
        landing.parsed(batch).write.mode("overwrite").parquet(cells)  # each file is decoded once
        read = batch.sparkSession.read.parquet(cells)
        files = notices.manifest(landing.headers_of(read))
        rows = notices.unify(landing.records_of(read), files)
        store(notices.flag_quarantine(rows), "rows", batch_id, "em_quarentena")
        store(files.select("_source_file", "layout", "error"), "status", batch_id)

    query = (
        chosen.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
