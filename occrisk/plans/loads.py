"""Idempotent and year-incremental loads.

The ledger is an append-only Parquet table of load events; the newest event of
a load id is its state.  Tables stored by year are kept as snapshots
(`plans/versions.py`): the years of one load appear together.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.plans import versions

RUNNING, SUCCESS, FAILED = "running", "success", "error"
MAX_ERROR_TEXT = 2000

# FIXED VALUES: column contract of the ledger.
LEDGER_SCHEMA = (
    "id string, table_name string, partition_dt string, file_name string, checksum string, "
    "started_at timestamp, finished_at timestamp, status string, rows_loaded bigint, error_msg string"
)
# FIXED VALUES: columns that older deaths tables lack.
LATER_COLUMNS = ("linha_a", "linha_b", "linha_c", "linha_d")


# --- ledger ----------------------------------------------------------------------

def checksum(label: str | Column) -> Column:
    """Identity of a load: hash of its source label, not of its content."""
    return F.md5(F.lit(label) if isinstance(label, str) else label)


def ledger_state(events: DataFrame) -> DataFrame:
    """Newest event per load id; a final status wins over a simultaneous start."""
    newest = F.struct(F.coalesce("finished_at", "started_at"), F.col("status") != RUNNING)
    fields = F.struct(*[c for c in events.columns if c != "id"])
    return events.groupBy("id").agg(F.max_by(fields, newest).alias("_e")).select("id", "_e.*")


def pending(manifest: DataFrame, events: DataFrame, label: str, force: bool = False) -> DataFrame:
    """Manifest rows (``table_name`` and a label column) not yet loaded successfully."""
    if force:
        return manifest
    done = ledger_state(events).filter(F.col("status") == SUCCESS).select("table_name", "checksum").distinct()
    keyed = manifest.withColumn("checksum", checksum(F.col(label)))
    return keyed.join(done, ["table_name", "checksum"], "left_anti").select(*manifest.columns)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _append(spark: SparkSession, path: str, **event) -> None:
    names = [field.split()[0] for field in LEDGER_SCHEMA.split(", ")]
    row = spark.createDataFrame([tuple(event.get(n) for n in names)], LEDGER_SCHEMA)
    row.write.mode("append").parquet(path)


def create_ledger(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([], LEDGER_SCHEMA).write.mode("ignore").parquet(path)


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Drop the old contents and write the new ones.

    Rows are first brought together by partition; Spark splits large partitions
    by their measured size, so files are neither tiny nor written by one task.
    A table stored by year gets a new snapshot instead.
    """
    if partition_by == versions.YEAR:
        versions.replace_years(df, path, whole=True)
    else:
        df.write.mode("overwrite").parquet(path)


def load_table(
    spark: SparkSession, ledger: str, table: str, label: str, build: Callable[[], DataFrame], target: str,
    force: bool = False, partition_by: str | None = None,
) -> str:
    """Replace ``target`` with ``build()`` unless the same label was loaded before.

    Returns ``skipped`` or ``loaded``; a failure is recorded and raised again.
    """
    manifest = spark.createDataFrame([(table, label)], "table_name string, label string")
    if pending(manifest, read_ledger(spark, ledger), "label", force).isEmpty():
        return "skipped"
    event = {
        "id": uuid.uuid4().hex,
        "table_name": table,
        "file_name": label,
        "checksum": spark.range(1).select(checksum(label)).first()[0],
        "started_at": datetime.now(timezone.utc),
    }
    _append(spark, ledger, status=RUNNING, **event)
    try:
        replace_table(build(), target, partition_by)
        loaded = versions.read(spark, target).count()
    except Exception as exc:
        _append(
            spark, ledger, status=FAILED, finished_at=datetime.now(timezone.utc),
            error_msg=str(exc)[:MAX_ERROR_TEXT], **event,
        )
        raise
    _append(spark, ledger, status=SUCCESS, finished_at=datetime.now(timezone.utc), rows_loaded=loaded, **event)
    return "loaded"


# --- year-incremental reload of the deaths table ---------------------------------

def with_later_columns(df: DataFrame, columns: tuple[str, ...] = LATER_COLUMNS) -> DataFrame:
    """Add the columns an older table lacks, as NULL text."""
    missing = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(missing) if missing else df


def pending_years(table: DataFrame, first_year: int, last_year: int, marker: str = "linha_a") -> DataFrame:
    """Years of the range in which no row has ``marker`` filled."""
    wanted = table.sparkSession.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("ano"))
    done = with_later_columns(table, (marker,)).filter(F.col(marker).isNotNull()).select("ano").distinct()
    return wanted.join(done, "ano", "left_anti")


def replaced(table: DataFrame, fresh: DataFrame, todo: DataFrame, year: str = "ano") -> DataFrame:
    """What ``replace_years`` leaves, as a set operation: fresh rows of the years to do, else the table's own.

    A year to do without fresh rows keeps what it has.
    """
    taken = fresh.join(todo, year, "left_semi")
    kept = table.join(taken.select(year).distinct(), year, "left_anti")
    return kept.unionByName(taken, allowMissingColumns=True)


def replace_years(df: DataFrame, path: str, year: str = "ano") -> None:
    """Replace exactly the years present in ``df`` in an ordinary folder; other partitions stay untouched.

    One year is the unit of atomic replacement here.
    """
    (
        df.hint("rebalance", year)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(year)
        .parquet(path)
    )


def reload_pending_years(spark: SparkSession, path: str, fresh: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Replace every pending year of the table at ``path`` with the rows of ``fresh``.

    The pending years reach the source as a join key, so a source stored by
    year is pruned at run time.  All years are written by one job, and appear
    together if the table is one of snapshots; a year without fresh rows keeps
    what it has.  Returns the summary of the table.
    """
    known = versions.snapshots(spark, path)
    table = versions.read(spark, path) if known else spark.read.option("mergeSchema", "true").parquet(path)
    todo = pending_years(table, first_year, last_year)
    taken = fresh.join(todo, "ano", "left_semi")
    if known:
        versions.replace_years(taken, path)
        return load_summary(versions.read(spark, path))
    replace_years(taken, path)
    return load_summary(spark.read.option("mergeSchema", "true").parquet(path))


def load_summary(table: DataFrame, marker: str = "linha_a") -> DataFrame:
    """Rows, year range, rows with ``marker`` and their whole percentage."""
    rows, filled = F.count(F.lit(1)), F.count(marker)
    return with_later_columns(table, (marker,)).agg(
        rows.alias("linhas"),
        F.min("ano").cast("int").alias("ano_min"),
        F.max("ano").cast("int").alias("ano_max"),
        filled.alias(f"com_{marker}"),
        F.when(rows > 0, F.call_function("div", filled * 100, rows)).alias("pct"),
    )
