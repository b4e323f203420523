"""Tables stored by year whose years are replaced together or not at all.

Every write goes to a folder of its own, ``version=<id>/ano=<year>``.  A snapshot is
a small file that names, for each year, the version that holds it.  A load first
writes its version and then adds the next snapshot, by one rename: a job that dies
before leaves the table as it was, whichever years it had written, and a reader
sees all years of a load or none.  Earlier snapshots stay readable until
``clean`` removes the versions that the newest one does not name.

Snapshots have one entry per year; no row passes the driver.
"""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

YEAR = "ano"
_FOLDER = "_snapshots"


def _path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """File system of a path, and the path."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(context._jsc.hadoopConfiguration()), target


def _names(spark: SparkSession, folder: str, mark: str) -> list[str]:
    fs, target = _path(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(n for s in fs.listStatus(target) if (n := s.getPath().getName()).startswith(mark))


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the snapshots, ascending; none if the table is not stored this way."""
    return sorted(int(n.removeprefix("s-")) for n in _names(spark, f"{path}/{_FOLDER}", "s-"))


def years_of(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    """Version that holds each year."""
    fs, target = _path(spark, f"{path}/{_FOLDER}/s-{number}")
    stream = fs.open(target)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _add_snapshot(spark: SparkSession, path: str, number: int, years: dict[str, str]) -> None:
    """Make a snapshot visible by one rename; another writer's snapshot of that number is an error."""
    fs, draft = _path(spark, f"{path}/{_FOLDER}/draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(years).encode()))
    finally:
        stream.close()
    _, target = _path(spark, f"{path}/{_FOLDER}/s-{number}")
    if fs.exists(target) or not fs.rename(draft, target) or years_of(spark, path, number) != years:
        fs.delete(draft, False)
        raise RuntimeError(f"{path} was replaced by another job meanwhile")


def replace_years(df: DataFrame, path: str, whole: bool = False) -> int:
    """Replace the years present in ``df``, all at once; with ``whole``, drop the others.

    Returns the number of the new snapshot.
    """
    spark = df.sparkSession
    known = snapshots(spark, path)
    before = {} if whole or not known else years_of(spark, path, known[-1])
    version = uuid.uuid4().hex
    df.hint("rebalance", YEAR).write.partitionBy(YEAR).parquet(f"{path}/version={version}")
    written = [n.removeprefix(f"{YEAR}=") for n in _names(spark, f"{path}/version={version}", f"{YEAR}=")]
    number = known[-1] + 1 if known else 1
    _add_snapshot(spark, path, number, before | dict.fromkeys(written, version))
    return number


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The newest snapshot, or the one of a number; an ordinary Parquet folder if there is none."""
    known = snapshots(spark, path)
    if not known:
        return spark.read.parquet(path)
    years = years_of(spark, path, known[-1] if number is None else number)
    folders = [f"{path}/version={version}/{YEAR}={year}" for year, version in sorted(years.items())]
    if not folders:  # a load without rows: its files still tell the columns
        versions = [f"{path}/{n}" for n in _names(spark, path, "version=")]
        return spark.read.parquet(*versions).limit(0)
    # years written by different loads may have different columns
    several = len(set(years.values())) > 1
    return spark.read.option("mergeSchema", str(several).lower()).option("basePath", path).parquet(*folders).drop("version")


def clean(spark: SparkSession, path: str) -> list[str]:
    """Remove what the newest snapshot does not name: older versions, and those of jobs that died."""
    known = snapshots(spark, path)
    if not known:
        return []
    kept = set(years_of(spark, path, known[-1]).values())
    gone = [n for n in _names(spark, path, "version=") if n.removeprefix("version=") not in kept]
    old = [f"{_FOLDER}/s-{n}" for n in known[:-1]] + [f"{_FOLDER}/{n}" for n in _names(spark, f"{path}/{_FOLDER}", "draft-")]
    for name in [*old, *gone]:  # snapshots first: none may name a version that is gone
        fs, target = _path(spark, f"{path}/{name}")
        fs.delete(target, True)
    return gone


def years_present(spark: SparkSession, path: str) -> DataFrame:
    """Years of the newest snapshot and the version of each, without a scan."""
    known = snapshots(spark, path)
    years = years_of(spark, path, known[-1]) if known else {}
    rows = [(int(y) if y.lstrip("-").isdigit() else None, v) for y, v in years.items()]
    return spark.createDataFrame(rows, f"{YEAR} int, version string").orderBy(F.col(YEAR))
