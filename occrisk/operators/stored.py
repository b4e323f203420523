"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Folder of the job that runs, if it has opened one.
_JOB: ContextVar[str | None] = ContextVar("job folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The job's folder, else ``spark.checkpoint.dir``.

    Only where neither is set and everything runs in one process, as in tests, a
    folder of this process takes their place.
    """
    folder = _JOB.get() or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir is not set: executors have no common folder for intermediate tables")
    return os.path.join(tempfile.gettempdir(), f"occrisk-{os.getpid()}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark knows."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def intermediate_tables(spark: SparkSession, default: str) -> Iterator[str]:
    """Tables stored inside live in a folder of their own until the end.

    The folder lies below ``spark.checkpoint.dir``, or ``default`` if that is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or default
    folder = f"{base.rstrip('/')}/job-{uuid.uuid4().hex}"
    token = _JOB.set(folder)
    try:
        yield folder
    finally:
        _JOB.reset(token)
        remove(spark, folder)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write the rows and read them back: a job runs when this is called.

    For a small reduced relation that a plan uses more than once: what lies
    below it runs once, and an executor lost later does not bring it back.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
