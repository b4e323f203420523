"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share; a private one only where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or os.path.join(tempfile.gettempdir(), f"llm-shared-{os.getpid()}")


def stored(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write the rows to the shared folder and read them back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Give the executors this package (as --py-files would), once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{package.name}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark


# Odd 64-bit multipliers of a well-known finaliser (splitmix64).
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values; a bijection, so it adds no collisions."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX_A
    x ^= x >> np.uint64(27)
    x *= _MIX_B
    x ^= x >> np.uint64(31)
    return x
