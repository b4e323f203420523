"""Session settings this library is tuned for."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Every entry is a Spark setting; a cluster's own values win where they are set.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # The JVM interprets, and never compiles, methods beyond 8000 bytes of byte
    # code.  Wide projections fused into one such method run several times
    # slower than unfused ones, whose expressions are split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Without it every column expression notes its place in the code, which
    # takes longer than planning the query does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """Give Python tasks this package, once per application, unless it came as an archive (--py-files) already."""
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if context.applicationId not in _SHIPPED and package.is_dir():
        archive = os.path.join(tempfile.mkdtemp(prefix="code-"), f"{package.name}-tasks.zip")
        with zipfile.ZipFile(archive, "w") as files:
            for file in sorted(package.rglob("*.py")):
                files.write(file, file.relative_to(package.parent))
        context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g", partitions: int = 8) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("occrisk")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .getOrCreate()
    )
