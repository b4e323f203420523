"""A data source that many tasks write one file with.

Every row says at which byte its data belongs, so it does not matter which task
writes it, in what order, or how often: a repeated or speculative attempt puts the
same bytes in the same place.  The file takes its name when all tasks are done.

The target must be a folder that driver and executors mount under one path.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from occrisk.session import shipped


def mounted_path(path: str) -> str | None:
    """Path for the operating system, or None for a store that only Spark reaches."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    return None if "://" in path else path


@dataclass
class Written(WriterCommitMessage):
    rows: int


class _Placer(DataSourceWriter):
    def __init__(self, work: str, target: str):
        self.work, self.target = work, target

    def write(self, iterator: Iterator[Row]) -> Written:
        file, rows = os.open(self.work, os.O_WRONLY), 0
        try:
            for row in iterator:
                data, at = memoryview(bytes(row["data"])), row["offset"]
                while data:
                    done = os.pwrite(file, data, at)
                    data, at = data[done:], at + done
                rows += 1
            os.fsync(file)
        finally:
            os.close(file)
        return Written(rows)

    def commit(self, messages: list) -> None:
        os.replace(self.work, self.target)

    def abort(self, messages: list) -> None:
        if os.path.exists(self.work):
            os.remove(self.work)


class OneFile(DataSource):
    """Options ``work`` (the file tasks write to, which exists) and ``target``."""

    @classmethod
    def name(cls) -> str:
        return "onefile"

    def schema(self) -> str:
        return "offset bigint, data binary"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Placer(self.options["work"], self.options["target"])


def write_one_file(placed: DataFrame, head: bytes, size: int, target: str) -> None:
    """Write rows (offset, data) behind ``head`` into one file of ``size`` bytes, replacing it as a whole."""
    spark = shipped(placed.sparkSession)
    spark.dataSource.register(OneFile)
    os.makedirs(os.path.dirname(target), exist_ok=True)
    work = f"{target}.{uuid.uuid4().hex}.part"
    with open(work, "wb") as file:
        file.write(head)
        file.truncate(size)
    placed.select("offset", "data").write.format("onefile").mode("append").option("work", work).option("target", target).save()
