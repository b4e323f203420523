"""A layer is a lazily filled set of named DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from occrisk.plans import versions


class Layer:
    """``layer[name]`` builds a DataFrame once and hands out the same plan after.

    Sharing the plan object lets Spark reuse its exchanges when one query reads
    the same relation twice.
    """

    def __init__(self, build: Callable[[str], DataFrame]):
        self._build = build
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        """Whether the relation has been put or built already."""
        return name in self._built

    def put(self, name: str, df: DataFrame) -> None:
        """Hand out ``df`` under a name of its own from now on."""
        self._built[name] = df

    @classmethod
    def of_parquet(cls, spark: SparkSession, root: str) -> Layer:
        """Layer materialised as ``root/<name>``: Parquet folders, or newest snapshots of years."""
        return cls(lambda name: versions.read(spark, f"{root}/{name}"))
