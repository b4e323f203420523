"""Profiling of source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.plans.layers import Layer

SAMPLE_ROWS = 3

# Neutral names of column types; the rest keeps Spark's name.
TYPE_NAMES = {"string": "texto", "int": "inteiro", "bigint": "inteiro", "double": "decimal", "date": "data", "timestamp": "instante"}


def profile(tables: Layer, names: list[str]) -> DataFrame:
    """One row per column of every table: position, type, table rows, filled cells, sample.

    The sample joins the cells of the table's first rows, in the order of all
    its columns; each task keeps that many rows only.  A table that cannot be
    read has one row, at position 0, that tells why; the others go on.
    """

    def one(name: str) -> DataFrame:
        try:
            df = tables[name]
            df.schema  # noqa: B018 - resolves the source
        except AnalysisException as exc:
            return df_of_error(name, exc.getCondition() or str(exc))
        counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f.name)).alias(f.name) for f in df.schema])
        first = df.orderBy(*df.columns).limit(SAMPLE_ROWS).agg(F.array_sort(F.collect_list(F.struct(*df.columns))).alias("_first"))
        columns = [
            F.struct(
                F.lit(name).alias("tabela"),
                F.lit(i).alias("posicao"),
                F.lit(f.name).alias("coluna"),
                F.lit(TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())).alias("tipo"),
                F.col("_rows").alias("linhas"),
                F.col(f.name).alias("preenchidas"),
                F.array_join(F.col("_first").getField(f.name).cast("array<string>"), " | ").alias("amostra"),
                F.lit(None).cast("string").alias("erro"),
            )
            for i, f in enumerate(df.schema, start=1)
        ]
        # both sides are one aggregated row
        return counts.withColumn("_one", F.lit(1)).join(first.withColumn("_one", F.lit(1)), "_one").select(F.inline(F.array(*columns)))

    def df_of_error(name: str, error: str) -> DataFrame:
        spark = SparkSession.active()
        row = (name, 0, None, None, None, None, None, error)
        return spark.createDataFrame([row], "tabela string, posicao int, coluna string, tipo string, linhas bigint, preenchidas bigint, amostra string, erro string")

    return reduce(DataFrame.unionByName, [one(n) for n in names])
