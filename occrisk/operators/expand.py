"""Wide-to-long expansion of code lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_codes(
    df: DataFrame, singles: dict[str, str], multiples: dict[str, str], separator: str, line: str, code: str, keep: Sequence[str]
) -> DataFrame:
    """One row per code of several code columns, in one scan.

    ``singles`` and ``multiples`` map a column to its line label.  A single
    column holds one code and is passed on as is, a multiple one is split on
    ``separator``; blank codes drop out.  Two generators in a row (lines, then
    tokens) replace a union of one scan per column.
    """
    lines = [
        F.struct(F.lit(label).alias("l"), F.array(F.col(name)).alias("c")) for name, label in singles.items()
    ] + [
        F.struct(F.lit(label).alias("l"), F.split(F.col(name), f"[{separator}]").alias("c"))
        for name, label in multiples.items()
    ]
    return (
        df.select(*keep, F.explode(F.array(*lines)).alias("_line"))
        .select(*keep, F.col("_line.l").alias(line), F.explode("_line.c").alias("_code"))
        .select(*keep, line, F.trim("_code").alias(code))
        .filter(F.col(code) != "")
    )
