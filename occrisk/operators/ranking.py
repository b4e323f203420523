"""Top-N and ranks.

Top-N windows are planned with WindowGroupLimit: each task keeps N rows per
group before the shuffle, so a hot group never gathers in one task.  Full ranks
sort the aggregated rows into ranges that Spark draws from the data, number them
inside each range, and add what lies ahead from one count per range: groups of
any size and shape spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from occrisk.operators.stored import stored


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    numbered = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(rank, numbered).filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("bigint"))


def rank_in_group(
    df: DataFrame, keys: Sequence[str], measure: str, code: str, rank: str, total: str | None = None
) -> DataFrame:
    """Number the rows of each group 1..n by ``measure`` descending, then ``code``.

    With ``total``, the group's sum of the measure is added under that name.

    ``df`` holds one row per (keys, code); its rows are ranged by group,
    measure and code, so a hot group is cut wherever it is long.  A row's number
    is its place in its range plus the group's rows in the ranges ahead.
    """
    rows = _ranged(df, [*keys, F.desc(measure), code])
    counts = rows.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.sum(measure).alias("_sum"))
    # at most one row per group and range
    ahead = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    added = {"_ahead": F.coalesce(F.sum("_n").over(ahead), F.lit(0))}
    if total:
        added[total] = F.sum("_sum").over(Window.partitionBy(*keys))
    counts = counts.withColumns(added).drop("_n", "_sum")
    inside = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(F.desc(measure), code))
    numbered = rows.withColumn("_at", inside).join(counts, [*keys, "_part"])
    return numbered.withColumn(rank, F.col("_ahead") + F.col("_at")).drop("_part", "_at", "_ahead")


def _ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in ranges of similar size by ``order``, told by ``_part``; stored, so that all uses see the same ranges."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "ranged")


def global_rank(df: DataFrame, value: str, rank: str) -> DataFrame:
    """Rank (ties share, gaps follow) over the whole relation.

    The rank of a value is one plus the number of rows above it: those above it
    in its range of distinct values, and those of the ranges ahead.  The only
    window without a key runs over one count per range.  ``df`` should be a
    reduced relation; it is stored, so that its sources are read once.
    """
    kept = stored(df, "measured")
    levels = _ranged(kept.groupBy(value).agg(F.count(F.lit(1)).alias("_n")), [F.desc(value)])
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = levels.groupBy("_part").agg(F.sum("_n").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    above = Window.partitionBy("_part").orderBy(F.desc(value)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = levels.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0))).join(before, "_part")
    return kept.join(ranks.select(value, (F.lit(1) + F.col("_ahead") + F.col("_above")).alias(rank)), value, "left")


def nested_top_n(
    df: DataFrame, outer: str, inner: str, leaf: str, measure: str, n_outer: int, n_inner: int, rank_outer: str, rank_inner: str
) -> DataFrame:
    """Top ``n_outer`` inner keys per outer key, and top ``n_inner`` leaves in each.

    The leaf rank does not depend on the inner rank, so both cuts are taken
    independently and then joined: each side is already small.
    """
    total = f"{measure}_{inner}"
    heads = top_n(
        df.groupBy(outer, inner).agg(F.sum(measure).alias(total)),
        [outer], [F.desc(total), F.asc(inner)], n_outer, rank_outer,
    )
    leaves = top_n(df, [outer, inner], [F.desc(measure), F.asc(leaf)], n_inner, rank_inner)
    return leaves.join(heads, [outer, inner], "inner")
