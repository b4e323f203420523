"""One row per key: keep-first, dominant key, attribution, mode per group.

Ties are always broken by the smallest code, so results do not depend on
partitioning.  Facts are reduced by a hash aggregation on fixed-width buffers
before any ``min`` over a struct: that one needs a sort-based aggregate, which
must only ever see pre-aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """Keep, per key, the row that comes first in ``order``, then in ``keep``.

    Equal rows are folded by a hash aggregation first.  Its count is tested so
    that Catalyst, which knows a minimum to ignore duplicates, does not fold
    that step away and sort the raw rows instead.
    """
    ranks = {f"_o{i}": col for i, col in enumerate(order)}
    folded = (
        df.select(*keys, *keep, *[col.alias(name) for name, col in ranks.items()])
        .groupBy(*keys, *keep, *ranks)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 0)
    )
    best = folded.groupBy(*keys).agg(F.min(F.struct(*ranks, *keep)).alias("_first"))
    return best.select(*keys, *[F.col(f"_first.{name}").alias(name) for name in keep])


def dominant_key(df: DataFrame, by: str, pick: str, weight: str, mode: str = "max_row") -> DataFrame:
    """Map each ``by`` to the ``pick`` of greatest weight.

    ``max_row`` compares single rows, ``sum`` compares totals per pair.  Both
    first collapse to one row per (by, pick) with map-side combine, so a hot
    ``by`` never travels as raw rows.
    """
    reduce_weight = {"max_row": F.max, "sum": F.sum}[mode]
    pairs = (
        df.filter(F.col(by).isNotNull() & F.col(pick).isNotNull())
        .groupBy(by, pick)
        .agg(reduce_weight(weight).alias("_weight"))
    )
    top = F.min(F.struct((-F.col("_weight")).alias("w"), F.col(pick).alias("pick"))).alias("_top")
    return pairs.groupBy(by).agg(top).select(by, F.col("_top.pick").alias(pick), (-F.col("_top.w")).alias("weight"))


def attribute(df: DataFrame, mapping: DataFrame, on: str, pick: str) -> DataFrame:
    """Attach the mapped key; rows whose key is not mapped drop out.

    No broadcast hint: the map has one row per key and AQE broadcasts it when
    its measured size is under the session's threshold, else it sort-merges
    with skew splitting.
    """
    return df.join(mapping.select(on, pick), on, "inner")


def modes_per_group(df: DataFrame, key: str, attributes: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Most frequent value of several attributes per group, in one scan.

    Every row is unrolled into one (attribute, value) pair per attribute plus
    one whole-group pair, and counted with map-side combine: what is shuffled
    is one row per distinct pair, not per fact.  NULL values stay out of the
    mode but inside the group total.  Yields ``key``, the summed ``measures``,
    and per attribute a struct column (``value``, ``n``).
    """
    whole = F.struct(F.lit(None).cast("string").alias("attr"), F.lit(None).cast("string").alias("value"))
    pairs = [F.struct(F.lit(name).alias("attr"), F.col(name).alias("value")) for name in attributes]
    unrolled = df.select(
        key, *[expr.alias(name) for name, expr in measures.items()], F.explode(F.array(whole, *pairs)).alias("_p")
    ).filter(F.col("_p.attr").isNull() | F.col("_p.value").isNotNull())
    counted = unrolled.groupBy(key, "_p.attr", "_p.value").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(name).alias(name) for name in measures]
    )
    is_total = F.col("attr").isNull()
    ranked = F.struct((-F.col("_n")).alias("w"), F.col("value").alias("value"))
    out = counted.groupBy(key).agg(
        *[F.sum(F.when(is_total, F.col(name))).alias(name) for name in measures],
        *[F.min(F.when(F.col("attr") == name, ranked)).alias(name) for name in attributes],
    )
    return out.select(
        key,
        *measures,
        *[
            F.when(F.col(name).isNotNull(), F.struct(F.col(f"{name}.value").alias("value"), (-F.col(f"{name}.w")).alias("n"))).alias(name)
            for name in attributes
        ],
    )
