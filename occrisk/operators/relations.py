"""Set-like operators: null-aware anti join, prefix matching, match rates, windows of years."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occrisk.functions.rates import share_pct


def null_aware_anti(left: DataFrame, key: Column, right: DataFrame, right_key: str) -> DataFrame:
    """``key NOT IN (select right_key from right)`` with SQL's NULL rules.

    An empty right side keeps everything; otherwise a NULL on the left drops
    that row and a NULL on the right drops all.  Written as an ordinary
    ``left_anti`` equi-join plus one scalar about the right side, so it does not
    force the broadcast that a literal NOT IN does.  Join and scalar start from
    the same distinct keys, which a NULL-safe join leaves as they are: their
    exchange is made once and read twice.
    """
    keys = right.select(F.col(right_key).alias("_r")).distinct()
    # NULL for no keys, else whether one of them is NULL
    holds_null = keys.agg(F.max(F.col("_r").isNull()).alias("nulls")).scalar()
    probe = left.withColumn("_k", key)
    rest = probe.join(keys, F.col("_k").eqNullSafe(F.col("_r")), "left_anti")
    return rest.filter(holds_null.isNull() | (~holds_null & F.col("_k").isNotNull())).drop("_k")


def year_intersection(a: DataFrame, b: DataFrame, year: str = "ano") -> tuple[Column, Column]:
    """First and last year covered by both relations, as scalar subqueries.

    Disjoint relations give first > last, an interval that matches no row.
    """

    def bound(df: DataFrame, agg) -> Column:
        return df.agg(agg(year).alias(year)).scalar()

    return (
        F.greatest(bound(a, F.min), bound(b, F.min)),
        F.least(bound(a, F.max), bound(b, F.max)),
    )


def prefix_fan_out(df: DataFrame, code: str, length: int, prefix: str = "prefixo") -> DataFrame:
    """Prefixes shared by more than one code; must be empty for safe prefix joins."""
    return (
        df.select(F.left(code, F.lit(length)).alias(prefix), code)
        .distinct()
        .groupBy(prefix)
        .agg(F.count(code).alias("codigos"))
        .filter(F.col("codigos") > 1)
    )


def match_rate(counted: DataFrame, code: str, weight: str, parent: DataFrame, parent_code: str) -> DataFrame:
    """Total, filled and matched rows of a code column against its dictionary.

    ``counted`` holds one row per distinct code with its row count, so the join
    is between two dictionaries whatever the size of the fact.
    """
    known = parent.select(F.col(parent_code).alias(code)).distinct().withColumn("_hit", F.lit(True))
    w = F.col(weight)
    return (
        counted.join(known, code, "left")
        .agg(
            F.sum(w).alias("total"),
            F.coalesce(F.sum(F.when(F.col(code).isNotNull(), w)), F.lit(0)).alias("preenchidos"),
            F.coalesce(F.sum(F.when(F.col("_hit"), w)), F.lit(0)).alias("casados"),
        )
        .withColumn("pct_casados", share_pct(F.col("casados"), F.col("preenchidos"), 2))
    )


def match_rates(df: DataFrame, parents: dict[str, DataFrame], name: str) -> DataFrame:
    """``match_rate`` of several code columns of one relation, from a single scan.

    ``parents`` maps each column to its dictionary of one column; ``name`` is
    the output column that tells them apart.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("code")) for c in parents]))
    counted = df.select(cells.alias("_c")).groupBy("_c.column", "_c.code").agg(F.count(F.lit(1)).alias("_w"))
    known = reduce(
        DataFrame.unionByName,
        [p.select(F.lit(c).alias("column"), F.col(p.columns[0]).alias("code")) for c, p in parents.items()],
    ).distinct()
    w = F.col("_w")
    return (
        counted.join(known.withColumn("_hit", F.lit(True)), ["column", "code"], "left")
        .groupBy(F.col("column").alias(name))
        .agg(
            F.sum(w).alias("total"),
            F.coalesce(F.sum(F.when(F.col("code").isNotNull(), w)), F.lit(0)).alias("preenchidos"),
            F.coalesce(F.sum(F.when(F.col("_hit"), w)), F.lit(0)).alias("casados"),
        )
        .withColumn("pct_casados", share_pct(F.col("casados"), F.col("preenchidos"), 2))
    )


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count and share per column, one row each, from a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("linhas"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    pairs = [F.struct(F.lit(c).alias("coluna"), F.col(c).alias("nulos")) for c in columns]
    return counts.select("linhas", F.inline(F.array(*pairs))).withColumn(
        "pct_nulos", share_pct(F.col("nulos"), F.col("linhas"), 1)
    )
