"""Declarative data checks and their runner."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occrisk.functions import labels as L
from occrisk.plans.layers import Layer

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class Check:
    """One declared check of one column; ``args`` depends on the kind."""

    model: str
    column: str
    kind: str
    severity: str = ERROR
    args: tuple = ()


def _declare(model: str, columns: dict[str, list[str]]) -> list[Check]:
    return [Check(model, column, kind) for column, kinds in columns.items() for kind in kinds]


# FIXED VALUES: the checks that every build must run.
CHECKS: list[Check] = [
    *_declare("stg_dim_cnae", {"cnae_subclasse": ["unique", "not_null"], "cnae_classe": ["not_null"], "cnae_secao": ["not_null"]}),
    *_declare("stg_dim_cbo", {"cbo_codigo": ["unique", "not_null"]}),
    *_declare("stg_dim_municipio", {"municipio_id": ["unique", "not_null"], "municipio_id_6": ["not_null"], "sigla_uf": ["not_null"]}),
    *_declare("stg_dim_grau_risco", {"cnae_classe": ["unique", "not_null"], "grau_risco": ["not_null"], "grau_risco_descricao": ["not_null"]}),
    Check("stg_dim_grau_risco", "grau_risco", "accepted_values", ERROR, tuple(L.RISK_GRADE_LABEL)),
    *_declare("stg_dim_cid", {"cid_codigo": ["unique", "not_null"]}),
    *_declare("stg_fact_rais", {c: ["not_null"] for c in ("cnae_subclasse", "cnae_classe", "cbo_codigo", "quantidade_vinculos")}),
    Check("stg_fact_rais", "cnae_subclasse", "relationships", WARN, ("stg_dim_cnae", "cnae_subclasse")),
    *_declare("stg_fact_cat", {"cnae_cod_4": ["not_null"]}),
    *_declare("stg_fact_sim", {"cbo_codigo": ["not_null"], "total_obitos": ["not_null"]}),
    *_declare("stg_sim_linhas", {"fonte_linha": ["not_null"]}),
    Check("stg_sim_linhas", "fonte_linha", "accepted_values", ERROR, L.CERTIFICATE_LINES),
    *_declare("mart_top_cbo_por_cnae", {"rank_cbo": ["not_null"], "cbo_codigo": ["not_null"]}),
    *_declare("mart_perfil_risco_cnae", {c: ["not_null"] for c in ("rank_cbo", "cbo_codigo", "rank_cid", "cid_10")}),
]

Tables = Callable[[str], DataFrame]


def _rows(failures: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check out of a one-row relation with columns f0, f1, ..."""
    rows = [
        F.struct(
            F.lit(c.model).alias("modelo"),
            F.lit(c.column).alias("coluna"),
            F.lit(c.kind).alias("teste"),
            F.lit(c.severity).alias("severidade"),
            F.col(f"f{i}").cast("bigint").alias("falhas"),
        )
        for i, c in enumerate(checks)
    ]
    status = (
        F.when(F.col("falhas") == 0, "PASS").when(F.col("severidade") == WARN, "WARN").otherwise("ERROR")
    )
    return failures.select(F.inline(F.array(*rows))).withColumn("status", status)


def one_pass(tables: Tables, model: str, checks: list[Check]) -> DataFrame:
    """All checks of a table from one scan of it.

    Rows are counted by value of the columns whose checks look at values; with
    them, NULLs of every column that has a not-null check.  A second aggregate over
    that reduced relation gives one failure count per check:

    * not_null: rows without a value;
    * unique: values that occur more than once, NULLs apart;
    * accepted_values: values outside the list, NULLs apart;
    * relationships: rows whose value no parent has, NULLs apart.
    """
    df = tables(model)
    looked_at = list(dict.fromkeys(c.column for c in checks if c.kind != "not_null"))
    required = list(dict.fromkeys(c.column for c in checks if c.kind == "not_null"))
    slots = [F.struct(F.lit(i).alias("slot"), F.col(c).cast("string").alias("value")) for i, c in enumerate(looked_at)]
    if len(slots) > 1:
        df = df.select(F.explode(F.array(*slots)).alias("_s"), *required).select("_s.*", *[F.col(c).alias(f"r{j}") for j, c in enumerate(required)])
    else:
        seen = slots[0] if slots else F.struct(F.lit(0).alias("slot"), F.lit(None).cast("string").alias("value"))
        df = df.select(seen.alias("_s"), *required).select("_s.*", *[F.col(c).alias(f"r{j}") for j, c in enumerate(required)])
    missing = [F.count_if((F.col("slot") == 0) & F.col(f"r{j}").isNull()).alias(f"z{j}") for j in range(len(required))]
    counted = df.groupBy("slot", "value").agg(F.count(F.lit(1)).alias("n"), *missing)
    parents = [c for c in checks if c.kind == "relationships"]
    for k, check in enumerate(parents):
        parent_model, parent_column = check.args
        known = tables(parent_model).select(F.lit(looked_at.index(check.column)).alias("slot"), F.col(parent_column).cast("string").alias("value")).distinct()
        counted = counted.join(known.withColumn(f"hit{k}", F.lit(True)), ["slot", "value"], "left")

    def failures(check: Check) -> Column:
        if check.kind == "not_null":
            return F.sum(f"z{required.index(check.column)}")
        here = (F.col("slot") == looked_at.index(check.column)) & F.col("value").isNotNull()
        if check.kind == "unique":
            return F.count_if(here & (F.col("n") > 1))
        if check.kind == "accepted_values":
            return F.count_if(here & ~F.col("value").isin(*map(str, check.args)))
        return F.sum(F.when(here & F.col(f"hit{parents.index(check)}").isNull(), F.col("n")))

    totals = [F.coalesce(failures(c), F.lit(0)).alias(f"f{i}") for i, c in enumerate(checks)]
    return _rows(counted.agg(*totals), checks)


def report(tables: Tables, checks: list[Check] = CHECKS, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """Result of every check: model, column, test, severity, failures, status."""
    chosen = [c for c in checks if kinds is None or c.kind in kinds]
    models = dict.fromkeys(c.model for c in chosen)
    return reduce(DataFrame.unionByName, [one_pass(tables, m, [c for c in chosen if c.model == m]) for m in models])


def summary(results: DataFrame) -> DataFrame:
    """PASS / WARN / ERROR counts."""
    return results.agg(
        *[F.count_if(F.col("status") == s).alias(s.lower()) for s in ("PASS", "WARN", "ERROR")]
    )


def tables_of(stg: Layer, marts: Layer) -> Tables:
    return lambda name: stg[name] if name.startswith("stg_") else marts[name]
