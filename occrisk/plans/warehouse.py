"""Materialisation of the warehouse: staged facts, shared reductions, then marts."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from contextvars import copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from occrisk.plans import loads, marts as plans
from occrisk.plans.layers import Layer
from occrisk.plans.marts import MARTS, cnae_sem_score
from occrisk.plans.staging import STAGING, staging_layer

# Read by several marts each: stored once, typed and column-pruned, instead of
# being parsed from raw again by every mart.
STORED_STAGING = (
    "stg_dim_cnae", "stg_dim_cbo", "stg_dim_grau_risco", "stg_dim_cid",
    "stg_fact_rais", "stg_fact_cat", "stg_fact_sim",
)
# Facts partitioned by year: the score's year window then prunes at run time.
STORED_BY_YEAR = ("stg_fact_rais", "stg_fact_cat", "stg_fact_sim")


# Reduced relations that several marts start from: each is computed once per build.
SHARED: dict[str, Callable[[Layer], DataFrame]] = {
    plans.SHARED_BONDS: plans.shared_bonds,
    f"{plans.SHARED_DOMINANT}max_row": lambda stg: plans.dominant_class(stg, "max_row"),
}
# A mart that reads another waits for it; all others run side by side.
READS = {"mart_cnae_sem_score": "mart_score_risco_cnae"}
THREADS = 2


def stored_layer(stored: Layer, raw: Layer) -> Layer:
    """Stored relations where there are any, views over raw for the rest."""
    return Layer(lambda name: stored[name] if name in STORED_STAGING else STAGING[name](raw))


def store_staging(spark: SparkSession, raw: Layer, root: str) -> Layer:
    """Write the shared staging relations; the layer returned reads them back."""
    views = staging_layer(raw)
    for name in STORED_STAGING:
        loads.replace_table(views[name], f"{root}/{name}", "ano" if name in STORED_BY_YEAR else None)
    return stored_layer(Layer.of_parquet(spark, root), raw)


def build_mart(name: str, stg: Layer, marts: Layer) -> DataFrame:
    """Plan of one mart; the complement reads the stored score."""
    if name == "mart_cnae_sem_score":
        return cnae_sem_score(stg, marts["mart_score_risco_cnae"])
    return MARTS[name](stg)


def store_shared(spark: SparkSession, stg: Layer, root: str) -> None:
    """Write the shared reductions and let the layer hand them out; later ones start from earlier ones."""
    for name, reduce_ in SHARED.items():
        reduce_(stg).write.mode("overwrite").parquet(f"{root}/{name}")
        stg.put(name, spark.read.parquet(f"{root}/{name}"))


def build(spark: SparkSession, raw: Layer, root: str, threads: int = THREADS) -> tuple[Layer, Layer]:
    """Write ``root/stg`` and ``root/mart``; returns both layers, read back.

    Marts are jobs of their own, submitted from some threads, each in a scheduler
    pool of its name: with ``spark.scheduler.mode=FAIR`` they share the executors,
    otherwise later ones fill what earlier ones leave idle.
    """
    stg = store_staging(spark, raw, f"{root}/stg")
    store_shared(spark, stg, f"{root}/stg")
    marts = Layer.of_parquet(spark, f"{root}/mart")
    running: dict[str, Future] = {}

    def write(name: str) -> None:
        if name in READS:
            running[READS[name]].result()
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        build_mart(name, stg, marts).write.mode("overwrite").parquet(f"{root}/mart/{name}")

    # a mart comes after what it reads, so whatever a thread waits for has begun
    order = sorted(MARTS, key=lambda name: name in READS)
    with ThreadPoolExecutor(threads) as pool:
        for name in order:
            running[name] = pool.submit(copy_context().run, inheritable_thread_target(spark)(write), name)
        for done in running.values():
            done.result()
    return stg, marts
