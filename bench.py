"""Benchmark: wall seconds of the headline queries, one JSON line on stdout.

BENCH_SF_DIR picks the data, BENCH_CPUS the cores, BENCH_RUNS the repetitions;
a query's figure is the median of its runs, results go to the no-op sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from occrisk.queries import all_queries
from occrisk.session import local_session

HEADLINE = [
    "rais_aggregate",
    "sim_aggregate",
    "stg_fact_cat",
    "stg_sim_linhas",
    "layout_unify",
    "quarantine_split",
    "match_rate",
    "dq_summary",
    "dominant_max_row",
    "mart_cat_cnae_cbo_mes",
    "mart_risco_teorico_vs_observado",
    "mart_top_cbo_por_cnae",
    "mart_perfil_risco_cnae",
    "mart_severidade_cat_cnae",
    "mart_mortalidade_por_cnae",
    "mart_comorbidades_por_cnae",
    "mart_causas_externas_por_cnae",
    "mart_risco_morte",
    "mart_risco_acidente",
    "mart_risco_doenca",
    "mart_score_risco_cnae",
    "mart_cnae_sem_score",
]


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "8g"), cpus)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    took = {}
    for name in HEADLINE:
        took[name] = round(statistics.median(seconds(queries[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {took[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total median wall time of the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": float(scale.group(1)) if scale else None,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
