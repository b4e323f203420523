"""A training corpus from raw documents: five operators of `occrisk.llm`, one after the other.

Every stage takes the rows its predecessor kept, writes Parquet to the shared
folder and is read again, so an executor lost later never costs more than one
stage.  All stages but the last return the columns of `documents`.

ORACLE_SQL is None: the suffix and packing stages are not expressible in SQL;
`tests/llm/test_structure_operators.py` holds run() against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.llm import op3_quality, op5_suffix, op7_jaccard, op8_packing, op10_decontamination
from occrisk.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the threshold table."""
    return op3_quality.filter_quality(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies."""
    return op7_jaccard.deduplicated(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of prose that start elsewhere too; `n_chars` follows the text."""
    cut = op5_suffix.deduplicated(docs, op5_suffix.PASSAGE, op5_suffix.PASSAGE_GRAM)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return op10_decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the training sequences."""
    return op8_packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
