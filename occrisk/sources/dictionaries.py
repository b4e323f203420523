"""Dictionary tables built from landed files: risk grades and diagnoses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occrisk.functions import codes
from occrisk.functions.text import strip_all
from occrisk.operators.keyed import first_per_key


def risk_grades(sheet: DataFrame, order: Column) -> DataFrame:
    """One grade per class from the statutory sheet (``nivel``, ``codigo``, ``gr``).

    Subclass rows with a grade; punctuation is removed from the code and its
    first five digits are the class.  ``order`` says which row came first.
    """
    rows = sheet.filter((F.col("nivel") == "Subclasse") & F.col("gr").isNotNull()).select(
        F.left(F.regexp_replace("codigo", r"[^0-9]", ""), F.lit(5)).alias("cnae_classe"),
        strip_all(F.col("gr")).cast("int").alias("grau_risco"),
        order.alias("_order"),
    )
    return first_per_key(rows, ["cnae_classe"], [F.col("_order")], ["grau_risco"])


def _entries(df: DataFrame, code: str, text: str, priority: int, normalise) -> DataFrame:
    filled = (F.col(code) != "") & (F.col(text) != "")
    return df.filter(filled).select(
        normalise(strip_all(F.col(code))).alias("cid_codigo"),
        strip_all(F.col(text)).alias("cid_descricao"),
        F.lit(priority).alias("_priority"),
    )


def diagnosis_dictionary(subcategories: DataFrame, categories: DataFrame) -> DataFrame:
    """Dotted sub-categories plus categories; a sub-category wins over a category."""
    entries = _entries(subcategories, "SUBCAT", "DESCRICAO", 0, codes.dictionary_code).unionByName(
        _entries(categories, "CAT", "DESCRICAO", 1, lambda code: code)
    )
    return first_per_key(entries, ["cid_codigo"], [F.col("_priority")], ["cid_descricao"])
