"""CSV export of the marts: a header, a byte order mark, and the rows in presentation order.

Tasks render their part of the sorted rows.  On a mounted folder they then write one
file together: sizes of the rendered pieces tell where each belongs.  In a
store that only Spark reaches, the same pieces become parts of a folder, which
joined in order are that file.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from occrisk.operators.stored import stored
from occrisk.session import shipped
from occrisk.sources.one_file import mounted_path, write_one_file

BYTE_ORDER_MARK = "\ufeff"


def _order(*keys: str) -> list[Column]:
    """Sort keys; a leading minus means descending with NULLs last."""
    return [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in keys]


# Presentation order of each mart.
PRESENTATION_ORDER = {
    "mart_risco_teorico_vs_observado": ("-grau_risco", "-total_acidentes"),
    "mart_top_cbo_por_cnae": ("-grau_risco", "cnae_classe", "rank_cbo"),
    "mart_perfil_risco_cnae": ("-grau_risco", "cnae_classe", "rank_cbo", "rank_cid"),
    "mart_severidade_cat_cnae": ("-grau_risco", "cnae_classe"),
    "mart_mortalidade_por_cnae": ("-grau_risco", "cnae_classe", "sexo", "faixa_etaria"),
    "mart_comorbidades_por_cnae": ("-grau_risco", "cnae_classe", "-total_obitos_com_comorbidade"),
    "mart_causas_externas_por_cnae": ("-grau_risco", "cnae_classe", "-total_obitos"),
    "mart_risco_morte": ("-grau_risco", "cnae_classe", "-total_obitos"),
    "mart_risco_acidente": ("-grau_risco", "cnae_classe", "-total_acidentes"),
    "mart_risco_doenca": ("-grau_risco", "cnae_classe", "cbo_codigo", "fonte_linha", "-total_obitos_com_condicao"),
    "mart_score_risco_cnae": ("-score_risco", "-acidentes_trabalho"),
    "mart_cnae_sem_score": ("cnae_classe",),
}

# FIXED VALUES: marts that the export writes by default.
EXPORTED_MARTS = [
    "mart_risco_morte",
    "mart_risco_acidente",
    "mart_risco_doenca",
    "mart_risco_teorico_vs_observado",
    "mart_cat_cnae_cbo_mes",
    "mart_top_cbo_por_cnae",
    "mart_perfil_risco_cnae",
    "mart_severidade_cat_cnae",
    "mart_mortalidade_por_cnae",
    "mart_comorbidades_por_cnae",
    "mart_causas_externas_por_cnae",
]


def presented(name: str, df: DataFrame) -> DataFrame:
    """The mart in presentation order (a distributed range sort)."""
    keys = PRESENTATION_ORDER.get(name)
    return df.orderBy(*_order(*keys)) if keys else df


def header_line(df: DataFrame) -> str:
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerow(df.columns)
    return BYTE_ORDER_MARK + out.getvalue()


# Whole numbers stay whole beside NULLs.
_NULLABLE = {pa.int8(): pd.Int8Dtype(), pa.int16(): pd.Int16Dtype(), pa.int32(): pd.Int32Dtype(), pa.int64(): pd.Int64Dtype(), pa.bool_(): pd.BooleanDtype()}


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for n, batch in enumerate(batches):
        text = batch.to_pandas(types_mapper=_NULLABLE.get).to_csv(header=False, index=False, lineterminator="\n")
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "piece": pa.array([n], pa.int32()), "text": [text]})


def rendered(df: DataFrame) -> DataFrame:
    """Pieces of CSV text (part, piece, text) in the order of the rows."""
    shipped(df.sparkSession)
    return df.mapInArrow(_render, "part int, piece int, text string")


def placed(pieces: DataFrame, first: int) -> DataFrame:
    """The byte at which every piece begins, if the first one begins at ``first``."""
    size = F.octet_length("text").cast("bigint")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per part
    inside = Window.partitionBy("part").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    parts = pieces.groupBy("part").agg(F.sum(size).alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = pieces.select("part", "text", F.coalesce(F.sum(size).over(inside), F.lit(0)).alias("inside"))
    return within.join(parts, "part").select((F.lit(first) + F.col("ahead") + F.col("inside")).alias("offset"), F.col("text").cast("binary").alias("data"))


def export_file(name: str, df: DataFrame, target: str) -> None:
    """Write one CSV file on a mounted folder."""
    head = header_line(df).encode()
    pieces = stored(rendered(presented(name, df)), "pieces")
    size = pieces.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    write_one_file(placed(pieces, len(head)), head, len(head) + size, target)


def export_parts(name: str, df: DataFrame, directory: str) -> None:
    """Write the same file as parts of a folder; only the first part has the header."""
    head = df.sparkSession.createDataFrame([(-1, 0, header_line(df))], "part int, piece int, text string")
    pieces = stored(rendered(presented(name, df)), "pieces").unionByName(head)
    ordered = pieces.repartitionByRange("part", "piece").sortWithinPartitions("part", "piece")
    # the text source ends every value with a line end of its own
    ordered.select(F.left("text", F.length("text") - 1)).write.mode("overwrite").text(directory)


def export_csv(name: str, df: DataFrame, directory: str) -> None:
    """Write ``directory/name.csv``: one file on a mounted folder, else a folder of parts."""
    folder = mounted_path(directory)
    if folder is not None:
        export_file(name, df, f"{folder}/{name}.csv")
    else:
        export_parts(name, df, f"{directory}/{name}.csv")
