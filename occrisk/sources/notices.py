"""Accident-notice files: three layouts unified to one 24-column relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.sources import landing, records
from occrisk.sources.landing import cell, position_of, rename_repeats

# FIXED VALUES: column order of the unified relation.
NOTICE_COLUMNS = [
    "agente_causador", "data_competencia", "data_acidente", "cbo", "cid_10",
    "cnae_empregador_cod", "cnae_empregador_desc", "emitente", "especie_beneficio",
    "filiacao", "indica_obito", "munic_empregador", "natureza_lesao",
    "origem_cadastro", "parte_corpo", "sexo", "tipo_acidente", "uf_acidente",
    "uf_empregador", "data_despacho", "data_nascimento", "data_emissao",
    "cnpj_empregador", "_source_file",
]

# FIXED VALUES: unified column -> header name, where all layouts agree.
SAME_IN_ALL_LAYOUTS = {
    "agente_causador": "Agente  Causador  Acidente",
    "cnae_empregador_cod": "CNAE2.0 Empregador",
    "cnae_empregador_desc": "CNAE2.0 Empregador.1",
    "emitente": "Emitente CAT",
    "especie_beneficio": "Espécie do benefício",
    "filiacao": "Filiação Segurado",
    "munic_empregador": "Munic Empr",
    "natureza_lesao": "Natureza da Lesão",
    "origem_cadastro": "Origem de Cadastramento CAT",
    "parte_corpo": "Parte Corpo Atingida",
    "sexo": "Sexo",
    "tipo_acidente": "Tipo do Acidente",
    "uf_acidente": "UF  Munic.  Acidente",
    "uf_empregador": "UF Munic. Empregador",
    "data_despacho": "Data Despacho Benefício",
    "data_nascimento": "Data Nascimento",
    "data_emissao": "Data Emissão CAT",
    "cnpj_empregador": "CNPJ/CEI Empregador",
}
# FIXED VALUES: header names whose meaning depends on the layout.
OCCUPATION, DIAGNOSIS = "CBO", "CID-10"
SECOND_OCCUPATION = "CBO.1"
DATE, SECOND_DATE, THIRD_DATE = "Data Acidente", "Data Acidente.1", "Data Acidente.2"
DEATH_FLAG_OLD, DEATH_FLAG = "Indica acidente", "Indica Óbito Acidente"

# Where a plain file's header stands.
HEADER_PLACE = ("head_block", "head_at", "head_pos")

REQUIRED_HEADERS = (OCCUPATION, DIAGNOSIS)
REQUIRED_VALUES = ("cnae_empregador_cod", "data_acidente")


def detect_layout(header: Column) -> Column:
    """Layout A, B or C of a header with its repeats renamed."""

    def has(name: str) -> Column:
        return F.array_contains(header, name)

    return (
        F.when(has(THIRD_DATE), "B")
        .when(has(SECOND_OCCUPATION) & has(DEATH_FLAG_OLD), "A")
        .otherwise("C")
    )


def manifest(headers: DataFrame) -> DataFrame:
    """Per file: layout, error, and the position of every column it supplies.

    Positions are resolved once per file, so records only index into cells.
    """
    renamed = headers.withColumn("header", rename_repeats(F.col("header")))
    header, layout = F.col("header"), F.col("layout")
    missing = F.filter(
        F.array(*[F.lit(n) for n in REQUIRED_HEADERS]), lambda n: ~F.array_contains(header, n)
    )
    laid = renamed.withColumn("layout", detect_layout(header)).withColumn(
        "error",
        F.when(F.col("error").isNotNull(), F.col("error")).when(
            F.size(missing) > 0, F.concat(F.lit("missing column "), F.element_at(missing, F.lit(1)))
        ),
    )
    places = {name: position_of(header, source) for name, source in SAME_IN_ALL_LAYOUTS.items()}
    places["cbo"] = position_of(header, OCCUPATION)
    places["cid_10"] = position_of(header, DIAGNOSIS)
    places["indica_obito"] = F.when(layout == "A", position_of(header, DEATH_FLAG_OLD)).otherwise(
        position_of(header, DEATH_FLAG)
    )
    places["data_competencia"] = position_of(header, DATE)
    places["data_acidente"] = (
        F.when(layout == "A", position_of(header, SECOND_DATE))
        .when(layout == "B", position_of(header, THIRD_DATE))
        .otherwise(position_of(header, DATE))
    )
    return laid.select(
        "path",
        F.substring_index("path", "/", -1).alias("_source_file"),
        "layout",
        "error",
        F.size("header").alias("n_header"),
        *[c for c in HEADER_PLACE if c in headers.columns],
        F.struct(*[col.alias(name) for name, col in places.items()]).alias("places"),
    )


def unify(found: DataFrame, files: DataFrame) -> DataFrame:
    """Records of any layout as the 24 unified columns plus ``malformed``.

    ``files`` holds one short row per file; Spark knows its size and picks the join.
    """
    rows = found.join(files.filter(F.col("error").isNull()), "path", "inner")
    if set(HEADER_PLACE) <= set(files.columns) and "at" in found.columns:  # the header is a record too
        rows = rows.filter(~(F.struct("block", "at", "pos") == F.struct(*HEADER_PLACE)))
    layout = F.col("layout")

    def value(name: str) -> Column:
        return cell(F.col("cells"), F.col(f"places.{name}"))

    occupation, diagnosis, period = value("cbo"), value("cid_10"), value("data_competencia")
    parts = F.split(period, "/")
    special = {
        "cbo": F.when(layout == "B", F.trim(F.substring_index(occupation, "-", 1))).otherwise(occupation),
        "cid_10": F.when(layout == "B", F.substring_index(diagnosis, " ", 1)).otherwise(diagnosis),
        "data_competencia": F.when(layout != "C", period).when(
            F.size(parts) == 3, F.concat(F.get(parts, F.lit(2)), F.lit("/"), F.get(parts, F.lit(1)))
        ),
    }
    extra = F.get("cells", F.col("n_header")).isNotNull()
    return rows.select(
        *[
            (F.col(name) if name == "_source_file" else special.get(name, value(name))).alias(name)
            for name in NOTICE_COLUMNS
        ],
        extra.alias("malformed"),
    )


def flag_quarantine(unified: DataFrame) -> DataFrame:
    """Add ``em_quarentena``: no activity, no date, or more cells than the header."""
    bad = F.col("malformed")
    for name in REQUIRED_VALUES:
        bad = bad | (F.coalesce(name, F.lit("")) == "")
    return unified.withColumn("em_quarentena", bad).drop("malformed")


def split_quarantine(flagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined) rows; the flag may be a partition column read back as text."""
    bad = F.col("em_quarentena").cast("boolean")
    return flagged.filter(~bad).drop("em_quarentena"), flagged.filter(bad).drop("em_quarentena")


def plain_headers(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Header of every plain file, if its first record holds one, and its place."""
    place = [F.col(c).alias(f"head_{c}") for c in ("block", "at", "pos")]
    known = F.array_contains("cells", OCCUPATION)
    return records.first_records(lines, states).select(
        "path", F.when(known, F.col("cells")).alias("header"), F.when(~known, "no header found").alias("error"), *place
    )


def read_notices(
    spark: SparkSession, directory: str, first_year: int, last_year: int, work: str, names: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(flagged rows, file status) of a landing directory.

    Only files whose name tells a year in the range (and is one of ``names``, if
    given) are opened.  Lines of plain files, cells of archives and one row per
    file are written below ``work`` and read back: files are read once, and Spark
    knows the sizes.  Unreadable files only show in the status; the job fails when
    none loads.  Paths and widths stay in relations; two counts reach the driver.
    """

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(df.schema).parquet(f"{work}/{name}")

    inside = landing.chosen(first_year, last_year, names)
    chosen = landing.listing(spark, directory, inside).select("path")
    archives = kept(landing.parsed(landing.binary_files(spark, directory, "*.[zZ][iI][pP]").filter(inside)), "archives")
    lines = kept(records.text_lines(spark, directory, inside, landing.NOTICE_ENCODING), "lines")
    states = kept(records.block_states(lines), "states")
    heads = plain_headers(lines, states).unionByName(landing.headers_of(archives), allowMissingColumns=True)
    found = chosen.join(heads, "path", "left")
    unknown = F.when(F.col("header").isNull(), F.coalesce("error", F.lit("empty file")))
    files = kept(manifest(found.withColumn("error", F.coalesce(unknown, "error"))), "manifest")
    status = files.select(
        "path", "_source_file", "layout", F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"), "error"
    )
    known = files.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.col("error").isNull()).alias("good")).first()
    if not known["files"]:
        raise ValueError(f"no notice files for {first_year}-{last_year} in {directory}")
    if not known["good"]:
        raise RuntimeError("no notice file could be read")
    plain = unify(records.records(lines, states), files)
    return flag_quarantine(plain.unionByName(unify(landing.records_of(archives), files))), status


def land_notices(
    spark: SparkSession, directory: str, target: str, first_year: int, last_year: int, run_date: str, names: Sequence[str] | None = None
) -> DataFrame:
    """Replace ``target/rows`` with the landing's rows and store its bad rows.

    Good and bad rows are written by one job into two partitions, and the
    quarantine copy is made from the stored one.  Returns the good rows.
    """
    flagged, _ = read_notices(spark, directory, first_year, last_year, f"{target}/work", names)
    flagged.write.mode("overwrite").partitionBy("em_quarentena").parquet(f"{target}/rows")
    good, bad = split_quarantine(spark.read.parquet(f"{target}/rows"))
    write_quarantine(bad, f"{target}/quarantine", run_date)
    return good


def write_quarantine(bad: DataFrame, directory: str, run_date: str) -> None:
    """Store the bad rows under one folder per run date and source file.

    A run replaces its date as a whole, so a repeated run leaves neither copies
    nor rows of a file that has been repaired since.
    """
    bad.write.mode("overwrite").partitionBy("_source_file").parquet(f"{directory}/run_date={run_date}")
