"""Registered queries: name -> plan over the raw and staging layers.

Staging views and marts are registered under their own names; the rest shows
each reusable operator at work on the full tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occrisk.functions import ages, codes, rates, text
from occrisk.operators import keyed, ranking, relations
from occrisk.operators.expand import explode_codes
from occrisk.operators.stored import shared_folder
from occrisk.plans import export, loads, marts, quality, versions
from occrisk.plans.layers import Layer
from occrisk.plans.marts import MARTS
from occrisk.plans.staging import STAGING, age_dates, staging_layer, with_age
from occrisk.sources import catalogue, dictionaries, landing, notices, profile, records
from occrisk.sources.adapter import raw_layer
from occrisk.streaming.ledger import known_outcomes, watch_ledger

Query = Callable[[SparkSession, str], DataFrame]
Plan = Callable[[Layer, Layer], DataFrame]

OPERATORS: dict[str, Plan] = {}


def _register(plan: Plan) -> Plan:
    OPERATORS[plan.__name__] = plan
    return plan


# --- sources ---------------------------------------------------------------------

@_register
def rais_aggregate(raw: Layer, stg: Layer) -> DataFrame:
    return raw["rais_vinculos"]


@_register
def sim_aggregate(raw: Layer, stg: Layer) -> DataFrame:
    return raw["fact_sim"]


@_register
def cid_dictionary(raw: Layer, stg: Layer) -> DataFrame:
    return raw["dim_cid"]


@_register
def grau_risco_build(raw: Layer, stg: Layer) -> DataFrame:
    return dictionaries.risk_grades(raw["grau_risco_sheet"], F.col("linha"))


@_register
def manifest_dedup(raw: Layer, stg: Layer) -> DataFrame:
    """Catalogue entry kept per URL."""
    return landing.first_per_url(raw["catalogue"].drop("formato"), [F.col("catalogo"), F.col("posicao")])


@_register
def file_year_pruning(raw: Layer, stg: Layer) -> DataFrame:
    """Year and format told by every file name, and whether the file is read."""
    names = raw["catalogue"].select("url").distinct()
    files = names.select("url", text.file_format(F.col("url")).alias("formato"), text.year_of_file(F.col("url")).alias("ano"))
    kept = landing.prune_files(files, 1993, 1997).select("url", F.lit(True).alias("lido"))
    return files.join(kept, "url", "left").withColumn("lido", F.coalesce("lido", F.lit(False)))


@_register
def catalogue_selection(raw: Layer, stg: Layer) -> DataFrame:
    """Files that the catalogues offer in a wanted format and year."""
    return catalogue.wanted(raw["catalogue"], 1993, 1997)


@_register
def quoted_records(raw: Layer, stg: Layer) -> DataFrame:
    """Cells of records with quoted separators, quotes and line breaks, whose files were read in pieces."""
    lines = raw["typed_lines"]
    found = records.records(lines, records.block_states(lines))
    cells = [F.get("cells", F.lit(i)) for i in range(3)]
    return found.select("path", cells[0].cast("bigint").alias("chave"), cells[1].alias("nota"), cells[2].alias("tipo"), F.size("cells").alias("celulas"))


@_register
def windows_dictionary(raw: Layer, stg: Layer) -> DataFrame:
    """Entries of dictionary files in the Windows encoding."""
    return landing.named_records_of(raw["windows_files"], ["SUBCAT", "DESCRICAO"]).drop("record")


def _unified(raw: Layer) -> DataFrame:
    return notices.unify(raw["landed_records"], notices.manifest(raw["landed_headers"]))


@_register
def layout_detection(raw: Layer, stg: Layer) -> DataFrame:
    files = notices.manifest(raw["landed_headers"])
    return files.select("_source_file", "layout", "n_header")


@_register
def layout_unify(raw: Layer, stg: Layer) -> DataFrame:
    """All landed records as the 24 unified columns."""
    return _unified(raw)


@_register
def quarantine_split(raw: Layer, stg: Layer) -> DataFrame:
    """Accepted and quarantined records per landed file."""
    target = F.when(F.col("em_quarentena"), "quarentena").otherwise("aceito").alias("destino")
    return notices.flag_quarantine(_unified(raw)).groupBy("_source_file", target).agg(F.count(F.lit(1)).alias("linhas"))


@_register
def source_profile(raw: Layer, stg: Layer) -> DataFrame:
    """Columns, types, row counts, filled cells and first cells of the raw tables."""
    names = ["dim_cnae", "dim_cbo", "dim_municipio", "tabela_quebrada", "rais_microdados", "sim_microdados"]
    broken = Layer(lambda name: raw["dim_cbo"].select("coluna_ausente") if name == "tabela_quebrada" else raw[name])
    return profile.profile(broken, names)


# --- loads -----------------------------------------------------------------------

@_register
def ledger_skip(raw: Layer, stg: Layer) -> DataFrame:
    """Notice files without a successful load."""
    events = raw["load_events"].withColumn("checksum", loads.checksum(F.col("file_name")))
    files = stg["stg_fact_cat"].select(F.lit("cat_microdados").alias("table_name"), "source_file").distinct()
    return loads.pending(files, events, "source_file")


@_register
def ledger_states(raw: Layer, stg: Layer) -> DataFrame:
    """Current status of every load attempt."""
    events = raw["load_events"].withColumn("checksum", loads.checksum(F.col("file_name")))
    return loads.ledger_state(events).select("id", "file_name", "checksum", "status")


@_register
def ledger_outcomes(raw: Layer, stg: Layer) -> DataFrame:
    """Outcome of every load attempt as the stream over the ledger tells it; what ran on for half an hour is stuck."""
    spark = raw["load_events"].sparkSession
    folder = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    events = raw["load_events"].withColumn("checksum", loads.checksum(F.col("file_name")))
    events.select([f.split()[0] for f in loads.LEDGER_SCHEMA.split(", ")]).write.parquet(f"{folder}/events")
    watch_ledger(spark, f"{folder}/events", f"{folder}/outcomes", f"{folder}/checkpoint", 1800)
    return known_outcomes(spark, f"{folder}/outcomes").select("id", "file_name", "status")


def _evolved(raw: Layer) -> DataFrame:
    """Deaths stored before 1998 lack the certificate lines of Part I."""
    deaths = raw["fact_sim"]
    old = deaths.filter(F.col("ano") < 1998).drop(*loads.LATER_COLUMNS)
    return old.unionByName(deaths.filter(F.col("ano") >= 1998), allowMissingColumns=True)


@_register
def schema_evolution(raw: Layer, stg: Layer) -> DataFrame:
    """Rows and filled lines per year of a table whose older part lacks columns."""
    filled = [F.count(c).alias(c) for c in (*loads.LATER_COLUMNS, "linha_ii")]
    return _evolved(raw).groupBy("ano").agg(F.count(F.lit(1)).alias("linhas"), *filled)


@_register
def year_replacement(raw: Layer, stg: Layer) -> DataFrame:
    """Rows, deaths and filled lines per year after the pending years are loaded anew.

    The fresh deaths count double, and lack one pending year, to tell them apart.
    """
    old, fresh = _evolved(raw), raw["fact_sim"].filter("ano <> 1996").withColumn("total_obitos", F.col("total_obitos") * 2)
    after = loads.replaced(old, fresh, loads.pending_years(old, 1994, 2003))
    filled = [F.count(c).alias(c) for c in (*loads.LATER_COLUMNS, "linha_ii")]
    return after.groupBy("ano").agg(F.count(F.lit(1)).alias("linhas"), F.sum("total_obitos").alias("obitos"), *filled)


@_register
def pending_years(raw: Layer, stg: Layer) -> DataFrame:
    return loads.pending_years(_evolved(raw), 1994, 2003)


@_register
def load_summary(raw: Layer, stg: Layer) -> DataFrame:
    return loads.load_summary(_evolved(raw))


# --- keyed operators -------------------------------------------------------------

@_register
def dominant_max_row(raw: Layer, stg: Layer) -> DataFrame:
    return marts.dominant_class(stg, "max_row")


@_register
def dominant_sum(raw: Layer, stg: Layer) -> DataFrame:
    return marts.dominant_class(stg, "sum")


@_register
def attribution_join(raw: Layer, stg: Layer) -> DataFrame:
    """Deaths per attributed class and year."""
    deaths = stg["stg_fact_sim"].groupBy("cbo_codigo", "ano").agg(F.sum("total_obitos").alias("n"))
    attributed = keyed.attribute(deaths, marts.dominant_class(stg), "cbo_codigo", "cnae_classe")
    return attributed.groupBy("cnae_classe", "ano").agg(F.sum("n").alias("total_obitos"))


@_register
def mode_per_group(raw: Layer, stg: Layer) -> DataFrame:
    """Most frequent value of four attributes per activity prefix."""
    traits = ["tipo_acidente", "natureza_lesao", "cid_10", "sexo"]
    modes = keyed.modes_per_group(
        stg["stg_fact_cat"], "cnae_cod_4", traits, {"total": F.lit(1).cast("bigint")}
    )
    columns = []
    for trait in traits:
        columns += [F.col(f"{trait}.value").alias(f"{trait}_moda"), F.col(f"{trait}.n").alias(f"{trait}_n")]
    return modes.select("cnae_cod_4", "total", *columns)


@_register
def distinct_on_first(raw: Layer, stg: Layer) -> DataFrame:
    """First notice month of every occupation, with the activity it came from."""
    seen = stg["stg_fact_cat"].filter(F.col("cbo_codigo").isNotNull() & F.col("ano").isNotNull())
    columns = ["ano", "mes", "cnae_cod_4"]
    return keyed.first_per_key(
        seen, ["cbo_codigo"], [F.col("ano"), F.col("mes")], columns
    )


@_register
def distinct_years(raw: Layer, stg: Layer) -> DataFrame:
    """Years covered by each class."""
    return stg["stg_fact_rais"].groupBy("cnae_classe").agg(
        F.count_distinct("ano").alias("anos_cobertos"), F.min("ano").alias("ano_inicio"), F.max("ano").alias("ano_fim")
    )


@_register
def filtered_aggregates(raw: Layer, stg: Layer) -> DataFrame:
    """Conditional sums (0 when none) beside filtered sums (NULL when none)."""
    bonds, state = F.col("quantidade_vinculos"), F.col("sigla_uf")
    return stg["stg_fact_rais"].groupBy("cnae_classe", "ano").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(state == "SP").alias("linhas_sp"),
        F.sum(F.when(state == "SP", bonds).otherwise(0)).alias("vinculos_sp"),
        F.sum(F.when(state == "AC", bonds)).alias("vinculos_ac"),
        F.max(F.when(state == "RJ", bonds)).alias("maior_rj"),
    )


# --- ranks, shares, rates --------------------------------------------------------

@_register
def nested_top_n(raw: Layer, stg: Layer) -> DataFrame:
    """Five occupations per state, three diagnoses in each."""
    cells = (
        stg["stg_fact_cat"]
        .filter(F.col("cbo_codigo").isNotNull() & F.col("cid_10").isNotNull())
        .groupBy("uf_empregador", "cbo_codigo", "cid_10")
        .agg(F.count(F.lit(1)).alias("acidentes"))
    )
    return ranking.nested_top_n(cells, "uf_empregador", "cbo_codigo", "cid_10", "acidentes", 5, 3, "rank_cbo", "rank_cid")


@_register
def global_rank(raw: Layer, stg: Layer) -> DataFrame:
    """Rank of every occupation by number of notices; ties share a rank."""
    counted = stg["stg_fact_cat"].groupBy("cbo_codigo").agg(F.count(F.lit(1)).alias("acidentes"))
    return ranking.global_rank(counted, "acidentes", "posicao")


@_register
def rate_per_mil(raw: Layer, stg: Layer) -> DataFrame:
    """Notices per 1000 bonds of each activity prefix, at two precisions."""
    notices_ = stg["stg_fact_cat"].groupBy("cnae_cod_4").agg(F.count(F.lit(1)).alias("acidentes"))
    bonds = marts.bonds_by_class(stg).groupBy(F.left("cnae_classe", F.lit(4)).alias("cnae_cod_4")).agg(
        F.sum("total_vinculos").alias("vinculos")
    )
    return notices_.join(bonds, "cnae_cod_4", "left").withColumns({
        "taxa_2": rates.rate_per_mille(F.col("acidentes"), F.col("vinculos"), 2),
        "taxa_3": rates.rate_per_mille(F.col("acidentes"), F.col("vinculos"), 3),
    })


@_register
def share_of_total(raw: Layer, stg: Layer) -> DataFrame:
    """Share of each state in the bonds of a class."""
    parts = stg["stg_fact_rais"].groupBy("cnae_classe", "sigla_uf").agg(F.sum("quantidade_vinculos").alias("vinculos"))
    totals = parts.groupBy("cnae_classe").agg(F.sum("vinculos").alias("vinculos_classe"))
    return parts.join(totals, "cnae_classe").withColumns({
        "pct_1": rates.share_pct(F.col("vinculos"), F.col("vinculos_classe"), 1),
        "pct_2": rates.share_pct(F.col("vinculos"), F.col("vinculos_classe"), 2),
    })


@_register
def year_intersection(raw: Layer, stg: Layer) -> DataFrame:
    """Bonds per year inside the years common to notices and bonds."""
    notice_years = stg["stg_fact_cat"].select("ano").distinct()
    bonds = stg["stg_fact_rais"].groupBy("ano").agg(F.sum("quantidade_vinculos").alias("vinculos"))
    first, last = relations.year_intersection(notice_years, bonds)
    return bonds.filter(F.col("ano").between(first, last)).withColumns({"ano_inicio": first, "ano_fim": last})


# --- codes, ages, labels ---------------------------------------------------------

@_register
def explode_lines(raw: Layer, stg: Layer) -> DataFrame:
    """Occurrences of every raw code per certificate line."""
    lines = {f"linha_{x}_raw": x for x in ("a", "b", "c", "d")}
    long = explode_codes(stg["stg_fact_sim"], lines, {"linha_ii_raw": "ii"}, "*", "fonte_linha", "cid_raw", ["total_obitos"])
    return long.groupBy("fonte_linha", "cid_raw").agg(F.sum("total_obitos").alias("ocorrencias"))


@_register
def cid_normalisers(raw: Layer, stg: Layer) -> DataFrame:
    """Every spelling of a basic cause or a line under the four normalisers."""
    columns = ["cid_10_causa", "linha_a", "linha_b", "linha_c", "linha_d", "linha_ii"]
    spelled = raw["fact_sim"].select(F.explode(F.array(*columns)).alias("texto"))
    found = spelled.filter(F.col("texto").isNotNull()).groupBy("texto").agg(F.count(F.lit(1)).alias("linhas"))
    code = F.col("texto")
    return found.select(
        "texto", "linhas",
        codes.basic_cause(code).alias("causa_basica"),
        codes.certificate_code(F.trim(code)).alias("linha"),
        codes.comorbidity_code(code).alias("comorbidade"),
        codes.dictionary_code(code).alias("dicionario"),
        codes.undotted(codes.dictionary_code(code)).alias("sem_ponto"),
    )


@_register
def age_and_bands(raw: Layer, stg: Layer) -> DataFrame:
    """Notices per age at the accident and age band."""
    aged = with_age(raw["cat_microdados"].select(*age_dates()))
    counted = aged.groupBy(F.col("_age").alias("idade")).agg(F.count(F.lit(1)).alias("avisos"))
    return counted.withColumn("faixa_etaria", ages.age_band(F.col("idade")))


@_register
def age_bands_closed(raw: Layer, stg: Layer) -> DataFrame:
    """Deaths per (possibly fractional) age and closed age band."""
    counted = raw["fact_sim"].groupBy("idade").agg(F.sum("total_obitos").alias("obitos"))
    return counted.withColumn("faixa_etaria", ages.age_band(F.col("idade"), 130))


@_register
def death_category(raw: Layer, stg: Layer) -> DataFrame:
    """Deaths per basic cause, work-accident flag and coverage category."""
    counted = stg["stg_fact_sim"].groupBy("cid_10_causa", "acidente_trabalho").agg(F.sum("total_obitos").alias("obitos"))
    return counted.withColumn("categoria_morte", codes.death_category(F.col("cid_10_causa"), F.col("acidente_trabalho")))


# --- relations and audits --------------------------------------------------------

@_register
def anti_join_null_aware(raw: Layer, stg: Layer) -> DataFrame:
    """Occupations of the notices that are NOT IN the dictionary."""
    used = stg["stg_fact_cat"].groupBy("cbo_codigo").agg(F.count(F.lit(1)).alias("avisos"))
    return relations.null_aware_anti(used, F.col("cbo_codigo"), stg["stg_dim_cbo"].select("cbo_codigo"), "cbo_codigo")


@_register
def prefix_audit(raw: Layer, stg: Layer) -> DataFrame:
    """Class prefixes of two to four characters shared by several classes."""
    audits = [
        relations.prefix_fan_out(stg["stg_dim_cnae"], "cnae_classe", n).withColumn("tamanho", F.lit(n)) for n in (2, 3, 4)
    ]
    return reduce(DataFrame.unionByName, audits)


def _code_counts(df: DataFrame, code: str) -> DataFrame:
    return df.groupBy(code).agg(F.count(F.lit(1)).alias("n"))


@_register
def match_rate(raw: Layer, stg: Layer) -> DataFrame:
    """Filled and matched notices per code column."""
    pairs = [
        ("cid_10", "stg_dim_cid", "cid_codigo"),
        ("cbo_codigo", "stg_dim_cbo", "cbo_codigo"),
        ("municipio_id_6", "stg_dim_municipio", "municipio_id_6"),
    ]
    return relations.match_rates(stg["stg_fact_cat"], {code: stg[dim].select(key) for code, dim, key in pairs}, "coluna")


@_register
def match_rate_dotless(raw: Layer, stg: Layer) -> DataFrame:
    """Match rate of raw, undotted causes of death against the undotted dictionary."""
    causes = raw["fact_sim"].withColumn("cid", codes.undotted(F.trim("cid_10_causa")))
    known = stg["stg_dim_cid"].select(codes.undotted(F.col("cid_codigo")).alias("cid"))
    return relations.match_rate(_code_counts(causes, "cid"), "cid", "n", known, "cid")


@_register
def null_profile(raw: Layer, stg: Layer) -> DataFrame:
    """NULLs per column of the monthly accident mart."""
    columns = ["cnae_classe", "cnae_descricao", "cbo_codigo", "cbo_descricao", "cid_10", "cid_descricao"]
    return relations.null_profile(MARTS["mart_cat_cnae_cbo_mes"](stg), columns)


# --- data checks -----------------------------------------------------------------

def _tables(stg: Layer) -> quality.Tables:
    return quality.tables_of(stg, Layer(lambda name: MARTS[name](stg)))


@_register
def dq_not_null(raw: Layer, stg: Layer) -> DataFrame:
    return quality.report(_tables(stg), kinds=("not_null",))


@_register
def dq_unique(raw: Layer, stg: Layer) -> DataFrame:
    return quality.report(_tables(stg), kinds=("unique",))


@_register
def dq_accepted(raw: Layer, stg: Layer) -> DataFrame:
    return quality.report(_tables(stg), kinds=("accepted_values",))


@_register
def dq_relationships(raw: Layer, stg: Layer) -> DataFrame:
    return quality.report(_tables(stg), kinds=("relationships",))


@_register
def dq_summary(raw: Layer, stg: Layer) -> DataFrame:
    """PASS / WARN / ERROR over all declared checks."""
    return quality.summary(quality.report(_tables(stg)))


# --- export and replacement ------------------------------------------------------

@_register
def csv_export(raw: Layer, stg: Layer) -> DataFrame:
    """A mart after it went through its CSV file."""
    mart = MARTS["mart_risco_teorico_vs_observado"](stg)
    spark = mart.sparkSession
    folder = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    export.export_csv("mart_risco_teorico_vs_observado", mart, folder)
    # every cell of this mart that is empty is NULL; parts of a folder have one header in all
    cells = ", ".join(f"{c} string" for c in mart.columns)
    read = spark.read.schema(cells).option("recursiveFileLookup", "true").option("multiLine", "true").option("escape", '"').csv(folder)
    first = mart.columns[0]
    rows = read.filter(~F.col(first).isin(first, export.BYTE_ORDER_MARK + first))
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in mart.schema])


@_register
def table_replacement(raw: Layer, stg: Layer) -> DataFrame:
    """A table that was loaded twice: the second load replaces the first as a whole."""
    target = f"{shared_folder(raw['dim_cnae'].sparkSession)}/replaced-{uuid.uuid4().hex}"
    loads.replace_table(raw["rais_vinculos"], target, "ano")
    loads.replace_table(raw["rais_vinculos"].filter("ano >= 1994"), target, "ano")
    stored = versions.read(raw["dim_cnae"].sparkSession, target)
    return stored.groupBy("ano").agg(F.count(F.lit(1)).alias("linhas"), F.sum("quantidade_vinculos").alias("vinculos"))


@_register
def snapshot_replacement(raw: Layer, stg: Layer) -> DataFrame:
    """The replaced years once more, read back from the table's newest snapshot."""
    old, fresh = _evolved(raw), raw["fact_sim"].filter("ano <> 1996").withColumn("total_obitos", F.col("total_obitos") * 2)
    spark = old.sparkSession
    target = f"{shared_folder(spark)}/snapshots-{uuid.uuid4().hex}"
    loads.replace_table(old, target, "ano")
    loads.reload_pending_years(spark, target, fresh, 1994, 2003)
    filled = [F.count(c).alias(c) for c in (*loads.LATER_COLUMNS, "linha_ii")]
    return versions.read(spark, target).groupBy("ano").agg(F.count(F.lit(1)).alias("linhas"), F.sum("total_obitos").alias("obitos"), *filled)


# --- documented reports ----------------------------------------------------------

@_register
def report_top_classes(raw: Layer, stg: Layer) -> DataFrame:
    """25 graded classes with most accidents."""
    rows = MARTS["mart_risco_teorico_vs_observado"](stg)
    return rows.orderBy(F.desc("total_acidentes"), F.asc("cnae_classe")).limit(25)


@_register
def report_top_combinations(raw: Layer, stg: Layer) -> DataFrame:
    """25 most frequent activity, occupation and diagnosis combinations."""
    keys = ["cnae_classe", "cnae_descricao", "cbo_codigo", "cbo_descricao", "cid_descricao"]
    rows = MARTS["mart_cat_cnae_cbo_mes"](stg).groupBy(*keys).agg(
        F.sum("total_acidentes").alias("acidentes"), F.sum("total_obitos").alias("obitos")
    )
    return rows.orderBy(F.desc("acidentes"), *[F.asc_nulls_last(k) for k in keys]).limit(25)


@_register
def report_injuries_of_division(raw: Layer, stg: Layer) -> DataFrame:
    """20 most frequent injuries in the classes of one division."""
    rows = MARTS["mart_risco_acidente"](stg).filter(F.col("cnae_classe").like("41%"))
    counted = rows.groupBy("natureza_lesao", "parte_corpo").agg(
        F.sum("total_acidentes").alias("acidentes"), F.sum("total_obitos_acidente").alias("obitos")
    )
    keys = [F.asc_nulls_last("natureza_lesao"), F.asc_nulls_last("parte_corpo")]
    return counted.orderBy(F.desc("acidentes"), *keys).limit(20)


@_register
def report_accidental_deaths(raw: Layer, stg: Layer) -> DataFrame:
    """Accidental deaths per class; suicide is not among them."""
    rows = MARTS["mart_risco_morte"](stg).filter(F.col("categoria_morte").ilike("acidental%"))
    return rows.groupBy("cnae_classe", "categoria_morte").agg(F.sum("total_obitos").alias("obitos"))


@_register
def report_serious_diseases(raw: Layer, stg: Layer) -> DataFrame:
    """Part-II conditions of the chapters usual in serious-disease covers."""
    rows = MARTS["mart_risco_doenca"](stg).filter(
        (F.col("fonte_linha") == "ii") & codes.chapter(F.col("cid_normalizado")).isin("C", "I", "N", "J", "F")
    )
    return rows.groupBy("cid_normalizado", "cid_descricao").agg(F.sum("total_obitos_com_condicao").alias("obitos"))


@_register
def report_family_history(raw: Layer, stg: Layer) -> DataFrame:
    """Part-II codes Z80 and above: personal and family history."""
    code = F.col("cid_normalizado")
    rows = MARTS["mart_risco_doenca"](stg).filter(
        (F.col("fonte_linha") == "ii") & (codes.chapter(code) == "Z") & (code >= "Z80")
    )
    return rows.groupBy("cid_normalizado", "cid_descricao").agg(F.sum("total_obitos_com_condicao").alias("obitos"))


# --- registry --------------------------------------------------------------------

def _query(plan: Plan) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = raw_layer(spark, sf_dir)
        return plan(raw, staging_layer(raw))

    return run


def all_queries() -> dict[str, Query]:
    plans: dict[str, Plan] = {name: (lambda raw, stg, n=name: stg[n]) for name in STAGING}
    plans |= {name: (lambda raw, stg, m=build: m(stg)) for name, build in MARTS.items()}
    return {name: _query(plan) for name, plan in (plans | OPERATORS).items()}
