"""Test adapter: derives the raw tables from the generic driver tables.

Every column is an expression in the SQL subset shared by Spark and DuckDB, so
the engine and its oracle start from the same rows.  Only this module knows the
driver tables; everything above works on the raw layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from occrisk.plans.layers import Layer
from occrisk.sources import dictionaries, microdata, notices, records

# Bonds represented by each line of the driver's microdata: spreads the score
# over all of its bands.
BONDS_PER_LINE = 50
FIRST_YEAR, LAST_YEAR = 1900, 2100
DEATH_STATES = ("SP",)


def cod4(k: str) -> str:
    return f"lpad(cast(({k})*33+111 as string),4,'0')"


def classe(p: str) -> str:
    return f"{cod4(f'({p})%300')} || cast(((({p})%300)*7)%10 as string)"


def subclasse(p: str) -> str:
    part = f"cast(floor(({p})/300) as bigint)"
    text = f"cast({part} as string)"
    # two digits at least; lpad alone would cut longer numbers
    return f"{classe(p)} || case when {part} < 100 then lpad({text},2,'0') else {text} end"


def cbo(s: str) -> str:
    return f"cast(100000+(({s})*8887)%900000 as string)"


def pool(n: str) -> str:
    """Undotted four-character diagnosis code."""
    return (
        f"(chr(cast(65+(({n})*7)%26 as int)) || lpad(cast((({n})*13)%100 as string),2,'0')"
        f" || case when ({n})%6=0 then 'X' else cast(({n})%10 as string) end)"
    )


def dmy(d: str) -> str:
    return (
        f"lpad(cast(day({d}) as string),2,'0') || '/' || lpad(cast(month({d}) as string),2,'0')"
        f" || '/' || cast(year({d}) as string)"
    )


def ym(d: str) -> str:
    return f"cast(year({d}) as string) || '/' || lpad(cast(month({d}) as string),2,'0')"


K = "(((o_orderkey%300)*(o_custkey%300))%300)"

_CAT = {
    "agente_causador": "case when o_orderkey%19=0 then '{ñ class}' else 'Agente ' || cast(o_orderkey%9 as string) end",
    "data_competencia": f"case when o_orderkey%101=0 then '*****' else {ym('o_orderdate')} end",
    "data_acidente": dmy("o_orderdate"),
    "cbo": "case when o_orderkey%29=0 then '{ñ class}' when o_orderkey%31=0 then '000000' else "
    + cbo("cast(floor(o_custkey/15) as bigint)") + " end",
    "cid_10": f"case when o_orderkey%23=0 then '{{ñ class}}' when o_orderkey%6=0 then left({pool('o_orderkey')},3)"
    f" else left({pool('o_orderkey')},3) || '.' || right({pool('o_orderkey')},1) end",
    "cnae_empregador_cod": "case when o_orderkey%97=0 then '9999' when o_orderkey%89=0 then '0'"
    f" else cast({K}*33+111 as string) end",
    "indica_obito": "case when o_orderstatus='P' then null when o_orderkey%61=0 then 'Sim' else 'Não' end",
    "munic_empregador": "cast(350000+o_custkey%25 as string) || '-Cidade'",
    "natureza_lesao": "case when o_orderkey%17=0 then '{ñ class}' else 'Lesao ' || cast(o_orderkey%7 as string) end",
    "parte_corpo": "case when o_orderkey%13=0 then '{ñ class}' else 'Parte ' || cast(o_orderkey%11 as string) end",
    "sexo": "case o_orderkey%5 when 0 then 'Feminino' when 4 then 'Indeterminado' else 'Masculino' end",
    "tipo_acidente": f"case when {K}%41=0 then 'Trajeto' when o_orderpriority='1-URGENT' then 'Típico'"
    " when o_orderpriority='2-HIGH' then 'TÃ­pico' when o_orderpriority='3-MEDIUM' then 'Trajeto'"
    " when o_orderpriority='4-NOT SPECIFIED' then 'Doença' else 'Ignorado' end",
    "uf_empregador": "case o_custkey%3 when 0 then 'São Paulo' when 1 then 'Rio de Janeiro' else 'Minas Gerais' end",
    "data_nascimento": "case when o_orderkey%43=0 then '{ñ class}' when o_orderkey%47=0 then ''"
    " when o_orderkey%53=0 then '29/02/' || cast(1960+4*(o_custkey%8) as string)"
    " else lpad(cast(1+o_custkey%28 as string),2,'0') || '/' || lpad(cast(1+o_orderkey%12 as string),2,'0')"
    " || '/' || cast(year(o_orderdate)-(o_custkey%72) as string) end",
    "_source_file": "'D.SDA.PDA.005.CAT.' || cast(year(o_orderdate) as string)"
    " || lpad(cast(month(o_orderdate) as string),2,'0') || '.ZIP'",
}

_SIM = {
    # some years before the range and some other states: the source must drop them
    "ano": "cast(1995+event_id%7-case when event_id%19=0 then 100 else 0 end as int)",
    "sigla_uf": "case when event_id%13=0 then 'RJ' when event_id%17=0 then 'MG' else 'SP' end",
    "id_municipio_residencia": "cast(3500000+(event_id%25)*10+(event_id%25)%7 as string)",
    "ocupacao": f"case when event_id%33=0 then null else {cbo('cast(floor(user_id*2/3) as bigint)')} end",
    "causa_basica": pool("event_id"),
    "acidente_trabalho": "case event_id%5 when 0 then '1' when 1 then '1.0' when 2 then '2' when 3 then '9' else null end",
    "sexo": "case event_id%3 when 0 then '1' when 1 then '2' else '9' end",
    "idade": "cast((event_id*3)%140 as double)+case when event_id%10=0 then 0.5e0 else 0e0 end",
    "linha_a": f"case when event_id%50=0 then '*I10X*E149' else '*' || {pool('event_id+1')} end",
    "linha_b": f"case when event_id%2=1 then '*' || {pool('event_id+2')} else null end",
    "linha_c": f"case when event_id%4=1 then '*' || {pool('event_id+4')} else ' ' end",
    "linha_d": f"case when event_id%16=1 then '*' || {pool('event_id+6')} else null end",
    "linha_ii": f"case event_id%3 when 0 then '*' || {pool('event_id+3')} || '*' || {pool('event_id+5')}"
    " when 1 then ' ' else null end",
}

# Notices as they would lie in landing files: one layout per month, padded
# cells, missing-value words, blank activities and records that are too wide.
_LANDED = {
    "path": f"'landing/' || {_CAT['_source_file']}",
    "layout": "case month(o_orderdate)%3 when 1 then 'A' when 2 then 'B' else 'C' end",
    "c_agent": _CAT["agente_causador"],
    "c_ym": _CAT["data_competencia"],
    "c_dmy": f"case when o_orderkey%71=0 then 'NaN' else ' ' || {dmy('o_orderdate')} end",
    "c_occ": f"case when o_orderkey%37=0 then 'NA' else ' ' || {_CAT['cbo']} || ' ' end",
    "c_occ_text": "'Ocupacao-' || cast(o_custkey%10 as string)",
    "c_diag": _CAT["cid_10"],
    "c_diag_text": "'Diagnostico ' || cast(o_orderkey%10 as string)",
    "c_cnae": f"case when o_orderkey%59=0 then '' when o_orderkey%67=0 then '  ' else {_CAT['cnae_empregador_cod']} end",
    "c_cnae_text": "'Atividade ' || cast(o_custkey%10 as string)",
    "c_flag": _CAT["indica_obito"],
    "c_munic": _CAT["munic_empregador"],
    "c_lesion": _CAT["natureza_lesao"],
    "c_part": _CAT["parte_corpo"],
    "c_sex": _CAT["sexo"],
    "c_kind": _CAT["tipo_acidente"],
    "c_uf": _CAT["uf_empregador"],
    "c_birth": _CAT["data_nascimento"],
    "c_issuer": "'Emitente ' || cast(o_orderkey%4 as string)",
    "c_benefit": "case when o_orderkey%7=0 then 'NaN' else 'Pa ' || cast(o_orderkey%5 as string) end",
    "c_affiliation": "'Filiado ' || cast(o_custkey%3 as string)",
    "c_origin": "'Origem ' || cast(o_orderkey%2 as string) || ' '",
    "c_uf_accident": "'UF ' || cast(o_custkey%5 as string)",
    "c_granted": "'Despacho ' || cast(o_orderkey%28 as string)",
    "c_issued": "'Emissao ' || cast(o_orderkey%27 as string)",
    "c_employer": "cast(10000+o_custkey as string)",
    "c_extra": "case when o_orderkey%113=0 then 'x' else null end",
}

# Header of each layout, and the landed column behind every header cell.
_FIRST = [("Agente  Causador  Acidente", "c_agent")]
_MIDDLE = [
    ("CNAE2.0 Empregador", "c_cnae"), ("CNAE2.0 Empregador", "c_cnae_text"), ("Munic Empr", "c_munic"),
    ("Natureza da Lesão", "c_lesion"), ("Parte Corpo Atingida", "c_part"), ("Sexo", "c_sex"),
    ("Tipo do Acidente", "c_kind"), ("UF Munic. Empregador", "c_uf"), ("Data Nascimento", "c_birth"),
    ("Emitente CAT", "c_issuer"), ("Espécie do benefício", "c_benefit"), ("Filiação Segurado", "c_affiliation"),
    ("Origem de Cadastramento CAT", "c_origin"), ("UF  Munic.  Acidente", "c_uf_accident"),
    ("Data Despacho Benefício", "c_granted"), ("Data Emissão CAT", "c_issued"), ("CNPJ/CEI Empregador", "c_employer"),
]
LAYOUT_CELLS = {
    "A": _FIRST + [("Data Acidente", "c_ym"), ("CBO", "c_occ"), ("CBO", "c_occ_text"), ("CID-10", "c_diag"),
                   ("CID-10", "c_diag_text"), ("Indica acidente", "c_flag")] + _MIDDLE + [("Data Acidente", "c_dmy")],
    "B": _FIRST + [("Data Acidente", "c_ym"), ("CBO", "c_occ || '-' || c_occ_text"),
                   ("CID-10", "c_diag || ' ' || c_diag_text"), ("Indica Óbito Acidente", "c_flag")]
    + _MIDDLE + [("Data Acidente", "c_ym"), ("Data Acidente", "c_dmy")],
    "C": _FIRST + [("CBO", "c_occ"), ("CBO", "c_occ_text"), ("CID-10", "c_diag"), ("CID-10", "c_diag_text"),
                   ("Indica Óbito Acidente", "c_flag")] + _MIDDLE + [("Data Acidente", "c_dmy")],
}

# Entries of two file catalogues; the second repeats part of the first.
_URL = (
    "'https://files.example/' || case o_custkey%6"
    f" when 0 then 'cat' || cast(year(o_orderdate)-1 as string) || '-comp-' || cast(month(o_orderdate) as string)"
    " || '-' || cast(year(o_orderdate) as string) || '.csv'"
    " when 1 then 'cat-copmp-04-05-06.zip'"
    " when 2 then 'dicionario-' || cast(year(o_orderdate) as string) || '.xlsx'"
    " when 3 then 'notes' || cast(month(o_orderdate) as string) || '.csv'"
    " when 4 then 'd.sda.pda.005.cat.' || cast(year(o_orderdate) as string) || lpad(cast(month(o_orderdate) as string),2,'0') || '.zip'"
    f" else {_CAT['_source_file']} end"
)

# Records as they would be typed: cells with separators, quotes and line breaks.
_NOTE = (
    "case o_orderkey%7 when 0 then 'Disse \"ai\" ' || cast(o_orderkey as string) when 1 then 'Duas' || chr(10) || 'linhas; ' || cast(o_orderkey as string)"
    " when 2 then '5\" cano' when 3 then 'fim' || chr(13) || chr(10) || '\"x\"' when 4 then '' when 5 then 'a' || chr(13) || 'b'"
    " else 'Texto ' || cast(o_orderkey as string) end"
)
_TYPED = {
    "path": f"'typed/' || {_CAT['_source_file']}",
    "chave": "o_orderkey",
    "nota": _NOTE,
    "tipo": "o_orderpriority",
    "texto": f"cast(o_orderkey as string) || ';' || case when o_orderkey%7 in (0, 1, 3, 5) then '\"' || replace({_NOTE}, '\"', '\"\"') || '\"'"
    f" else {_NOTE} end || ';' || o_orderpriority",
}

# raw table -> (driver table, filter, distinct, columns)
PROJECTIONS: dict[str, tuple[str, str | None, bool, dict[str, str]]] = {
    # One row per subclass.
    "dim_cnae": ("part", None, True, {
        "subclasse": subclasse("p_partkey"),
        "descricao_subclasse": f"' Sub ' || {subclasse('p_partkey')}",
        "classe": classe("p_partkey"),
        "descricao_classe": f"'Classe ' || {classe('p_partkey')}",
        "grupo": f"left({classe('p_partkey')},3)",
        "descricao_grupo": f"'Grupo ' || left({classe('p_partkey')},3)",
        "divisao": f"left({classe('p_partkey')},2)",
        "descricao_divisao": f"'Divisao ' || left({classe('p_partkey')},2)",
        "secao": "chr(cast(65+(p_partkey%300)%21 as int))",
        "descricao_secao": "'Secao ' || chr(cast(65+(p_partkey%300)%21 as int))",
    }),
    "dim_grau_risco": ("part", "p_partkey%300%17<>0", True, {
        "cnae_classe": classe("p_partkey"),
        "grau_risco": "cast(1+(p_partkey%300)%4 as int)",
    }),
    "grau_risco_sheet": ("part", None, False, {
        "nivel": "case when p_partkey%5=4 then 'Classe' else 'Subclasse' end",
        "codigo": f"left({classe('p_partkey')},2) || '.' || substr({classe('p_partkey')},3,2) || '-'"
        f" || substr({classe('p_partkey')},5,1) || '/' || substr({subclasse('p_partkey')},6)",
        "gr": "case when p_partkey%17=0 then null else ' ' || cast(1+p_partkey%4 as string) end",
        "linha": "p_partkey",
    }),
    "dim_municipio": ("nation", None, False, {
        "id_municipio": "cast(3500000+n_nationkey*10+n_nationkey%7 as string)",
        "id_municipio_6": "cast(350000+n_nationkey as string)",
        "nome": "n_name",
        "sigla_uf": "case n_regionkey when 0 then 'sp' when 1 then 'RJ' else 'MG' end",
        "nome_uf": "'UF ' || cast(n_regionkey as string)",
        "nome_regiao": "'Regiao ' || cast(n_regionkey as string)",
    }),
    "dim_cid_subcat": ("events", f"event_id%6<>0 and left({pool('event_id')},1)<>'Q'", True, {
        "SUBCAT": pool("event_id"),
        "DESCRICAO": f"'Desc ' || {pool('event_id')}",
    }),
    "dim_cid_cat": ("events", f"left({pool('event_id')},1)<>'Q'", True, {
        "CAT": f"left({pool('event_id')},3)",
        "DESCRICAO": f"'Categoria ' || left({pool('event_id')},3)",
    }),
    "rais_microdados": ("lineitem", None, False, {
        "ano": "cast(year(l_shipdate)+case when l_orderkey%29=0 then 200 else 0 end as int)",
        "sigla_uf": "case l_returnflag when 'A' then ' sp' when 'N' then 'RJ' else 'MG' end",
        "cnae_2_subclasse": f"case when l_orderkey%211=0 then '9999999' else {subclasse('l_partkey')} end",
        "cbo_2002": cbo("l_suppkey"),
        "vinculo_ativo_3112": "case l_linestatus when 'O' then '1' else '0' end",
    }),
    "cat_microdados": ("orders", None, False, {
        name: _CAT.get(name, "cast(null as string)") for name in notices.NOTICE_COLUMNS
    }),
    "sim_microdados": ("events", None, False, _SIM),
    "landed_notices": ("orders", None, False, _LANDED),
    "typed_records": ("orders", None, False, _TYPED),
    "catalogue": ("orders", None, False, {
        "url": _URL,
        "catalogo": "cast(1+o_orderkey%2 as int)",
        "posicao": "o_orderkey",
        "nome": "'Arquivo ' || cast(o_orderkey%10 as string)",
        "formato": "case o_custkey%5 when 0 then 'csv' when 1 then 'Zip' when 2 then 'XLSX' when 3 then null else 'CSV' end",
    }),
    # Load attempts per notice file: started always, finished or failed by key.
    "load_events": ("orders", None, True, {
        "id": f"{_CAT['_source_file']} || '#' || cast(o_custkey%3 as string)",
        "table_name": "'cat_microdados'",
        "partition_dt": "cast(null as string)",
        "file_name": _CAT["_source_file"],
        "started_at": "cast('2024-01-01 00:00:00' as timestamp)",
        "finished_at": "case when o_orderkey%2=0 then cast('2024-01-01 01:00:00' as timestamp) else null end",
        "status": "case when o_orderkey%2=1 then 'running' when month(o_orderdate)%4=o_custkey%3 then 'success' else 'error' end",
        "rows_loaded": "cast(null as bigint)",
        "error_msg": "cast(null as string)",
    }),
}

# One row per occupation: distinct supplier keys may share a code from 900 000 on.
OCCUPATION = ("supplier", "s_suppkey", "s_suppkey%23<>22", cbo("s_suppkey"), {
    "cbo_2002": cbo("s_suppkey"),
    "descricao": "' Ocupacao ' || cast(s_suppkey as string)",
    "grande_grupo": f"left({cbo('s_suppkey')},1)",
    "descricao_grande_grupo": f"'Grande grupo ' || left({cbo('s_suppkey')},1)",
    "indicador_cbo_2002_ativa": "case when s_suppkey%11=0 then '0' else '1' end",
})


_SCHEMAS: dict[str, StructType] = {}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table; its schema is inferred (a job of its own) only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _landed_headers(spark: SparkSession, landed: DataFrame) -> DataFrame:
    """Header cells of every landed file, as a header reader would give them."""
    known = spark.createDataFrame(
        [(layout, [name for name, _ in cells]) for layout, cells in LAYOUT_CELLS.items()],
        "layout string, header array<string>",
    )
    files = landed.select("path", "layout").distinct()
    return files.join(known, "layout").select("path", "header", F.lit(None).cast("string").alias("error"))


def _landed_records(landed: DataFrame) -> DataFrame:
    """Records of the landed files, cells by position."""
    out = F.lit(None).cast("array<string>")
    for layout, cells in LAYOUT_CELLS.items():
        row = F.array(*[F.expr(cell) for _, cell in cells], F.col("c_extra"))
        out = F.when(F.col("layout") == layout, row).otherwise(out)
    return landed.select("path", out.alias("cells"))


def _typed_lines(typed: DataFrame) -> DataFrame:
    """Typed records as the lines of their files, in blocks that end anywhere, also inside a record."""
    lines = typed.select("path", "chave", F.posexplode(F.split("texto", "\n")).alias("n", "text"))
    at = F.col("chave") * 8 + F.col("n")
    return records.cut_lines(lines.select("path", F.floor((at + 7) / 64).alias("block"), at.alias("at"), "text"))


def _windows_files(entries: DataFrame) -> DataFrame:
    """One dictionary file per letter, in the Windows encoding, with quotation marks and dashes of its own."""
    line = F.concat("SUBCAT", F.lit(";\x93"), "DESCRICAO", F.lit("\x94 \x96 ç"))
    files = entries.groupBy(F.left("SUBCAT", F.lit(1)).alias("path")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    text = F.concat(F.lit("SUBCAT;DESCRICAO\n"), F.array_join("lines", "\n"))
    return files.select("path", F.encode(text, "ISO-8859-1").alias("content"))


def raw_layer(spark: SparkSession, sf_dir: str) -> Layer:
    """Raw layer on top of the driver tables in ``sf_dir``."""

    def build(name: str) -> DataFrame:
        if name == "landed_headers":
            return _landed_headers(spark, layer["landed_notices"])
        if name == "landed_records":
            return _landed_records(layer["landed_notices"])
        if name == "typed_lines":
            return _typed_lines(layer["typed_records"])
        if name == "windows_files":
            return _windows_files(layer["dim_cid_subcat"])
        if name == "rais_vinculos":
            bonds = microdata.aggregate_bonds(layer["rais_microdados"], FIRST_YEAR, LAST_YEAR)
            return bonds.withColumn("quantidade_vinculos", F.col("quantidade_vinculos") * BONDS_PER_LINE)
        if name == "fact_sim":
            return microdata.aggregate_deaths(layer["sim_microdados"], DEATH_STATES, FIRST_YEAR, LAST_YEAR)
        if name == "dim_cid":
            return dictionaries.diagnosis_dictionary(layer["dim_cid_subcat"], layer["dim_cid_cat"])
        if name == "dim_cbo":
            table, key, where, code, columns = OCCUPATION
            keys = tables[table].filter(where).groupBy(F.expr(code).alias("_c"))
            rows = keys.agg(F.min(key).alias(key)).selectExpr(*[f"{e} as {c}" for c, e in columns.items()])
            return microdata.dimension(rows, name)
        table, where, distinct, columns = PROJECTIONS[name]
        source = tables[table]
        rows = (source.filter(where) if where else source).selectExpr(*[f"{e} as {c}" for c, e in columns.items()])
        return rows.distinct() if distinct else rows

    tables = Layer(lambda name: driver_table(spark, sf_dir, name))
    layer = Layer(build)
    return layer
