"""Operator queries as DuckDB statements."""

from __future__ import annotations

from oracles.marts import MARTS
from oracles.shared import pct, per_mille


def _cell(col: str) -> str:
    """Landed cell: missing-value words to NULL, then trimmed."""
    return f"(case when {col} in ('NA', 'NaN', '') then null else trim({col}) end)"


_UNIFIED = f"""
select {_cell('c_agent')} as agente_causador,
  case when layout <> 'C' then {_cell('c_ym')}
    else regexp_replace({_cell('c_dmy')}, '^([0-9]+)/([0-9]+)/([0-9]+)$', '\\3/\\2') end as data_competencia,
  {_cell('c_dmy')} as data_acidente,
  case when layout = 'B' then trim(split_part({_cell("c_occ || '-' || c_occ_text")}, '-', 1)) else {_cell('c_occ')} end as cbo,
  case when layout = 'B' then split_part({_cell("c_diag || ' ' || c_diag_text")}, ' ', 1) else {_cell('c_diag')} end as cid_10,
  {_cell('c_cnae')} as cnae_empregador_cod, {_cell('c_cnae_text')} as cnae_empregador_desc,
  {_cell('c_issuer')} as emitente, {_cell('c_benefit')} as especie_beneficio, {_cell('c_affiliation')} as filiacao,
  {_cell('c_flag')} as indica_obito, {_cell('c_munic')} as munic_empregador, {_cell('c_lesion')} as natureza_lesao,
  {_cell('c_origin')} as origem_cadastro, {_cell('c_part')} as parte_corpo, {_cell('c_sex')} as sexo,
  {_cell('c_kind')} as tipo_acidente, {_cell('c_uf_accident')} as uf_acidente, {_cell('c_uf')} as uf_empregador,
  {_cell('c_granted')} as data_despacho, {_cell('c_birth')} as data_nascimento, {_cell('c_issued')} as data_emissao,
  {_cell('c_employer')} as cnpj_empregador, split_part(path, '/', 2) as _source_file, c_extra is not null as malformed
from landed_notices"""

_STATE = "if(f = 0, 'PASS', if(s = 'warn', 'WARN', 'ERROR'))"

_NOT_NULL = {
    "stg_dim_cnae": ["cnae_subclasse", "cnae_classe", "cnae_secao"],
    "stg_dim_cbo": ["cbo_codigo"],
    "stg_dim_municipio": ["municipio_id", "municipio_id_6", "sigla_uf"],
    "stg_dim_grau_risco": ["cnae_classe", "grau_risco", "grau_risco_descricao"],
    "stg_dim_cid": ["cid_codigo"],
    "stg_fact_rais": ["cnae_subclasse", "cnae_classe", "cbo_codigo", "quantidade_vinculos"],
    "stg_fact_cat": ["cnae_cod_4"],
    "stg_fact_sim": ["cbo_codigo", "total_obitos"],
    "stg_sim_linhas": ["fonte_linha"],
    "mart_top_cbo_por_cnae": ["rank_cbo", "cbo_codigo"],
    "mart_perfil_risco_cnae": ["rank_cbo", "cbo_codigo", "rank_cid", "cid_10"],
}
_UNIQUE = {
    "stg_dim_cnae": "cnae_subclasse", "stg_dim_cbo": "cbo_codigo", "stg_dim_municipio": "municipio_id",
    "stg_dim_grau_risco": "cnae_classe", "stg_dim_cid": "cid_codigo",
}


def _source(model: str) -> str:
    return f"({MARTS[model]})" if model in MARTS else model


def _check(model: str, column: str, kind: str, severity: str, failures: str) -> str:
    return (
        f"select '{model}' as modelo, '{column}' as coluna, '{kind}' as teste, '{severity}' as s, "
        f"cast(({failures}) as bigint) as f"
    )


_DQ = {
    "not_null": [
        _check(m, c, "not_null", "error", f"select count(*) - count({c}) from {_source(m)}")
        for m, cols in _NOT_NULL.items() for c in cols
    ],
    "unique": [
        _check(m, c, "unique", "error", f"select count(*) from (select {c} from {m} where {c} is not null group by {c} having count(*) <> 1)")
        for m, c in _UNIQUE.items()
    ],
    "accepted": [
        _check("stg_dim_grau_risco", "grau_risco", "accepted_values", "error",
               "select count(distinct grau_risco) from stg_dim_grau_risco where grau_risco < 1 or grau_risco > 4"),
        _check("stg_sim_linhas", "fonte_linha", "accepted_values", "error",
               "select count(distinct fonte_linha) from stg_sim_linhas where fonte_linha not in ('a', 'b', 'c', 'd', 'ii')"),
    ],
    "relationships": [
        _check("stg_fact_rais", "cnae_subclasse", "relationships", "warn",
               "select count(*) from stg_fact_rais r where r.cnae_subclasse not in (select cnae_subclasse from stg_dim_cnae)"),
    ],
}


def _dq(*kinds: str) -> str:
    rows = " union all ".join(sql for kind in kinds for sql in _DQ[kind])
    return f"select modelo, coluna, teste, s as severidade, f as falhas, {_STATE} as status from ({rows})"


def _rate_row(column: str, table: str, dim: str, key: str, expr: str | None = None) -> str:
    code = expr or column
    return f"""
select '{column}' as coluna, count(*) as total, count(c) as preenchidos, count(c) filter (hit) as casados,
  {pct('(count(c) filter (hit))', 'count(c)', 2)} as pct_casados
from (select {code} as c, {code} in (select {key} from {dim}) as hit from {table})"""


_PROFILED = {
    "dim_cnae": ["subclasse", "descricao_subclasse", "classe", "descricao_classe", "grupo", "descricao_grupo",
                 "divisao", "descricao_divisao", "secao", "descricao_secao"],
    "dim_cbo": ["cbo_2002", "descricao", "grande_grupo", "descricao_grande_grupo", "indicador_cbo_2002_ativa"],
    "dim_municipio": ["id_municipio", "id_municipio_6", "nome", "sigla_uf", "nome_uf", "nome_regiao"],
    "rais_microdados": ["ano", "sigla_uf", "cnae_2_subclasse", "cbo_2002", "vinculo_ativo_3112"],
    "sim_microdados": ["ano", "sigla_uf", "id_municipio_residencia", "ocupacao", "causa_basica", "acidente_trabalho", "sexo",
                       "idade", "linha_a", "linha_b", "linha_c", "linha_d", "linha_ii"],
}



def _first(columns) -> str:
    return ", ".join(f"{c} asc nulls first" for c in columns)


_LINES = "if(ano < 1998, null, {c})"

OPERATORS: dict[str, str] = {
    "rais_aggregate": "select * from rais_vinculos",
    "sim_aggregate": "select * from fact_sim",
    "cid_dictionary": "select * from dim_cid",
    "grau_risco_build": """
select k as cnae_classe, cast(trim(arg_min(gr, linha)) as integer) as grau_risco
from (select *, replace(replace(replace(codigo, '.', ''), '-', ''), '/', '')[1:5] as k from grau_risco_sheet)
where nivel = 'Subclasse' and gr is not null group by k""",
    "manifest_dedup": """
select url, catalogo, posicao, nome from catalogue
qualify row_number() over (partition by url order by catalogo, posicao) = 1""",
    "file_year_pruning": """
select url, formato, ano, formato in ('CSV', 'ZIP') and ano is not null and ano >= 1993 and ano <= 1997 as lido
from (
  select url, upper(split_part(url, '.', -1)) as formato,
    cast(case when lower(url) like '%.cat.______.%' then left(split_part(url, '.', -2), 4)
      when regexp_matches(base, '[0-9]{4}') then regexp_extract(base, '.*([0-9]{4})', 1)
      when base like '%copmp%' then '2021' end as integer) as ano
  from (select distinct url, split_part(url, '/', -1) as base from catalogue)
)""",
    "catalogue_selection": """
select * exclude (base) from (
  select url, catalogo, posicao, nome, formato,
    cast(case when lower(url) like '%.cat.______.%' then left(split_part(url, '.', -2), 4)
      when regexp_matches(base, '[0-9]{4}') then regexp_extract(base, '.*([0-9]{4})', 1)
      when base like '%copmp%' then '2021' end as integer) as ano, base
  from (select *, split_part(url, '/', -1) as base from catalogue
    qualify row_number() over (partition by url order by catalogo, posicao) = 1)
) where lower(formato) in ('csv', 'zip') and ano >= 1993 and ano <= 1997""",
    "quoted_records": "select path, chave, nota, tipo, 3 as celulas from typed_records",
    "windows_dictionary": """
select SUBCAT, chr(8220) || DESCRICAO || chr(8221) || ' ' || chr(8211) || ' ç' as DESCRICAO from dim_cid_subcat""",
    "csv_export": f"select * from ({MARTS['mart_risco_teorico_vs_observado']})",
    "table_replacement": """
select ano, count(*) as linhas, cast(sum(quantidade_vinculos) as bigint) as vinculos from rais_vinculos where ano >= 1994 group by ano""",
    "layout_detection": """
select distinct split_part(path, '/', 2) as _source_file, layout,
  cast(case layout when 'A' then 25 when 'B' then 24 else 24 end as integer) as n_header
from landed_notices""",
    "layout_unify": _UNIFIED,
    "quarantine_split": f"""
select _source_file, if(malformed or ifnull(cnae_empregador_cod, '') = '' or ifnull(data_acidente, '') = '',
  'quarentena', 'aceito') as destino, count(*) as linhas
from ({_UNIFIED}) group by all""",
    "source_profile": " union all ".join(
        f"select '{t}' as tabela, {i} as posicao, '{c}' as coluna, '{'inteiro' if c == 'ano' else 'decimal' if c == 'idade' else 'texto'}' as tipo, "
        f"count(*) as linhas, count({c}) as preenchidas, (select coalesce(string_agg(cast({c} as varchar), ' | ' order by {_first(cols)}), '') "
        f"from (select * from {t} order by {_first(cols)} limit 3)) as amostra, null as erro from {t}"
        for t, cols in _PROFILED.items() for i, c in enumerate(cols, start=1)
    )
    + " union all select 'tabela_quebrada', 0, null, null, null, null, null, 'UNRESOLVED_COLUMN.WITH_SUGGESTION'",
    "ledger_skip": """
select distinct 'cat_microdados' as table_name, source_file from stg_fact_cat
where source_file not in (select file_name from load_events where status = 'success')""",
    "ledger_states": """
select id, file_name, md5(file_name) as checksum, ifnull(max(status) filter (finished_at is not null), 'running') as status
from load_events group by id, file_name""",
    "ledger_outcomes": """
select id, file_name, coalesce(min(status) filter (status <> 'running'), 'stuck') as status from load_events group by id, file_name""",
    "year_replacement": f"""
select ano, count(*) as linhas, cast(sum(case when ano in (1995, 1997) then 2 else 1 end * total_obitos) as bigint) as obitos,
  {', '.join(f"count(case when ano in (1995, 1997) or ano >= 1998 then {c} end) as {c}" for c in ('linha_a', 'linha_b', 'linha_c', 'linha_d'))}, count(linha_ii) as linha_ii
from fact_sim group by ano""",
    "snapshot_replacement": f"""
select ano, count(*) as linhas, cast(sum(if(ano = 1995 or ano = 1997, 2 * total_obitos, total_obitos)) as bigint) as obitos,
  {', '.join(f"count(if(ano = 1996 or ano < 1995, null, {c})) as {c}" for c in ('linha_a', 'linha_b', 'linha_c', 'linha_d'))}, count(linha_ii) as linha_ii
from fact_sim group by ano""",
    "schema_evolution": f"""
select ano, count(*) as linhas, count({_LINES.format(c='linha_a')}) as linha_a, count({_LINES.format(c='linha_b')}) as linha_b,
  count({_LINES.format(c='linha_c')}) as linha_c, count({_LINES.format(c='linha_d')}) as linha_d, count(linha_ii) as linha_ii
from fact_sim group by ano""",
    "pending_years": """
select cast(y as integer) as ano from generate_series(1994, 2003) g(y)
where y < 1998 or not exists (from fact_sim f where f.ano = y and f.linha_a is not null)""",
    "load_summary": f"""
select count(*) as linhas, min(ano) as ano_min, max(ano) as ano_max, count({_LINES.format(c='linha_a')}) as com_linha_a,
  cast(count({_LINES.format(c='linha_a')}) * 100 // count(*) as bigint) as pct from fact_sim""",
    "dominant_max_row": "select cbo_codigo, cnae_classe, w as weight from home_row",
    "dominant_sum": "select cbo_codigo, cnae_classe, w as weight from home_sum",
    "attribution_join": """
select h.cnae_classe, s.ano, cast(sum(s.total_obitos) as bigint) as total_obitos
from stg_fact_sim s join home_row h using (cbo_codigo) group by all""",
    "mode_per_group": """
select t.cnae_cod_4, t.n as total, a.value as tipo_acidente_moda, a.n as tipo_acidente_n, b.value as natureza_lesao_moda,
  b.n as natureza_lesao_n, c.value as cid_10_moda, c.n as cid_10_n, d.value as sexo_moda, d.n as sexo_n
from (select cnae_cod_4, count(*) as n from stg_fact_cat group by 1) t
"""
    + "\n".join(
        f"left join (select cnae_cod_4, {col} as value, count(*) as n from stg_fact_cat where {col} is not null group by 1, 2 "
        f"qualify row_number() over (partition by cnae_cod_4 order by count(*) desc, {col}) = 1) {alias} on {alias}.cnae_cod_4 = t.cnae_cod_4"
        for alias, col in zip("abcd", ["tipo_acidente", "natureza_lesao", "cid_10", "sexo"])
    ),
    "distinct_on_first": """
select distinct on (cbo_codigo) cbo_codigo, ano, mes, cnae_cod_4 from stg_fact_cat
where cbo_codigo is not null and ano is not null order by cbo_codigo, ano, mes, cnae_cod_4""",
    "distinct_years": """
select cnae_classe, count(distinct ano) as anos_cobertos, min(ano) as ano_inicio, max(ano) as ano_fim
from stg_fact_rais group by cnae_classe""",
    "filtered_aggregates": """
select cnae_classe, ano, count(*) as linhas, count(*) filter (sigla_uf = 'SP') as linhas_sp,
  cast(ifnull(sum(quantidade_vinculos) filter (sigla_uf = 'SP'), 0) as bigint) as vinculos_sp,
  cast(sum(quantidade_vinculos) filter (sigla_uf = 'AC') as bigint) as vinculos_ac,
  max(quantidade_vinculos) filter (sigla_uf = 'RJ') as maior_rj
from stg_fact_rais group by all""",
    "nested_top_n": """
with cells as (
  select uf_empregador, cbo_codigo, cid_10, count(*) as acidentes from stg_fact_cat
  where cbo_codigo is not null and cid_10 is not null group by 1, 2, 3
), ranked as (
  select *, sum(acidentes) over (partition by uf_empregador, cbo_codigo) as tot,
    row_number() over (partition by uf_empregador, cbo_codigo order by acidentes desc, cid_10) as rank_cid
  from cells
)
select uf_empregador, cbo_codigo, cid_10, acidentes, rank_cid, cast(tot as bigint) as acidentes_cbo_codigo, rank_cbo
from (select *, dense_rank() over (partition by uf_empregador order by tot desc, cbo_codigo) as rank_cbo from ranked)
where rank_cbo <= 5 and rank_cid <= 3""",
    "global_rank": """
select cbo_codigo, count(*) as acidentes, rank() over (order by count(*) desc) as posicao from stg_fact_cat group by cbo_codigo""",
    "rate_per_mil": f"""
select c.cnae_cod_4, c.acidentes, b.vinculos, {per_mille('c.acidentes', 'b.vinculos', 2)} as taxa_2,
  {per_mille('c.acidentes', 'b.vinculos', 3)} as taxa_3
from (select cnae_cod_4, count(*) as acidentes from stg_fact_cat group by 1) c
left join (select substr(cnae_subclasse, 1, 4) as p4, cast(sum(quantidade_vinculos) as bigint) as vinculos
  from stg_fact_rais group by 1) b on b.p4 = c.cnae_cod_4""",
    "share_of_total": f"""
select *, {pct('vinculos', 'vinculos_classe', 1)} as pct_1, {pct('vinculos', 'vinculos_classe', 2)} as pct_2
from (
  select cnae_classe, sigla_uf, cast(sum(quantidade_vinculos) as bigint) as vinculos,
    cast(sum(sum(quantidade_vinculos)) over (partition by cnae_classe) as bigint) as vinculos_classe
  from stg_fact_rais group by cnae_classe, sigla_uf
)""",
    "year_intersection": """
select r.ano, cast(sum(r.quantidade_vinculos) as bigint) as vinculos, any_value(y0) as ano_inicio, any_value(y1) as ano_fim
from stg_fact_rais r, years where r.ano >= y0 and r.ano <= y1 group by r.ano""",
    "explode_lines": """
select fonte_linha, cid_raw, cast(sum(total_obitos) as bigint) as ocorrencias from sim_tokens group by all""",
    "cid_normalisers": """
with spelled as (
  select t as texto, count(*) as linhas from (select unnest([cid_10_causa, linha_a, linha_b, linha_c, linha_d, linha_ii]) as t from fact_sim)
  where t is not null group by t
), parts as (
  select *, trim(texto) as t, upper(trim(texto)) as u, ltrim(trim(texto), '*') as b from spelled
)
select texto, linhas,
  if(length(t) = 4, t[1:3] || '.' || t[4:], t) as causa_basica,
  case when length(b) = 4 and b[4:] = 'X' then b[1:3] when length(b) = 4 then b[1:3] || '.' || b[4:]
    when length(b) >= 3 and length(b) <= 6 then b end as linha,
  case when length(u) < 3 or u[1:1] in ('S', 'T', 'V', 'W', 'X', 'Y', 'Z') then null
    when length(u) <> 4 then u when u[4:] = 'X' then u[1:3] else u[1:3] || '.' || u[4:] end as comorbidade,
  if(length(t) < 4, t, t[1:3] || '.' || t[4:]) as dicionario,
  replace(if(length(t) < 4, t, t[1:3] || '.' || t[4:]), '.', '') as sem_ponto
from parts""",
    "age_and_bands": """
select y as idade, count(*) as avisos,
  case when y < 0 then null when y < 18 then '0-17' when y < 25 then '18-24' when y < 35 then '25-34' when y < 45 then '35-44'
    when y < 55 then '45-54' when y < 65 then '55-64' when y >= 65 then '65+' end as faixa_etaria
from (select cast(extract(year from age(try_strptime(data_acidente, '%d/%m/%Y'), try_strptime(data_nascimento, '%d/%m/%Y')))
  as integer) as y from cat_microdados) group by y""",
    "age_bands_closed": """
select idade, cast(sum(total_obitos) as bigint) as obitos,
  case when idade between 0 and 17 then '0-17' when idade between 18 and 24 then '18-24' when idade between 25 and 34 then '25-34'
    when idade between 35 and 44 then '35-44' when idade between 45 and 54 then '45-54' when idade between 55 and 64 then '55-64'
    when idade between 65 and 130 then '65+' end as faixa_etaria
from fact_sim group by idade""",
    "death_category": """
select cid_10_causa, acidente_trabalho, categoria_morte, cast(sum(total_obitos) as bigint) as obitos from death_kinds group by all""",
    "anti_join_null_aware": """
select cbo_codigo, count(*) as avisos from stg_fact_cat
where cbo_codigo not in (select cbo_codigo from stg_dim_cbo) group by cbo_codigo""",
    "prefix_audit": " union all ".join(
        f"select substr(cnae_classe, 1, {n}) as prefixo, count(distinct cnae_classe) as codigos, {n} as tamanho "
        "from stg_dim_cnae group by 1 having count(distinct cnae_classe) > 1"
        for n in (2, 3, 4)
    ),
    "match_rate": " union all ".join([
        _rate_row("cid_10", "stg_fact_cat", "stg_dim_cid", "cid_codigo"),
        _rate_row("cbo_codigo", "stg_fact_cat", "stg_dim_cbo", "cbo_codigo"),
        _rate_row("municipio_id_6", "stg_fact_cat", "stg_dim_municipio", "municipio_id_6"),
    ]),
    "match_rate_dotless": "select * exclude (coluna) from ("
    + _rate_row("cid", "fact_sim", "(select replace(cid_codigo, '.', '') as k from stg_dim_cid)", "k", "replace(trim(cid_10_causa), '.', '')")
    + ")",
    "null_profile": "with m as ("
    + MARTS["mart_cat_cnae_cbo_mes"]
    + ") "
    + " union all ".join(
        f"select '{c}' as coluna, count(*) as linhas, count(*) - count({c}) as nulos, "
        f"{pct(f'(count(*) - count({c}))', 'count(*)', 1)} as pct_nulos from m"
        for c in ["cnae_classe", "cnae_descricao", "cbo_codigo", "cbo_descricao", "cid_10", "cid_descricao"]
    ),
    "dq_not_null": _dq("not_null"),
    "dq_unique": _dq("unique"),
    "dq_accepted": _dq("accepted"),
    "dq_relationships": _dq("relationships"),
    "dq_summary": f"""
select count(*) filter (status = 'PASS') as pass, count(*) filter (status = 'WARN') as warn,
  count(*) filter (status = 'ERROR') as error from ({_dq('not_null', 'unique', 'accepted', 'relationships')})""",
    "report_top_classes": f"({MARTS['mart_risco_teorico_vs_observado']}) order by total_acidentes desc, cnae_classe limit 25",
    "report_top_combinations": f"""
select cnae_classe, cnae_descricao, cbo_codigo, cbo_descricao, cid_descricao,
  cast(sum(total_acidentes) as bigint) as acidentes, cast(sum(total_obitos) as bigint) as obitos
from ({MARTS['mart_cat_cnae_cbo_mes']}) group by all
order by acidentes desc, cnae_classe nulls last, cnae_descricao nulls last, cbo_codigo nulls last, cbo_descricao nulls last,
  cid_descricao nulls last limit 25""",
    "report_injuries_of_division": """
select n.natureza_lesao, n.parte_corpo, count(*) as acidentes, count(*) filter (n.obito) as obitos
from stg_fact_cat n join graded g on g.p4 = n.cnae_cod_4 where starts_with(g.cnae_classe, '41')
group by 1, 2 order by 3 desc, 1 nulls last, 2 nulls last limit 20""",
    "report_accidental_deaths": f"""
select cnae_classe, categoria_morte, cast(sum(total_obitos) as bigint) as obitos from ({MARTS['mart_risco_morte']})
where starts_with(categoria_morte, 'Acidental') group by all""",
    "report_serious_diseases": f"""
select cid_normalizado, cid_descricao, cast(sum(total_obitos_com_condicao) as bigint) as obitos
from ({MARTS['mart_risco_doenca']}) where fonte_linha = 'ii' and regexp_matches(cid_normalizado, '^[CINJF]') group by all""",
    "report_family_history": f"""
select cid_normalizado, cid_descricao, cast(sum(total_obitos_com_condicao) as bigint) as obitos
from ({MARTS['mart_risco_doenca']}) where fonte_linha = 'ii' and cid_normalizado like 'Z%' and cid_normalizado >= 'Z80' group by all""",
}
