"""Staging views as CTE bodies, in dependency order."""

from __future__ import annotations


def _trimmed(names: dict[str, str]) -> str:
    return ", ".join(f"trim({src}) as {dst}" for src, dst in names.items())


_CNAE = {}
for _level in ("subclasse", "classe", "grupo", "divisao", "secao"):
    _CNAE[_level] = f"cnae_{_level}"
    _CNAE[f"descricao_{_level}"] = f"cnae_descricao_{_level}"


def no_mark(col: str) -> str:
    """Trimmed value, NULL when it opens with a curly bracket."""
    return f"case when trim({col}) not like '{{%' then trim({col}) end"


_AGE_CAT = """case when y is null or y < 0 then null when y <= 17 then '0-17' when y <= 24 then '18-24'
  when y <= 34 then '25-34' when y <= 44 then '35-44' when y <= 54 then '45-54' when y <= 64 then '55-64' else '65+' end"""

STAGING: dict[str, str] = {
    "stg_dim_cnae": f"select {_trimmed(_CNAE)} from dim_cnae where subclasse is not null",
    "stg_dim_cbo": """
select trim(cbo_2002) as cbo_codigo, trim(descricao) as cbo_descricao, trim(grande_grupo) as cbo_grande_grupo_codigo,
  trim(descricao_grande_grupo) as cbo_grande_grupo_descricao, substr(trim(cbo_2002), 1, 4) as cbo_subgrupo_codigo,
  indicador_cbo_2002_ativa as cbo_ativa
from dim_cbo where cbo_2002 is not null""",
    "stg_dim_municipio": """
select trim(id_municipio) as municipio_id, trim(id_municipio_6) as municipio_id_6, trim(nome) as municipio_nome,
  trim(upper(sigla_uf)) as sigla_uf, trim(nome_uf) as uf_nome, trim(nome_regiao) as regiao_nome
from dim_municipio where id_municipio is not null""",
    "stg_dim_grau_risco": """
select trim(g.cnae_classe) as cnae_classe, g.grau_risco, l.v as grau_risco_descricao
from dim_grau_risco g left join lbl_grade l on l.k = g.grau_risco
where g.cnae_classe is not null and g.grau_risco is not null""",
    "stg_dim_cid": "select cid_codigo, cid_descricao from dim_cid where cid_codigo is not null and cid_descricao is not null",
    "stg_fact_rais": """
select cast(ano as integer) as ano, trim(upper(sigla_uf)) as sigla_uf, sub as cnae_subclasse,
  substr(sub, 1, 5) as cnae_classe, trim(cbo_2002) as cbo_codigo, quantidade_vinculos
from (select *, trim(cnae_2_subclasse) as sub from rais_vinculos)
where sub is not null and cbo_2002 is not null and sigla_uf is not null""",
    "stg_fact_cat": f"""
select
  case when well_formed then cast(substr(data_competencia, 1, 4) as integer) end as ano,
  case when well_formed then cast(substr(data_competencia, 6, 2) as integer) end as mes,
  nullif(substr({no_mark('cbo')}, 1, 6), '000000') as cbo_codigo,
  cod as cnae_cod_4,
  substr(trim(munic_empregador), 1, 6) as municipio_id_6,
  case when kind like '%pico%' then 'típico' when kind like '%trajeto%' then 'trajeto'
    when kind like '%doen%' then 'doença' when kind like '%ignora%' then 'ignorado' else kind end as tipo_acidente,
  {no_mark('cid_10')} as cid_10,
  upper(indica_obito) = 'SIM' as obito,
  trim(uf_empregador) as uf_empregador,
  trim(_source_file) as source_file,
  if(sexo = 'Masculino', 'M', if(sexo = 'Feminino', 'F', null)) as sexo,
  {no_mark('natureza_lesao')} as natureza_lesao,
  {no_mark('parte_corpo')} as parte_corpo,
  {no_mark('agente_causador')} as agente_causador,
  {_AGE_CAT} as faixa_etaria
from (
  select *, lower(trim(tipo_acidente)) as kind, lpad(trim(cnae_empregador_cod), 4, '0') as cod,
    regexp_full_match(data_competencia, '[0-9][0-9][0-9][0-9]/[0-9][0-9]') as well_formed,
    cast(extract(year from age(try_strptime(data_acidente, '%d/%m/%Y'), try_strptime(data_nascimento, '%d/%m/%Y'))) as integer) as y
  from cat_microdados
)
where cod <> '0000' and data_competencia is not null""",
    "stg_fact_sim": """
select cast(ano as integer) as ano, trim(upper(sigla_uf)) as sigla_uf, trim(id_municipio) as municipio_id,
  trim(cbo_2002) as cbo_codigo,
  regexp_replace(trim(cid_10_causa), '^(...)(.)$', '\\1.\\2') as cid_10_causa,
  if(acidente_trabalho like '1%', 'Sim', if(acidente_trabalho like '2%', 'Não', if(acidente_trabalho like '9%', 'Ignorado', null)))
    as acidente_trabalho,
  cast(total_obitos as bigint) as total_obitos,
  if(trim(sexo) = '1', 'M', if(trim(sexo) = '2', 'F', null)) as sexo,
  (select b.band from (values ('0-17', 0, 17), ('18-24', 18, 24), ('25-34', 25, 34), ('35-44', 35, 44),
     ('45-54', 45, 54), ('55-64', 55, 64), ('65+', 65, 130)) b(band, lo, hi) where idade >= b.lo and idade <= b.hi)
    as faixa_etaria,
  nullif(trim(linha_a), '') as linha_a_raw, nullif(trim(linha_b), '') as linha_b_raw,
  nullif(trim(linha_c), '') as linha_c_raw, nullif(trim(linha_d), '') as linha_d_raw,
  nullif(trim(linha_ii), '') as linha_ii_raw
from fact_sim where cbo_2002 is not null and sigla_uf is not null""",
    "sim_tokens": """
select ano, sigla_uf, municipio_id, cbo_codigo, cid_10_causa as causa_basica, acidente_trabalho, total_obitos, sexo,
  faixa_etaria, fonte_linha, trim(piece) as cid_raw, ltrim(trim(piece), '*') as bare
from (
  unpivot (
    select *, [linha_a_raw] as a, [linha_b_raw] as b, [linha_c_raw] as c, [linha_d_raw] as d,
      string_split(linha_ii_raw, '*') as ii from stg_fact_sim
  ) on a, b, c, d, ii into name fonte_linha value pieces
), unnest(pieces) as u(piece)
where trim(piece) <> ''""",
    "stg_sim_linhas": """
select t.* exclude (bare, norm), norm as cid_normalizado, substr(norm, 1, 3) as cid_categoria,
  coalesce(ch.v, 'Não classificado') as capitulo_cid, coalesce(co.v, 'Não classificado') as tipo_condicao
from (
  select *, case length(bare)
    when 4 then if(bare like '%X', bare[1:3], bare[1:3] || '.' || bare[4:4])
    when 3 then bare when 5 then bare when 6 then bare end as norm
  from sim_tokens
) t
left join lbl_chapter ch on ch.k = norm[1:1]
left join lbl_condition co on co.k = norm[1:1]
where norm is not null""",
}
