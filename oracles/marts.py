"""Marts as DuckDB statements over the staging CTEs."""

from __future__ import annotations

from oracles.shared import pct, per_mille

_BAND = "(case when rate < 3000 then 1 when rate < 6000 then 2 when rate < 10000 then 3 when rate < 15000 then 4 when rate >= 15000 then 5 end)"

MARTS: dict[str, str] = {
    "mart_cat_cnae_cbo_mes": """
select n.ano, n.mes, n.uf_empregador, n.cnae_cod_4, k.cnae_classe, k.cnae_descricao_classe as cnae_descricao,
  k.cnae_descricao_secao as cnae_secao, n.cbo_codigo, o.cbo_descricao, o.cbo_grande_grupo_codigo,
  o.cbo_grande_grupo_descricao, n.tipo_acidente, n.cid_10, d.cid_descricao,
  count(*) as total_acidentes, count(*) filter (n.obito) as total_obitos
from stg_fact_cat n
left join klass k on k.p4 = n.cnae_cod_4
left join stg_dim_cbo o using (cbo_codigo)
left join stg_dim_cid d on d.cid_codigo = n.cid_10
group by all""",
    "mart_risco_teorico_vs_observado": f"""
select *, 1 + (select count(*) from per_class q where q.total_acidentes > per_class.total_acidentes) as rank_por_acidentes
from per_class""",
    "mart_top_cbo_por_cnae": f"""
select g.grau_risco, g.grau_risco_descricao, r.cnae_classe, k.cnae_descricao_classe as cnae_descricao, k.cnae_secao,
  k.cnae_descricao_secao, r.pos as rank_cbo, r.cbo_codigo, o.cbo_descricao, o.cbo_grande_grupo_codigo,
  o.cbo_grande_grupo_descricao, r.v as total_vinculos, b.v as total_vinculos_cnae,
  {pct('r.v', 'b.v', 2)} as pct_vinculos_na_classe, r.a0 as ano_inicio, r.a1 as ano_fim
from (
  select cnae_classe, cbo_codigo, cast(sum(quantidade_vinculos) as bigint) as v, min(ano) as a0, max(ano) as a1,
    row_number() over (partition by cnae_classe order by sum(quantidade_vinculos) desc, cbo_codigo) as pos
  from stg_fact_rais group by cnae_classe, cbo_codigo
) r
join stg_dim_grau_risco g on g.cnae_classe = r.cnae_classe
join bonds_class b on b.cnae_classe = r.cnae_classe
left join klass k on k.cnae_classe = r.cnae_classe
left join stg_dim_cbo o on o.cbo_codigo = r.cbo_codigo
where r.pos <= 10""",
    "mart_perfil_risco_cnae": f"""
select g.grau_risco, g.grau_risco_descricao, g.cnae_classe, g.cnae_descricao_classe as cnae_descricao, g.cnae_secao,
  g.cnae_descricao_secao, h.pos as rank_cbo, h.cbo_codigo, o.cbo_descricao, o.cbo_grande_grupo_codigo,
  o.cbo_grande_grupo_descricao, coalesce(b.v, 0) as vinculos_cbo, h.n as acidentes_cbo, h.dead as obitos_cbo,
  {per_mille('h.n', 'b.v', 2)} as taxa_acidentes_por_mil, h.m as acidentes_cbo_m, h.f as acidentes_cbo_f,
  {pct('h.m', 'h.n', 1)} as pct_masculino_cbo, l.pos as rank_cid, l.cid_10, d.cid_descricao, l.n as acidentes_cid,
  l.dead as obitos_cid, {pct('l.n', 'h.n', 1)} as pct_acidentes_no_cbo, l.m as acidentes_cid_m, l.f as acidentes_cid_f
from (
  select cnae_cod_4, cbo_codigo, count(cid_10) as n, count(*) filter (obito and cid_10 is not null) as dead,
    count(*) filter (sexo = 'M') as m, count(*) filter (sexo = 'F') as f,
    row_number() over (partition by cnae_cod_4 order by count(cid_10) desc, cbo_codigo) as pos
  from stg_fact_cat where cbo_codigo is not null group by cnae_cod_4, cbo_codigo
) h
join (
  select cnae_cod_4, cbo_codigo, cid_10, count(*) as n, count(*) filter (obito) as dead,
    count(*) filter (sexo = 'M') as m, count(*) filter (sexo = 'F') as f,
    row_number() over (partition by cnae_cod_4, cbo_codigo order by count(*) desc, cid_10) as pos
  from stg_fact_cat where cbo_codigo is not null and cid_10 is not null group by cnae_cod_4, cbo_codigo, cid_10
) l on l.cnae_cod_4 = h.cnae_cod_4 and l.cbo_codigo = h.cbo_codigo and l.pos <= 5
join graded g on g.p4 = h.cnae_cod_4
left join stg_dim_cbo o on o.cbo_codigo = h.cbo_codigo
left join stg_dim_cid d on d.cid_codigo = l.cid_10
left join (select cnae_classe, cbo_codigo, cast(sum(quantidade_vinculos) as bigint) as v from stg_fact_rais group by all) b
  on b.cnae_classe = g.cnae_classe and b.cbo_codigo = h.cbo_codigo
where h.pos <= 10""",
    "mart_severidade_cat_cnae": f"""
select g.grau_risco, g.grau_risco_descricao, g.cnae_classe, g.cnae_descricao_classe as cnae_descricao, g.cnae_secao,
  g.cnae_descricao_secao, t.n as total_acidentes, t.dead as total_obitos, {pct('t.dead', 't.n', 2)} as taxa_obito_pct,
  t.m as acidentes_m, t.f as acidentes_f, {pct('t.m', 't.n', 1)} as pct_masculino,
  t1.value as top_natureza_lesao, {pct('t1.n', 't.n', 1)} as pct_top_natureza,
  t2.value as top_parte_corpo, {pct('t2.n', 't.n', 1)} as pct_top_parte,
  t3.value as top_agente_causador, {pct('t3.n', 't.n', 1)} as pct_top_agente,
  t4.value as faixa_etaria_dominante, {pct('t4.n', 't.n', 1)} as pct_faixa_dominante
from (
  select cnae_cod_4, count(*) as n, count(*) filter (obito) as dead, nullif(count(*) filter (sexo = 'M'), 0) as m,
    nullif(count(*) filter (sexo = 'F'), 0) as f
  from stg_fact_cat group by cnae_cod_4
) t
join graded g on g.p4 = t.cnae_cod_4
left join trait_mode t1 on t1.cnae_cod_4 = t.cnae_cod_4 and t1.trait = 'natureza_lesao'
left join trait_mode t2 on t2.cnae_cod_4 = t.cnae_cod_4 and t2.trait = 'parte_corpo'
left join trait_mode t3 on t3.cnae_cod_4 = t.cnae_cod_4 and t3.trait = 'agente_causador'
left join trait_mode t4 on t4.cnae_cod_4 = t.cnae_cod_4 and t4.trait = 'faixa_etaria'""",
    "mart_mortalidade_por_cnae": f"""
select g.grau_risco, g.grau_risco_descricao, g.cnae_classe, g.cnae_descricao_classe as cnae_descricao, g.cnae_secao,
  g.cnae_descricao_secao, s.sexo, s.faixa_etaria, s.n as total_obitos, s.w as obitos_acidente_trabalho,
  {pct('s.w', 's.n', 1)} as pct_acidente_trabalho, coalesce(b.v, 0) as vinculos_cnae,
  {per_mille('s.n', 'b.v', 3)} as taxa_obitos_por_mil_vinculos
from (
  select cbo_codigo, ifnull(sexo, 'Não informado') as sexo, ifnull(faixa_etaria, 'Não informada') as faixa_etaria,
    cast(sum(total_obitos) as bigint) as n, cast(sum(if(acidente_trabalho = 'Sim', total_obitos, 0)) as bigint) as w
  from stg_fact_sim group by all
) s
join home_sum h on h.cbo_codigo = s.cbo_codigo
join graded g on g.cnae_classe = h.cnae_classe
left join bonds_class b on b.cnae_classe = h.cnae_classe""",
    "mart_comorbidades_por_cnae": f"""
select g.grau_risco, g.grau_risco_descricao, g.cnae_classe, g.cnae_descricao_classe as cnae_descricao, g.cnae_secao,
  g.cnae_descricao_secao, c.pos as rank_comorbidade, c.code as cid_comorbidade, d1.cid_descricao as comorbidade_descricao,
  substr(c.code, 1, 3) as cid_categoria, d2.cid_descricao as categoria_descricao, ifnull(l.v, 'Outro') as capitulo_cid,
  c.n as total_obitos_com_comorbidade, b.n as total_obitos_com_linhaii, {pct('c.n', 'b.n', 2)} as pct_obitos_com_comorbidade
from (
  select h.cnae_classe, regexp_replace(regexp_replace(t.tok, '^(...)X$', '\\1'), '^(...)(.)$', '\\1.\\2') as code,
    cast(sum(t.total_obitos) as bigint) as n,
    row_number() over (partition by h.cnae_classe order by n desc, code) as pos
  from (
    select cbo_codigo, total_obitos, upper(trim(unnest(string_split(linha_ii_raw, '*')))) as tok
    from stg_fact_sim where linha_ii_raw is not null
  ) t join home_row h using (cbo_codigo)
  where length(t.tok) > 2 and t.tok[1:1] not in ('S', 'T', 'V', 'W', 'X', 'Y', 'Z')
  group by 1, 2
) c
join graded g on g.cnae_classe = c.cnae_classe
left join (select h.cnae_classe, cast(sum(s.total_obitos) as bigint) as n from stg_fact_sim s join home_row h using (cbo_codigo)
  where s.linha_ii_raw is not null group by 1) b on b.cnae_classe = c.cnae_classe
left join lbl_comorbidity l on l.k = c.code[1:1]
left join stg_dim_cid d1 on d1.cid_codigo = c.code
left join stg_dim_cid d2 on d2.cid_codigo = substr(c.code, 1, 3)""",
    "mart_causas_externas_por_cnae": f"""
select g.grau_risco, g.grau_risco_descricao, x.cnae_classe, k.cnae_descricao_classe, k.cnae_secao, k.cnae_descricao_secao,
  row_number() over (partition by x.cnae_classe order by x.n desc, x.code) as rank_causa, x.code[1:1] as capitulo,
  l.v as tipo_causa_externa, x.code as cid_causa, d1.cid_descricao as causa_descricao, substr(x.code, 1, 3) as cid_categoria,
  d2.cid_descricao as categoria_descricao, x.n as total_obitos, x.w as total_obitos_trabalho,
  cast(sum(x.n) over (partition by x.cnae_classe) as bigint) as total_obitos_causa_ext_cnae,
  {pct('x.n', '(sum(x.n) over (partition by x.cnae_classe))', 2)} as pct_causa_no_cnae,
  {pct('x.w', 'x.n', 2)} as pct_trabalho_na_causa
from (
  select h.cnae_classe, s.cid_10_causa as code, cast(sum(s.total_obitos) as bigint) as n,
    cast(sum(if(s.acidente_trabalho = 'Sim', s.total_obitos, 0)) as bigint) as w
  from stg_fact_sim s join home_row h using (cbo_codigo)
  where s.cid_10_causa similar to '[STVWXY].*'
  group by 1, 2
) x
join stg_dim_grau_risco g on g.cnae_classe = x.cnae_classe
left join klass k on k.cnae_classe = x.cnae_classe
left join lbl_external l on l.k = x.code[1:1]
left join stg_dim_cid d1 on d1.cid_codigo = x.code
left join stg_dim_cid d2 on d2.cid_codigo = substr(x.code, 1, 3)""",
    "mart_risco_morte": """
select g.grau_risco, g.grau_risco_descricao, k.cnae_classe, k.cnae_descricao_classe, k.cnae_secao, k.cnae_descricao_secao,
  s.cbo_codigo, o.cbo_descricao, o.cbo_grande_grupo_codigo, s.categoria_morte, s.faixa_etaria, s.sexo, s.cid_10_causa,
  d.cid_descricao as causa_descricao, cast(sum(s.total_obitos) as bigint) as total_obitos
from death_kinds s
join home_row h using (cbo_codigo)
join stg_dim_grau_risco g on g.cnae_classe = h.cnae_classe
left join klass k on k.cnae_classe = h.cnae_classe
left join stg_dim_cbo o on o.cbo_codigo = s.cbo_codigo
left join stg_dim_cid d on d.cid_codigo = s.cid_10_causa
where s.cid_10_causa is not null
group by all""",
    "mart_risco_acidente": f"""
select g.grau_risco, g.grau_risco_descricao, g.cnae_classe, g.cnae_descricao_classe, g.cnae_secao, g.cnae_descricao_secao,
  n.cbo_codigo, o.cbo_descricao, o.cbo_grande_grupo_codigo, n.tipo_acidente, n.natureza_lesao, n.parte_corpo,
  n.agente_causador, n.cid_10, d.cid_descricao, n.sexo, n.faixa_etaria, count(*) as total_acidentes,
  count(*) filter (n.obito) as total_obitos_acidente,
  {pct('(count(*) filter (n.obito))', 'count(*)', 2)} as pct_obito_no_acidente
from stg_fact_cat n
join graded g on g.p4 = n.cnae_cod_4
left join stg_dim_cbo o on o.cbo_codigo = n.cbo_codigo
left join stg_dim_cid d on d.cid_codigo = n.cid_10
group by all""",
    "mart_risco_doenca": f"""
select g.grau_risco, g.grau_risco_descricao, h.cnae_classe, k.cnae_descricao_classe, k.cnae_secao, k.cnae_descricao_secao,
  a.cbo_codigo, o.cbo_descricao, o.cbo_grande_grupo_codigo, a.fonte_linha, ll.v as fonte_linha_descricao,
  a.cid_normalizado, a.cid_categoria, d1.cid_descricao, d2.cid_descricao as categoria_descricao, a.capitulo_cid,
  a.tipo_condicao, a.n as total_obitos_com_condicao, a.base as total_obitos_na_fonte, {pct('a.n', 'a.base', 2)} as pct_na_fonte,
  a.pos as rank_na_fonte
from (
  select cbo_codigo, fonte_linha, cid_normalizado, cid_categoria, capitulo_cid, tipo_condicao,
    cast(sum(total_obitos) as bigint) as n,
    cast(sum(sum(total_obitos)) over (partition by cbo_codigo, fonte_linha) as bigint) as base,
    row_number() over (partition by cbo_codigo, fonte_linha order by sum(total_obitos) desc, cid_normalizado) as pos
  from stg_sim_linhas
  group by cbo_codigo, fonte_linha, cid_normalizado, cid_categoria, capitulo_cid, tipo_condicao
) a
join home_row h on h.cbo_codigo = a.cbo_codigo
join stg_dim_grau_risco g on g.cnae_classe = h.cnae_classe
left join klass k on k.cnae_classe = h.cnae_classe
left join stg_dim_cbo o on o.cbo_codigo = a.cbo_codigo
left join lbl_line ll on ll.k = a.fonte_linha
left join stg_dim_cid d1 on d1.cid_codigo = a.cid_normalizado
left join stg_dim_cid d2 on d2.cid_codigo = a.cid_categoria""",
    "mart_score_risco_cnae": f"""
select * exclude (rate, fat, band, worse), rate / 1e6 as taxa_acidente, fat / 1e6 as taxa_obito, band as score_base,
  worse as agravante_obito, case when band + worse > 5 then 5 else band + worse end as score_risco
from (select *, {_BAND} as band, if(fat > 10000, 1, 0) as worse from scores)""",
    "mart_cnae_sem_score": """
select k.cnae_classe, k.cnae_descricao_classe, ifnull(c.n, 0) as total_cat, ifnull(c.work, 0) as acidentes_trabalho,
  ifnull(c.commute, 0) as acidentes_trajeto, ifnull(b.v, 0) as total_vinculos,
  'Sem acidentes típicos/doença registrados' as motivo_exclusao
from klass k
left join (select cnae_cod_4, count(*) as n, count(*) filter (tipo_acidente in ('doença', 'típico')) as work,
  count(*) filter (tipo_acidente = 'trajeto') as commute from stg_fact_cat group by 1) c on c.cnae_cod_4 = k.p4
left join bonds_class b on b.cnae_classe = k.cnae_classe
where not exists (from scores s where substr(s.cnae_classe, 1, 4) = k.p4)""",
}
