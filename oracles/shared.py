"""CTE bodies shared by several marts and operators."""

from __future__ import annotations


def half_up(num: str, den: str, factor: int, digits: int = 0) -> str:
    """Quotient times ``factor``, rounded half up to ``digits``, exact in integers."""
    m = 2 * factor * 10**digits
    return f"(case when ({den}) > 0 then cast((cast({num} as hugeint) * {m} + ({den})) // (2 * cast({den} as hugeint)) as double) / {10**digits}.0 end)"


def pct(num: str, den: str, digits: int) -> str:
    return half_up(num, den, 100, digits)


def per_mille(num: str, den: str, digits: int) -> str:
    return half_up(num, den, 1000, digits)


SHARED: dict[str, str] = {
    "klass": "select distinct cnae_classe, cnae_descricao_classe, cnae_secao, cnae_descricao_secao, substr(cnae_classe, 1, 4) as p4 from stg_dim_cnae",
    "graded": "select k.*, g.grau_risco, g.grau_risco_descricao from klass k join stg_dim_grau_risco g on g.cnae_classe = k.cnae_classe",
    "bonds_class": "select cnae_classe, cast(sum(quantidade_vinculos) as bigint) as v from stg_fact_rais group by cnae_classe",
    "home_row": """
select cbo_codigo, cnae_classe, quantidade_vinculos as w from stg_fact_rais
qualify row_number() over (partition by cbo_codigo order by quantidade_vinculos desc, cnae_classe) = 1""",
    "home_sum": """
select cbo_codigo, cnae_classe, cast(sum(quantidade_vinculos) as bigint) as w from stg_fact_rais group by cbo_codigo, cnae_classe
qualify row_number() over (partition by cbo_codigo order by w desc, cnae_classe) = 1""",
    "years": """
select greatest(c.lo, r.lo) as y0, least(c.hi, r.hi) as y1
from (select min(ano) lo, max(ano) hi from stg_fact_cat) c, (select min(ano) lo, max(ano) hi from stg_fact_rais) r""",
    "scores": f"""
select k.cnae_classe, k.cnae_descricao_classe, y0 as ano_inicio, y1 as ano_fim, c.work as acidentes_trabalho,
  c.commute as acidentes_trajeto, c.dead as obitos, c.work_dead as obitos_trabalho, e.v as total_vinculos,
  {half_up('c.work', 'e.v', 1000000)} as rate, {half_up('c.work_dead', 'c.work', 1000000)} as fat
from (
  select cnae_cod_4,
    sum(if(tipo_acidente = 'típico' or tipo_acidente = 'doença', 1, 0))::bigint as work,
    sum(if(tipo_acidente = 'trajeto', 1, 0))::bigint as commute,
    sum(if(obito, 1, 0))::bigint as dead,
    sum(if(obito and (tipo_acidente = 'típico' or tipo_acidente = 'doença'), 1, 0))::bigint as work_dead
  from stg_fact_cat where ano >= (select y0 from years) and ano <= (select y1 from years)
  group by cnae_cod_4
) c
cross join years
join (select p4, min(cnae_classe) as cnae_classe, arg_min(cnae_descricao_classe, cnae_classe) as cnae_descricao_classe
      from klass group by p4) k on k.p4 = c.cnae_cod_4
left join (select substr(cnae_classe, 1, 4) as p4, cast(sum(quantidade_vinculos) as bigint) as v
  from stg_fact_rais where ano >= (select y0 from years) and ano <= (select y1 from years) group by 1) e on e.p4 = c.cnae_cod_4
where c.work > 0""",
    "per_class": f"""
select g.cnae_classe, k.cnae_descricao_classe as cnae_descricao, k.cnae_descricao_secao as cnae_secao, g.grau_risco,
  g.grau_risco_descricao, ifnull(b.v, 0) as total_vinculos, ifnull(c.n, 0) as total_acidentes, ifnull(c.dead, 0) as total_obitos,
  {per_mille('c.n', 'b.v', 2)} as taxa_acidentes_por_mil
from stg_dim_grau_risco g
left join klass k on k.p4 = substr(g.cnae_classe, 1, 4)
left join bonds_class b on b.cnae_classe = g.cnae_classe
left join (select cnae_cod_4, count(*) as n, count(*) filter (obito) as dead from stg_fact_cat group by 1) c
  on c.cnae_cod_4 = substr(g.cnae_classe, 1, 4)""",
    "trait_mode": """
select cnae_cod_4, trait, value, count(*) as n
from (unpivot (select cnae_cod_4, natureza_lesao, parte_corpo, agente_causador, faixa_etaria from stg_fact_cat)
  on natureza_lesao, parte_corpo, agente_causador, faixa_etaria into name trait value value)
group by cnae_cod_4, trait, value
qualify row_number() over (partition by cnae_cod_4, trait order by n desc, value) = 1""",
    "death_kinds": """
select s.*, case
    when l in ('V', 'W', 'X', 'Y') and s.acidente_trabalho = 'Sim' then 'Acidental – Trabalho'
    when l = 'V' then 'Acidental – Trânsito'
    when l = 'W' then 'Acidental – Queda / Afogamento'
    when s.cid_10_causa >= 'X60' and s.cid_10_causa <= 'X84.9' then 'Suicídio'
    when s.cid_10_causa >= 'X85' and s.cid_10_causa <= 'Y09.9' then 'Homicídio / Agressão'
    when s.cid_10_causa >= 'Y10' and s.cid_10_causa <= 'Y34.9' then 'Causa externa – Intenção indeterminada'
    when s.cid_10_causa >= 'Y83' and s.cid_10_causa <= 'Y84.9' then 'Complicação de procedimento médico'
    else ifnull(t.v, 'Não classificado') end as categoria_morte
from (select *, substr(cid_10_causa, 1, 1) as l from stg_fact_sim) s left join lbl_death t on t.k = s.l""",
}
