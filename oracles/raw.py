"""Raw tables and label tables as CTE bodies."""

from __future__ import annotations

from occrisk.functions import labels as L
from occrisk.sources import adapter as A


def _projection(table: str, where: str | None, distinct: bool, columns: dict[str, str]) -> str:
    items = ", ".join(f"{expr} as {name}" for name, expr in columns.items())
    return f"select {'distinct ' if distinct else ''}{items} from {table}" + (f" where {where}" if where else "")


def _values(table: dict) -> str:
    def lit(x) -> str:
        return str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"

    rows = ", ".join(f"({lit(k)}, {lit(v)})" for k, v in table.items())
    return f"select k, v from (values {rows}) t(k, v)"


def _occupations() -> str:
    table, key, where, code, columns = A.OCCUPATION
    one = f"(select min({key}) as {key} from {table} where {where} group by {code})"
    return _projection(one, None, False, columns)


RAW: dict[str, str] = {name: _projection(*spec) for name, spec in A.PROJECTIONS.items()}
RAW["dim_cbo"] = _occupations()
RAW["rais_vinculos"] = f"""
select ano, sigla_uf, cnae_2_subclasse, cbo_2002, cast(sum({A.BONDS_PER_LINE}) as bigint) as quantidade_vinculos
from rais_microdados
where ano >= {A.FIRST_YEAR} and ano <= {A.LAST_YEAR} and vinculo_ativo_3112 = '1' and cnae_2_subclasse is not null and cbo_2002 is not null
group by all"""
RAW["fact_sim"] = f"""
select ano, sigla_uf, id_municipio_residencia as id_municipio, ocupacao as cbo_2002, causa_basica as cid_10_causa,
  acidente_trabalho, sexo, idade, linha_a, linha_b, linha_c, linha_d, linha_ii, count(*) as total_obitos
from sim_microdados where sigla_uf = 'SP' and ano >= {A.FIRST_YEAR} and ano <= {A.LAST_YEAR} and ocupacao is not null
group by all"""
RAW["dim_cid"] = """
select distinct on (code) code as cid_codigo, label as cid_descricao
from (
  select case when length(trim(SUBCAT)) > 3 then substr(trim(SUBCAT), 1, 3) || '.' || substr(trim(SUBCAT), 4)
    else trim(SUBCAT) end as code, trim(DESCRICAO) as label, 1 as pref
  from dim_cid_subcat where SUBCAT <> '' and DESCRICAO <> ''
  union all
  select trim(CAT), trim(DESCRICAO), 2 from dim_cid_cat where CAT <> '' and DESCRICAO <> ''
)
order by code, pref, label"""
RAW |= {
    "lbl_grade": _values(L.RISK_GRADE_LABEL),
    "lbl_chapter": _values(L.CHAPTER_LABEL),
    "lbl_condition": _values(L.CONDITION_LABEL),
    "lbl_comorbidity": _values(L.COMORBIDITY_CHAPTER_LABEL),
    "lbl_external": _values(L.EXTERNAL_CAUSE_LABEL),
    "lbl_line": _values(L.CERTIFICATE_LINE_LABEL),
    "lbl_death": _values(L.DEATH_BY_LETTER),
}
