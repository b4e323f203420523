"""Independent DuckDB statements for every registered query.

Only the derivation of the raw tables and the fixed label tables are shared
with the engine; the logic above them is written again, in another style.
"""

from oracles.marts import MARTS
from oracles.operators import OPERATORS
from oracles.staging import STAGING
from oracles.with_clause import statement


def all_statements() -> dict[str, str]:
    finals = {name: f"select * from {name}" for name in STAGING if name.startswith("stg_")} | MARTS | OPERATORS
    return {name: statement(sql) for name, sql in finals.items()}
