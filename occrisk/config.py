"""Load configuration: year ranges and state."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class LoadConfig:
    """Inclusive year range per source and the state whose deaths are loaded."""

    state: str = "SP"
    first_year: int = 2020
    last_year: int = 2023
    rais_first_year: int = 2018
    rais_last_year: int = 2024
    cat_first_year: int = 2018
    cat_last_year: int = 2025
    sim_first_year: int = 2020
    sim_last_year: int = 2023

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> LoadConfig:
        """FIXED VALUES: variable names and defaults; deaths follow the global range."""
        first = int(env.get("INGEST_ANO_INICIO", "2020"))
        last = int(env.get("INGEST_ANO_FIM", "2023"))
        return cls(
            state=env.get("INGEST_UF", "SP"),
            first_year=first,
            last_year=last,
            rais_first_year=int(env.get("INGEST_RAIS_ANO_INICIO", "2018")),
            rais_last_year=int(env.get("INGEST_RAIS_ANO_FIM", "2024")),
            cat_first_year=int(env.get("INGEST_CAT_ANO_INICIO", "2018")),
            cat_last_year=int(env.get("INGEST_CAT_ANO_FIM", "2025")),
            sim_first_year=int(env.get("INGEST_SIM_ANO_INICIO", str(first))),
            sim_last_year=int(env.get("INGEST_SIM_ANO_FIM", str(last))),
        )
