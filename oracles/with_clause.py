"""Composition of WITH clauses: a statement carries only the CTEs it mentions."""

from __future__ import annotations

import re

from oracles.raw import RAW
from oracles.shared import SHARED
from oracles.staging import STAGING


def _mentioned(sql: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", sql) is not None


def statement(final: str) -> str:
    ctes = RAW | STAGING | SHARED
    needed: list[str] = []
    text = final
    # Later entries may only refer to earlier ones, so one backward pass closes
    # the set of dependencies.
    for name in reversed(ctes):
        if _mentioned(text, name):
            needed.insert(0, name)
            text += "\n" + ctes[name]
    if not needed:
        return final
    head = ",\n".join(f"{name} as (\n{ctes[name]}\n)" for name in needed)
    body = final.strip()
    if body.startswith("with "):  # the statement brings CTEs of its own
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"
