"""All core queries and their SQL."""

from __future__ import annotations

from . import corpus, events, extras, layouts, library, more, texts

_MODULES = [library, texts, layouts, extras, more, events, corpus]


def queries() -> dict:
    return {k: q for m in _MODULES for k, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLE.items()}
