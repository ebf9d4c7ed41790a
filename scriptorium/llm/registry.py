"""All queries of this subpackage and their SQL."""

from __future__ import annotations

from . import encoding, frequency, lookalikes, mixing, neighbours, packing, scans, spam

_MODULES = [encoding, frequency, lookalikes, neighbours, packing, spam, mixing, scans]


def queries() -> dict:
    return {k: q for m in _MODULES for k, q in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLE.items()}
