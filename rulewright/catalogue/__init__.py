"""All queries over the driver's tables and their SQL counterparts."""

from __future__ import annotations

from . import evidence, extraction, propositions, rules

_PARTS = (rules, propositions, extraction, evidence)


def queries() -> dict:
    return {k: f for part in _PARTS for k, f in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: q for part in _PARTS for k, q in part.ORACLES.items()}
