"""Registered queries over the given tables, each with the SQL that says what it must return."""

from __future__ import annotations

from pricelake.workload import documents, gold, loads, scalar, silver, storage

MODULES = (gold, scalar, documents, silver, storage, loads)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
