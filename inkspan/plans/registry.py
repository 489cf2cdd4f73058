"""All queries of the package by name, with their SQL twins."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}
#: Modules that register queries when imported.
MODULES = ("q_geometry", "q_text", "q_joins", "q_aggregates", "q_sequences", "q_sources", "q_structure", "q_folds", "q_tables", "q_rasters", "q_segments", "q_sweep", "q_ruled")


def query(name: str, sql: str | None = None):
    """Registers f(tables) as a query; sql is its twin over the driver's views and derive.CTES."""

    def put(f):
        from inkspan.plans.derive import CTES, Tables

        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[name] = f"with {CTES}\n{sql}"
        return f

    return put


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"inkspan.plans.{m}")


def flagship(spark, sf_dir):
    _load()
    return QUERIES["a14_markdown_assembly"](spark, sf_dir)


def queries() -> dict[str, Callable]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
