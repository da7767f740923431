"""Registry of named queries and their independent SQL answers.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over the tables of a
scale-factor folder.  ``sql`` (when given) is an ANSI/DuckDB statement over
the same tables, written independently, that must return the same rows.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

_MODULES = [
    "fernwood.plans.q_audit",
    "fernwood.plans.q_encode",
    "fernwood.plans.q_outlier",
    "fernwood.plans.q_select",
    "fernwood.plans.q_sample",
    "fernwood.plans.q_metrics",
    "fernwood.plans.q_compare",
    "fernwood.plans.q_learn",
    "fernwood.plans.q_sources",
]


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _load() -> None:
    for m in _MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:
            if e.name != m:
                raise


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
