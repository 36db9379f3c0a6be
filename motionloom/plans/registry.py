"""All queries of the trajectory operators, and their SQL, by name."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
MODULES = ("kinematics", "alignment", "tables", "reports", "repair", "inspection", "export")
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _queries[name] = f
        if sql:
            _sql[name] = sql
        return f

    return keep


def sql_of(name: str) -> str:
    """The SQL of a query that is registered already."""
    return _sql[name]


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"motionloom.plans.{m}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
