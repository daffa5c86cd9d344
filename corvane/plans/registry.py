"""Queries by name, each with the SQL that says the same, as the operator modules register them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function of (session, folder) under a name; ``sql`` is its equivalent for DuckDB."""

    def put(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is there already")
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return put


def queries() -> dict[str, Query]:
    from . import catalog  # noqa: F401  imports all modules that register

    return _QUERIES


def oracle_sql() -> dict[str, str]:
    queries()
    return _SQL
