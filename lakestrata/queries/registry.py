"""Where queries announce themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the equivalent SQL if there is one."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        if key in _QUERIES:
            raise ValueError(f"query registered twice: {key}")
        _QUERIES[key] = function
        if sql is not None:
            _SQL[key] = sql
        return function

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
