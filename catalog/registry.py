"""Where queries register: a function over ``Inputs`` and, if SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalog.inputs import Inputs
from catalog.oracle_ctes import with_tables

Query = Callable[[Inputs], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    if name in _QUERIES:
        raise ValueError(f"{name} is registered twice")
    _QUERIES[name] = query
    if sql is not None:
        _SQL[name] = with_tables(sql)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: query(Inputs(spark, folder))

    return {name: bound(query) for name, query in _QUERIES.items()}


def registered_sql() -> dict[str, str]:
    return dict(_SQL)
