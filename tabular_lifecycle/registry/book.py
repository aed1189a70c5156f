"""Named queries with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is checked by its own tests only."""
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add
