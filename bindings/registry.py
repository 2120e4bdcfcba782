"""Where the bound queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows, under ``name`` or that of its function."""

    def register(fn: Query) -> Query:
        QUERIES[name or fn.__name__] = fn
        ORACLES[name or fn.__name__] = sql
        return fn

    return register
