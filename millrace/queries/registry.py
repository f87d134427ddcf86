"""Named queries and the SQL text each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is the same question in SQL over the same tables."""
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function
    return add


def big(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")


def day(col: Column | str) -> Column:
    return F.date_format(col, "yyyy-MM-dd")
