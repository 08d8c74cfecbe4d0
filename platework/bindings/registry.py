"""Queries by name, each with the SQL that gives the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name."""

    def add(function: Query) -> Query:
        if function.__name__ in QUERIES:
            raise ValueError(f"two queries are called {function.__name__}")
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def percent_sql(part: str, whole: str, digits: int = 2) -> str:
    """``part * 100 / whole`` rounded half-up, in whole numbers; NULL for a whole of zero."""
    scale = 10**digits
    rounded = f"((abs({part}) * {200 * scale} + abs({whole})) // nullif(2 * abs({whole}), 0))"
    return f"CAST(sign({part}) * sign({whole}) * {rounded} AS DOUBLE) / {scale}"
