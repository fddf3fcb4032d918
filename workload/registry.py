"""Collects queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its inventory key, with its oracle where SQL can state one."""
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return register


def rnd_row(expression: str, digits: int) -> str:
    """Oracle rounding of one row's double on its decimal rendering, halves away from zero."""
    text = f"CAST(CAST({expression} AS DOUBLE) AS VARCHAR)"
    return f"CAST(round(CAST({text} AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def rnd(expression: str, digits: int) -> str:
    """Oracle rounding of a sum or mean, settled six digits further on before."""
    return rnd_row(rnd_row(expression, digits + 6), digits)
