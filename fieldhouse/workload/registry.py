"""Collects queries and their SQL counterparts under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


def r6(c: str | Column, alias: str | None = None) -> Column:
    """Rounded to six decimals, so that summation order cannot show."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(alias or c)
