"""Registration of queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function as the query ``name``, with oracle SQL if there is some."""

    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is there already")
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register
