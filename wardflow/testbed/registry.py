"""Name, Spark query and oracle SQL of every registered query."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wardflow.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by tests on fixtures."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = wraps(fn)(lambda spark, folder: fn(apply_settings(spark), folder))
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register
