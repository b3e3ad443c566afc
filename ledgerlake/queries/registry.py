from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; the ``v_`` views its SQL names are put in front of it as CTEs."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return fn

    return add
