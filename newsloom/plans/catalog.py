"""Registry of the checked queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsloom.plans.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def checked(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query under `name`, with its SQL behind the given views."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, *views) if views else sql
        return fn

    return register
