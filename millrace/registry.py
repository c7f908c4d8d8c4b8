"""Catalogue of runnable queries: a name, a Spark function and, where one exists, the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.session import configure

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: QueryFn
    sql: str | None


_QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register a function ``(spark, folder) -> DataFrame`` under ``name``."""

    def register(fn: QueryFn) -> QueryFn:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        _QUERIES[name] = Query(name, run, sql)
        return run

    return register


def registered() -> dict[str, Query]:
    import millrace.catalog  # noqa: F401  (fills the table on first import)

    return dict(_QUERIES)
