"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinara.session import configure

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str | Callable[[], str]] = {}


def query(name: str, sql: str | Callable[[], str] | None = None):
    """Register a query; ``sql`` (or what it returns) gives the same rows and column names."""

    def add(fn: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        run.__name__ = name
        _QUERIES[name] = run
        if sql:
            _ORACLES[name] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return {name: sql() if callable(sql) else sql for name, sql in _ORACLES.items()}
