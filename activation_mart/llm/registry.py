"""Queries of this subpackage, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function of (spark, folder) as a query."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in _queries:
            raise ValueError(f"duplicate query {name}")
        _queries[name] = run
        if sql is not None:
            _sql[name] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalog  # noqa: F401  (its modules register themselves)

    return dict(_queries)


def oracles() -> dict[str, str]:
    queries()
    return dict(_sql)
