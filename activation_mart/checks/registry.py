"""Registry of checks: a Spark query and the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.standin import STANDINS, StandinTables, oracle_tables
from .fragments import FRAGMENTS

_runs: dict[str, Callable[[StandinTables], DataFrame]] = {}
_sql: dict[str, str] = {}


def check(name: str, sql: str | None):
    """Register the decorated function as a query; ``sql`` may name stand-ins and fragments."""

    def register(run: Callable[[StandinTables], DataFrame]):
        if name in _runs:
            raise ValueError(f"duplicate check {name}")
        _runs[name] = run
        if sql is not None:
            _sql[name] = sql
        return run

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(run):
        return lambda spark, folder: run(StandinTables(spark, folder))

    return {name: query(run) for name, run in _runs.items()}


def oracles() -> dict[str, str]:
    return {name: _with_tables(sql) for name, sql in _sql.items()}


def _names(sql: str) -> list[str]:
    return re.findall(r"\b(?:src|x)_[a-z0-9_]+", sql)


def _with_tables(sql: str) -> str:
    """Put the stand-ins and fragments a text uses, directly or not, before it."""
    fragments: dict[str, str] = {}
    standins: list[str] = []

    def add(text: str) -> None:
        for name in _names(text):
            if name in FRAGMENTS and name not in fragments:
                add(FRAGMENTS[name])
                fragments[name] = FRAGMENTS[name]
            elif name in STANDINS:
                standins.append(name)

    add(sql)
    parts = [f"{name} AS MATERIALIZED ({text})" for name, text in (*oracle_tables(standins), *fragments.items())]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
