"""Previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def preview(df: DataFrame, rows: int) -> DataFrame:
    """Any ``rows`` rows."""
    return df.limit(rows)


def top_n(df: DataFrame, rows: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``rows`` rows in ``order``."""
    return df.orderBy(*order).limit(rows)
