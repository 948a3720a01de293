"""Rows kept whole beside the columns that an operator works with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE = "__whole"


def held(docs: DataFrame, *needed: str) -> DataFrame:
    """The ``needed`` columns, and all others as one: no name among these can clash with an operator's own."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in needed] or [F.lit(0).alias("none")]
    return docs.select(F.struct(*others).alias(WHOLE), *needed)


def released(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """Rows of ``held`` with the columns of ``docs`` in their order, and the ``changed`` ones."""
    inside = set(rows.schema[WHOLE].dataType.names)

    def column(name: str) -> Column:
        return changed.get(name, F.col(f"{WHOLE}.`{name}`") if name in inside else F.col(f"`{name}`"))

    return rows.select(*(column(c).alias(c) for c in docs.columns))
