"""Text comparison that ignores case and trailing blanks, as the source database does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def folded(column: Column | str) -> Column:
    return F.lower(F.rtrim(as_column(column)))


def ci_eq(column: Column | str, text: str | Column) -> Column:
    if isinstance(text, str):
        return folded(column) == F.lit(text.rstrip(" ").lower())
    return folded(column) == folded(text)


def ci_like(column: Column | str, pattern: str) -> Column:
    return as_column(column).ilike(pattern)
