"""Checks on keys and values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def repeated_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows of the keys that occur more than once."""
    return df.join(duplicates(df.select(key), [key]).select(key), key, "left_semi")


def drift(
    master: DataFrame, fresh: DataFrame, key: str, columns: Sequence[str], null_safe: bool = False
) -> DataFrame:
    """Keys whose master value differs from the fresh one in any of ``columns``.

    A NULL on either side is no difference unless ``null_safe``.
    """
    news = fresh.select(key, *(F.col(c).alias(f"new_{c}") for c in columns))

    def differs(column: str):
        old, new = F.col(column), F.col(f"new_{column}")
        return ~old.eqNullSafe(new) if null_safe else old != new

    return (
        master.select(key, *columns)
        .join(news, key, "inner")
        .filter(reduce(or_, map(differs, columns)))
    )


def drift_by_column(
    master: DataFrame, fresh: DataFrame, key: str, sets: Mapping[str, Sequence[str]], null_safe: bool = False
) -> DataFrame:
    """Every differing value in long form: (key, part, field, old_value, new_value), the values as text.

    ``fresh`` has the columns of all ``sets``, and for each set a flag of its
    name telling whether the row speaks for it; one join compares them all. A
    NULL on either side is no difference unless ``null_safe``. Decimals and
    numbers are compared as such, not as the text shown.
    """
    columns = [c for group in sets.values() for c in group]
    news = fresh.select(
        key, *(F.col(name).alias(f"__has_{name}") for name in sets), *(F.col(c).alias(f"__new_{c}") for c in columns)
    )

    def change(name: str, column: str):
        old, new = F.col(column), F.col(f"__new_{column}")
        differs = ~old.eqNullSafe(new) if null_safe else old != new
        row = F.struct(
            F.lit(name).alias("part"), F.lit(column).alias("field"),
            old.cast("string").alias("old_value"), new.cast("string").alias("new_value"),
        )
        return F.when(F.col(f"__has_{name}") & differs, row)

    found = F.array_compact(F.array(*(change(name, c) for name, group in sets.items() for c in group)))
    return (
        master.select(key, *dict.fromkeys(columns)).join(news, key, "inner")
        .select(key, F.explode(found).alias("change")).select(key, "change.*")
    )
