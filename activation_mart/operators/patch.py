"""Keyed changes to a table, as new frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import latest_one


def keyed_patch(
    master: DataFrame,
    patch: DataFrame,
    key: str,
    columns: Sequence[str],
    mode: str = "overwrite",
    where: str | None = None,
    flag: str | None = None,
    order: Sequence[str] = (),
    once: bool = False,
) -> DataFrame:
    """Set ``columns`` where ``patch`` has the key.

    Of several patch rows with one key the one with the greatest ``order``
    values counts, by default the greatest values of ``columns``; rows of the
    master are never multiplied. ``once`` says that it has one row a key already.

    ``overwrite`` writes NULLs of the patch too; ``fill_null`` leaves columns
    that already hold a value. ``where`` limits the rows of the master, ``flag``
    names a column telling which rows were hit.
    """
    if mode not in ("overwrite", "fill_null"):
        raise ValueError(f"unknown patch mode: {mode}")
    types = {c: master.schema[c].dataType.simpleString() for c in columns}
    rows = patch.select(*{key: 0, **dict.fromkeys([*columns, *order])})
    if not once:
        rows = latest_one(rows, key, [*dict.fromkeys([*order, *columns])])
    news = rows.selectExpr(
        key, "true AS __found",
        *(f"CAST({c} AS {data_type}) AS __new_{c}" for c, data_type in types.items()),
    )
    hit = f"coalesce(__found AND ({where}), false)" if where else "__found IS NOT NULL"
    joined = master.join(news, key, "left").withColumn("__hit", F.expr(hit))
    free = " AND {} IS NULL" if mode == "fill_null" else ""
    patched = joined.withColumns(
        {
            c: F.expr(f"CASE WHEN __hit{free.format(c)} THEN __new_{c} ELSE {c} END")
            for c in columns
        }
    ).drop("__found", *(f"__new_{c}" for c in columns))
    return patched.withColumnRenamed("__hit", flag) if flag else patched.drop("__hit")


def append_new(master: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Add the rows whose key the master does not hold yet; ``rows`` has one row per new key."""
    fresh = rows.join(master.select(key), key, "left_anti")
    return master.unionByName(fresh, allowMissingColumns=True)


def set_where(df: DataFrame, column: str, value, condition: Column) -> DataFrame:
    """Set one column where the condition holds; an unknown condition changes nothing."""
    value = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(condition, value).otherwise(F.col(column)))


def add_column(df: DataFrame, column: str, data_type: str) -> DataFrame:
    """Add an empty column."""
    return df.withColumn(column, F.lit(None).cast(data_type))
