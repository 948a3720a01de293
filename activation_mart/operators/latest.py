"""Latest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .keys import in_positions


def with_attempt(df: DataFrame, key: str, moment: str, name: str = "attempt") -> DataFrame:
    """Number the moments of each key from the latest backwards; equal moments share a number.

    The rows are settled, so what they come from is read once. Their distinct
    (key, moment) pairs, two columns combined before the shuffle, stand in range
    partitions: a pair's number is its position less that of the key's first
    pair. A partition takes the latter from what the key has in the ones before
    it, a row for each partition and key, so a key may span any number of tasks.
    The rows meet the numbers on key and moment, which spreads a hot key. Rows
    without a key form a group of their own, rows without a moment come last.
    """
    rows = settle(df, "rows")
    moments = rows.select(F.col(key).alias("__key"), F.col(moment).alias("__moment")).distinct()
    placed = in_positions(moments, ["__key", F.col("__moment").desc()])
    heads = placed.groupBy("__key", "__part").agg(F.min("__position").alias("__head"))
    carried = heads.select(
        F.col("__key").alias("__of_key"), F.col("__part").alias("__of_part"),
        F.min("__head").over(Window.partitionBy("__key")).alias("__head"),
    )
    numbered = placed.join(carried, F.expr("__key <=> __of_key AND __part = __of_part")).select(
        "__key", "__moment", (F.col("__position") - F.col("__head") + 1).cast("int").alias("__number")
    )
    match = F.expr(f"{key} <=> __key AND {moment} <=> __moment")
    return rows.join(numbered, match).select(*df.columns, F.col("__number").alias(name))


def latest_with_ties(df: DataFrame, key: str, moment: str) -> DataFrame:
    """All rows of each key that carry its latest moment.

    The filter on the rank becomes a group limit on both sides of the shuffle,
    so each task sends only its own latest rows of a hot key.
    """
    order = Window.partitionBy(key).orderBy(F.col(moment).desc())
    ranked = df.withColumn("__attempt", F.dense_rank().over(order))
    return ranked.filter("__attempt = 1").drop("__attempt")


_DAY_MICROS = 86_400_000_000
#: Decimal digits of a value as a number from 1, 0 for NULL: fixed-width types that order alike as numbers.
_DIGITS = {T.BooleanType: 1, T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.DateType: 10, T.LongType: 20,
           T.TimestampNTZType: 18, T.TimestampType: 18}
_LEAST = {1: 0, 3: -(1 << 7), 5: -(1 << 15), 10: -(1 << 31), 20: -(1 << 63), 18: -(10**17)}
_MOST_DIGITS = 38


def _as_number(column: str, kind: T.DataType) -> str:
    value = f"`{column}`"
    if isinstance(kind, T.TimestampNTZType):  # zone-free
        value = (
            f"(unix_date(CAST({value} AS DATE)) * {_DAY_MICROS} + hour({value}) * 3600000000 "
            f"+ minute({value}) * 60000000L + CAST(extract(SECOND FROM {value}) * 1000000 AS BIGINT))"
        )
    elif isinstance(kind, T.TimestampType):
        value = f"unix_micros({value})"
    elif isinstance(kind, T.DateType):
        value = f"unix_date({value})"
    elif isinstance(kind, T.BooleanType):
        value = f"CAST({value} AS INT)"
    least = _LEAST[_DIGITS[type(kind)]]
    return f"coalesce(CAST({value} AS DECIMAL(38,0)) - ({least}) + 1, 0)"


def order_number(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One number that orders rows as ``order`` does, NULLs first; None where the columns don't fit into one.

    A decimal is a fixed-width aggregation buffer, a struct is not: a maximum by
    it is a hash aggregate, one by a struct sorts its rows.
    """
    kinds = [df.schema[c].dataType for c in order]
    if not kinds or any(type(k) not in _DIGITS for k in kinds) or sum(_DIGITS[type(k)] for k in kinds) > _MOST_DIGITS:
        return None
    out = "CAST(0 AS DECIMAL(38,0))"
    for column, kind in zip(order, kinds):
        scale = 10 ** _DIGITS[type(kind)]
        out = f"CAST(CAST({out} * CAST({scale} AS DECIMAL(38,0)) AS DECIMAL(38,0)) + {_as_number(column, kind)} AS DECIMAL(38,0))"
    return F.expr(out)


def _fixed_width(kind: T.DataType) -> bool:
    return type(kind) in _DIGITS or isinstance(kind, (T.DecimalType, T.FractionalType))


def latest_one(
    df: DataFrame, key: str, order: Sequence[str | Column], row_id: str | None = None
) -> DataFrame:
    """The one row of each key with the greatest ``order`` values.

    An aggregate rather than a window: partial results leave each task, so a
    hot key costs one row per task. It hashes where all columns have a fixed
    width; strings make it sort its rows. Where ``row_id`` names a column that
    tells rows apart, strings and other wide columns stay out of it: winners are
    chosen on key, order and row_id, and their rows are fetched by row_id. A key
    of which no row has a row_id has no winner then.
    """
    names = [c for c in order if isinstance(c, str)]
    number = order_number(df, names) if len(names) == len(order) else None
    others = [c for c in df.columns if c != key]
    if number is not None and all(_fixed_width(df.schema[c].dataType) for c in others):
        numbered = df.withColumn("__number", number)
        best = (F.max_by(F.col(c), F.col("__number")).alias(c) for c in others)
        return numbered.groupBy(key).agg(*best)
    if number is not None and row_id is not None:
        numbered = df.select(key, F.col(row_id).alias("__row"), number.alias("__number"))
        chosen = numbered.filter("__row IS NOT NULL").groupBy(key).agg(F.max_by("__row", "__number").alias("__row"))
        return df.join(chosen.select("__row"), F.col(row_id) == F.col("__row"), "left_semi")
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*others), F.struct(*order)).alias("__row"))
        .select(key, "__row.*")
    )


def rows_at_latest(df: DataFrame, key: str, moment: str, among: Column) -> DataFrame:
    """Rows at the latest moment that a row passing ``among`` has, whether or not they pass it.

    The maximum is combined before the shuffle, and the second look at ``df``
    joins on key and moment, which spreads the history of a hot key.
    """
    latest = (
        df.filter(among)
        .groupBy(F.col(key).alias("__key"))
        .agg(F.max(moment).alias("__latest"))
    )
    return df.join(
        latest,
        (F.col(key) == F.col("__key")) & (F.col(moment) == F.col("__latest")),
        "left_semi",
    )
