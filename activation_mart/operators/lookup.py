"""Look-ups by key, anti joins and positional union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

NULL_SPREAD = 1024
FREQUENT_SPREAD = 64
SPREAD = "__spread"


def apply_inner(left: DataFrame, rows_by_key: DataFrame, key: str) -> DataFrame:
    """Attach the rows found for each key; keys without any are dropped."""
    return left.join(rows_by_key, key, "inner")


def apply_left(left: DataFrame, rows_by_key: DataFrame, key: str) -> DataFrame:
    """Attach the rows found for each key; keys without any stay, with NULLs."""
    return left.join(rows_by_key, key, "left")


def with_spread(facts: DataFrame, key: str) -> DataFrame:
    """Add the second look-up column, 0 for every key.

    Facts grouped by key and this column leave the aggregate partitioned as
    ``left_lookup`` needs them. It is computed from the key, because the
    optimiser would take a constant out of the join keys.
    """
    return facts.withColumn(SPREAD, F.expr(f"pmod(hash({key}), 1)"))


def _spread_of_nulls(key: str, spread_by: str) -> Column:
    return F.expr(
        f"CASE WHEN {key} IS NULL THEN pmod(hash({spread_by}), {NULL_SPREAD}) ELSE 0 END"
    )


def left_lookup(
    left: DataFrame, facts: Sequence[DataFrame], key: str, fact_key: str, spread_by: str
) -> DataFrame:
    """Left join several one-row-per-key frames on the same nullable column of ``left``.

    Rows without a key match nothing, yet a plain hash join would send them all
    to one task. They get a spread number from ``spread_by`` as second join
    column; all other rows, and the facts, have 0 there. The frames share one
    shuffle of ``left``.
    """
    out = left.withColumn("__left_spread", _spread_of_nulls(key, spread_by))
    match = F.expr(f"{key} = __fact_key AND __left_spread = {SPREAD}")
    for fact in facts:
        keyed = fact if SPREAD in fact.columns else with_spread(fact, fact_key)
        keyed = keyed.withColumnRenamed(fact_key, "__fact_key")
        out = out.join(keyed, match, "left").drop("__fact_key", SPREAD)
    return out.drop("__left_spread")


def only_keys(df: DataFrame, keys: DataFrame | None, key: str) -> DataFrame:
    """Rows with one of the ``keys`` (a frame of one column); all rows if there is no such frame.

    How the keys travel is left to Spark's size threshold.
    """
    if keys is None:
        return df
    named = keys.toDF(key)
    return df.join(named.filter(F.col(key).isNotNull()), key, "left_semi")


def has_row(table: DataFrame, column: str, value) -> Column:
    """Whether ``table`` has the value: one row of one flag, in place of a join on a single key."""
    return table.agg(F.count_if(F.col(column) == value) > 0).scalar()


def null_aware_anti(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is NOT IN the keys of ``right``, with SQL's NULL rules.

    A NULL on the right leaves nothing; a NULL on the left passes only an empty
    right. The right side is read once: its distinct keys, NULL among them, are
    settled, and whether there are any, and NULL is one, decides what is left to
    do. The keys never have to be broadcast, and rows without a key are not
    dealt by it.
    """
    keys = settle(right.select(F.col(key).alias("__key")).distinct(), "keys")
    some, null = keys.agg(F.count(F.lit(1)) > 0, F.count_if(F.col("__key").isNull()) > 0).first()
    if not some:
        return left
    keyed = left.filter(F.lit(not null) & F.col(key).isNotNull())
    return keyed.join(keys, F.col(key) == F.col("__key"), "left_anti")


def spread_lookup(
    left: DataFrame, rows: DataFrame, key: str, row_key: str, spread_by: str, spread: int = FREQUENT_SPREAD
) -> DataFrame:
    """Left join ``rows``, one per key and few, on a column of ``left`` in which a value or NULL may be frequent.

    Every row of ``left`` gets one of ``spread`` numbers from ``spread_by``, and
    each of ``rows`` stands once under each of them: no value of the key, and no
    lack of one, is a single task.
    """
    numbers = F.sequence(F.lit(0), F.lit(spread - 1))
    copies = rows.withColumnRenamed(row_key, "__row_key").withColumn("__copy", F.explode(numbers))
    salted = left.withColumn("__salt", F.expr(f"pmod(hash({spread_by}), {spread})"))
    match = F.expr(f"{key} = __row_key AND __salt = __copy")
    return salted.join(copies, match, "left").drop("__row_key", "__copy", "__salt")


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by column position without duplicates, also within each side."""
    return first.union(second).distinct()
