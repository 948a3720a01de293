"""What changed in a window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import RunWindow, folded, in_window
from ..sources import Sources

CHECK, RATING, STATUS = "check_changed", "rating_changed", "status_changed"
KINDS = (CHECK, RATING, STATUS)
BY_SERIAL = "__by_serial"


def _checked_customers(src: Sources, window: RunWindow) -> DataFrame:
    checks = src["identity_validation"].filter(in_window("CreateDate", window))
    links = src["identity_validation_customer"].select("IdentityValidationKey", "CustomerKey")
    checked = links.join(checks.select("IdentityValidationKey"), "IdentityValidationKey", "left_semi")
    return checked.select(F.col("CustomerKey").cast("string").alias("__key"))


def _rated_customers(src: Sources, window: RunWindow) -> DataFrame:
    changes = src["rating_history"].filter(in_window("ChangeDate", window))
    return changes.select(F.col("CustomerKey").cast("string").alias("__key"))


def _changed_serials(src: Sources, window: RunWindow) -> DataFrame:
    changes = src["card_status_history"].filter(in_window("StartDate", window))
    return changes.select(folded("SerialNbr").alias("__key"))


_FOUND = {CHECK: _checked_customers, RATING: _rated_customers, STATUS: _changed_serials}


def changed_keys(src: Sources, window: RunWindow, kinds: Sequence[str] = KINDS) -> DataFrame:
    """One row per changed customer or serial number, telling which of the ``kinds`` of change it had.

    The kinds are one tagged union, reduced by one aggregate: however often a
    key changed, each task sends it once.
    """
    tagged = [
        _FOUND[kind](src, window).select(
            F.lit(kind == STATUS).alias(BY_SERIAL), "__key", *(F.lit(k == kind).alias(k) for k in kinds)
        )
        for kind in kinds
    ]
    keys = reduce(DataFrame.unionAll, tagged).filter("__key IS NOT NULL")
    return keys.groupBy(BY_SERIAL, "__key").agg(*(F.bool_or(k).alias(k) for k in kinds))


def account_changes(src: Sources, window: RunWindow, kinds: Sequence[str] = KINDS) -> DataFrame:
    """(Account, customer) pairs with a change of the ``kinds``, and which; customers are read once.

    Customers are laid out by the keys that the kinds need, customer key, serial
    number or both, and meet the changed keys in one join.
    """
    customers = src["customer"].filter("AccountKey IS NOT NULL")
    by_key = F.struct(F.lit(False).alias(BY_SERIAL), F.col("CustomerKey").cast("string").alias("__key"))
    by_serial = F.struct(F.lit(True).alias(BY_SERIAL), folded("SerialNbr").alias("__key"))
    layouts = [by_key] * any(k != STATUS for k in kinds) + [by_serial] * (STATUS in kinds)
    if len(layouts) == 1:
        laid = customers.select("AccountKey", "CustomerKey", layouts[0].alias("__by"))
    else:
        laid = customers.select("AccountKey", "CustomerKey", F.explode(F.array(*layouts)).alias("__by"))
    hits = laid.select("AccountKey", "CustomerKey", "__by.*").join(
        changed_keys(src, window, kinds), [BY_SERIAL, "__key"]
    )
    return hits.groupBy("AccountKey", "CustomerKey").agg(*(F.bool_or(k).alias(k) for k in kinds))


def changed_checks(src: Sources, window: RunWindow) -> DataFrame:
    """Accounts with an identity check created in the window."""
    return account_changes(src, window, [CHECK]).select("AccountKey").distinct()


def changed_ratings(src: Sources, window: RunWindow) -> DataFrame:
    """(Account, customer) pairs with a rating change in the window."""
    return account_changes(src, window, [RATING]).select("AccountKey", "CustomerKey")


def changed_status(src: Sources, window: RunWindow) -> DataFrame:
    """Accounts with a card-status change in the window."""
    return account_changes(src, window, [STATUS]).select("AccountKey").distinct()


def all_changes(src: Sources, window: RunWindow) -> DataFrame:
    """The three kinds of change in one frame: one row per changed (account, customer) pair."""
    return account_changes(src, window)


def changed_accounts(changes: DataFrame) -> DataFrame:
    """One row per changed account, telling which of the changes it had."""
    return changes.groupBy("AccountKey").agg(*(F.bool_or(kind).alias(kind) for kind in KINDS))
