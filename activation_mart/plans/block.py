"""Who put the compliance block in force, and when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import RunWindow, code_needs_trusted_user, folded, in_window, same_text_in
from ..operators import latest_one, latest_with_ties, rows_at_latest, with_attempt
from ..session import settle
from ..sources import Sources

BLOCK_COLUMNS = ("BlockCreditratingkey", "BlockDate", "BlockUser")


def latest_block_changes(
    src: Sources,
    window: RunWindow | None = None,
    customers: DataFrame | None = None,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
) -> DataFrame:
    """Blocking rating changes at each customer's latest blocking instant, with their user.

    A restricted code by an untrusted user at that instant leaves nothing: an
    earlier change is not taken instead.
    """
    codes = {*config.LATEST_BLOCK_CODES, *config.OPEN_BLOCK_CODES}
    history = src["rating_history"].select(
        "CustomerKey", "ChangeDate", "CreditRatingKey", "SysUserKey"
    ).filter(same_text_in("CreditRatingKey", sorted(codes)))
    if window is not None:
        history = history.filter(in_window("ChangeDate", window))
    if customers is not None:
        history = history.join(customers.select("CustomerKey"), "CustomerKey", "left_semi")
    history = settle(history, "block-changes")  # looked at twice
    latest = rows_at_latest(
        history, "CustomerKey", "ChangeDate",
        same_text_in("CreditRatingKey", config.LATEST_BLOCK_CODES),
    )
    eligible = latest.filter(
        code_needs_trusted_user(
            "CreditRatingKey", "SysUserKey", config.OPEN_BLOCK_CODES,
            config.RESTRICTED_BLOCK_CODE, cfg.trusted_block_users,
        )
    )
    return eligible.join(src["sys_user"].select("SysUserKey", "FullName"), "SysUserKey")


def blocks_in_force(changes: DataFrame, src: Sources) -> DataFrame:
    """Changes that still are the rating of their card, with its account."""
    cards = src["customer"].filter("AccountKey is not null").select(
        "AccountKey", "CustomerKey", folded("CreditRatingKey").alias("__rating")
    )
    rated = changes.withColumn("__rating", folded("CreditRatingKey"))
    return rated.join(cards, ["CustomerKey", "__rating"]).select("AccountKey", "CustomerKey", "ChangeDate", "CreditRatingKey", "SysUserKey", "FullName")


def block_attribution(
    src: Sources,
    window: RunWindow | None = None,
    customers: DataFrame | None = None,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
) -> DataFrame:
    """Blocks in force, numbered per account from the latest backwards."""
    changes = latest_block_changes(src, window, customers, cfg)
    return with_attempt(blocks_in_force(changes, src), "AccountKey", "ChangeDate")


def latest_blocks(
    src: Sources,
    window: RunWindow | None = None,
    customers: DataFrame | None = None,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
) -> DataFrame:
    """Blocks in force at each account's latest instant, ties included: attempt 1 without ranking the rest."""
    blocks = blocks_in_force(latest_block_changes(src, window, customers, cfg), src)
    return latest_with_ties(blocks, "AccountKey", "ChangeDate")


def block_per_account(
    src: Sources,
    window: RunWindow | None = None,
    customers: DataFrame | None = None,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
) -> DataFrame:
    """The one latest block of each account; ties go to the greatest keys."""
    blocks = blocks_in_force(latest_block_changes(src, window, customers, cfg), src)
    order = ["ChangeDate", "CustomerKey", "CreditRatingKey", "SysUserKey"]
    return latest_one(blocks, "AccountKey", order).select(
        "AccountKey",
        F.col("CreditRatingKey").alias("BlockCreditratingkey"),
        F.col("ChangeDate").alias("BlockDate"),
        F.col("FullName").alias("BlockUser"),
    )
