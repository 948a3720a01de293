"""Sign-ups of a window and the new accounts among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import RunWindow, channel_label, exclude_patterns, in_window
from ..operators import latest_one
from ..sources import Sources

SIGNUP_COLUMNS = ("AccountKey", "CreateDate", "BankKey", "BankName", "Channel")


def signup_keys(
    src: Sources, window: RunWindow, cfg: config.MartConfig = config.DEFAULT_CONFIG
) -> DataFrame:
    """Keys of the window's cards, without test accounts and gift cards: columns of fixed width only."""
    cards = (
        src["customer"]
        .filter(in_window("CreateDate", window))
        .filter(F.col("AccountKey").isNotNull())
        .filter(exclude_patterns(cfg.test_accounts.patterns()))
        .select("AccountKey", "CustomerKey", "CreateDate", "ProductKey")
    )
    products = (
        src["product"]
        .filter(F.col("ourcardtypekey") == config.STANDARD_CARD_TYPE)
        .select("ProductKey", "BankKey", "isOnlineProduct")
        .join(src["bank"].select("BankKey"), "BankKey", "left_semi")
    )
    return cards.join(products, "ProductKey")


def _named(keys: DataFrame, src: Sources) -> DataFrame:
    """Sign-up columns and customer key of rows of ``signup_keys``, which stay where they are: banks are few."""
    return keys.join(F.broadcast(src["bank"].select("BankKey", "BankName")), "BankKey").select(
        "AccountKey", "CreateDate", "BankKey", "BankName",
        channel_label("isOnlineProduct").alias("Channel"), "CustomerKey",
    )


def account_extract(
    src: Sources, window: RunWindow, cfg: config.MartConfig = config.DEFAULT_CONFIG
) -> DataFrame:
    """Card rows of the window with bank and channel, without test accounts and gift cards."""
    return _named(signup_keys(src, window, cfg), src)


def new_only(signups: DataFrame, master: DataFrame) -> DataFrame:
    """Sign-ups of accounts the master does not hold."""
    return signups.join(master.select("AccountKey"), "AccountKey", "left_anti")


def latest_signups(
    src: Sources, window: RunWindow, cfg: config.MartConfig = config.DEFAULT_CONFIG
) -> DataFrame:
    """One sign-up per account: the latest, then the one with the greatest customer key.

    Chosen on keys by a hash aggregate; names are put to the winners alone.
    """
    keys = signup_keys(src, window, cfg)
    return _named(latest_one(keys, "AccountKey", ["CreateDate", "CustomerKey"]), src).select(*SIGNUP_COLUMNS)
