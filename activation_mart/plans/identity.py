"""The identity check in force for each account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import latest_one
from ..sources import Sources

CHECK_COLUMNS = ("LastIdentityValidationKey", "VerificationStatusType", "LastAttemptValue")


def account_customers(src: Sources, accounts: DataFrame | None = None) -> DataFrame:
    """Customer keys of all accounts, or of the given ones."""
    customers = src["customer"].select("AccountKey", "CustomerKey").filter("AccountKey is not null")
    if accounts is None:
        return customers
    return customers.join(accounts.select("AccountKey"), "AccountKey", "left_semi")


def latest_check(src: Sources, accounts: DataFrame | None = None) -> DataFrame:
    """Per account the latest identity check of any of its customers.

    For all accounts the checks are reduced per customer first, so the join with
    the customers meets one row per customer and uses the partitioning the
    reduction leaves. For given accounts the links are cut to their customers
    before the checks are looked up.
    """
    order = ["CheckDate", "LastIdentityValidationKey"]
    checks = src["identity_validation"].select(
        F.col("IdentityValidationKey").alias("LastIdentityValidationKey"),
        F.col("CreateDate").alias("CheckDate"),
        "VerificationStatusType", "LastAttemptValue",
    )
    links = src["identity_validation_customer"].select(
        F.col("IdentityValidationKey").alias("LastIdentityValidationKey"), "CustomerKey"
    )
    customers = account_customers(src, accounts)
    if accounts is None:
        by_customer = latest_one(links.join(checks, "LastIdentityValidationKey"), "CustomerKey", order)
        candidates = by_customer.join(customers, "CustomerKey").drop("CustomerKey")
    else:
        links = links.join(customers, "CustomerKey").drop("CustomerKey")
        candidates = links.join(checks, "LastIdentityValidationKey")
    return latest_one(candidates, "AccountKey", order).select("AccountKey", *CHECK_COLUMNS)
