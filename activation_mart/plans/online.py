"""Failures and activation step of online accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import ci_eq, ci_like, month_year
from ..operators import (
    SPREAD,
    first_match,
    has_row,
    left_lookup,
    only_keys,
    set_where,
    union_distinct,
    with_spread,
)
from ..sources import Sources, activity_type_order
from .checks import with_check_facts

FAILURE_COLUMNS = (
    "Month_Year", "ActicationActivityOrder", "activityDesc", "CustomerKey", "AccountKey",
)


def online_failures(src: Sources, only: DataFrame | None = None) -> DataFrame:
    """Unconfirmed online activities that have a known type."""
    return (
        only_keys(src["activation_activity"], only, "CustomerKey")
        .filter(F.col("ActivationTypeKey") == config.ONLINE_ACTIVATION_TYPE)
        .filter(F.col("IsConfirmed") == F.lit(False))
        .filter(has_row(src["activation_type"], "ActivationTypeKey", config.ONLINE_ACTIVATION_TYPE))
        .select(
            "CustomerKey",
            "ActivationActivityTypeKey",
            month_year("ActivationActivityCreateDate").alias("Month_Year"),
        )
    )


def describe_failures(failures: DataFrame, src: Sources) -> DataFrame:
    """Add activity text and report order."""
    types = src["activation_activity_type"].select(
        "ActivationActivityTypeKey", F.col("ActivationActivityType").alias("activityDesc")
    )
    # Eight rows of our own, hence the only hinted broadcast of a dimension.
    order = F.broadcast(
        activity_type_order(src.spark).select("ActivationActivityTypeKey", "ActicationActivityOrder")
    )
    return failures.join(types, "ActivationActivityTypeKey").join(
        order, "ActivationActivityTypeKey", "left"
    )


def failure_facts(accounts: DataFrame, src: Sources) -> DataFrame:
    """One row per unconfirmed online activity of the accounts' verification cards."""
    cards = accounts.select("AccountKey", F.col("VCustomerkey").alias("CustomerKey"))
    return describe_failures(
        online_failures(src).join(cards, "CustomerKey"), src
    ).select(*FAILURE_COLUMNS)


def reclassify(failures: DataFrame, has_check: Column) -> DataFrame:
    """Negative matches: fraud checks, and customer verification of accounts without a check."""
    negative = ci_eq("activityDesc", "fraud check") | (
        ci_eq("activityDesc", "customer verification") & ~has_check
    )
    flagged = failures.withColumn("__negative", negative)
    relabelled = set_where(
        flagged, "ActicationActivityOrder", config.NEGATIVE_MATCH_ORDER, F.col("__negative")
    )
    return set_where(
        relabelled, "activityDesc", config.NEGATIVE_MATCH_TEXT, F.col("__negative")
    ).drop("__negative")


def reclassified_failures(accounts: DataFrame, src: Sources, distinct: bool = False) -> DataFrame:
    """Failure facts after reclassification.

    With ``distinct`` the activities are reduced to one per customer, month and
    type before they meet the accounts, so a customer with very many activities
    does not travel through the join.
    """
    cards = accounts.select(
        "AccountKey",
        F.col("VCustomerkey").alias("CustomerKey"),
        F.col("LastIdentityValidationKey").isNotNull().alias("__checked"),
    )
    failures = online_failures(src)
    if distinct:
        failures = failures.distinct()
    rows = describe_failures(failures.join(cards, "CustomerKey"), src)
    return reclassify(rows, F.col("__checked")).select(*FAILURE_COLUMNS)


def all_failures(accounts: DataFrame, src: Sources) -> DataFrame:
    """Failures of accounts without a failed quiz, and one quiz row per account with one."""
    columns = ("AccountKey", "VCustomerkey", "LastIdentityValidationKey", "CreateDate")
    checked = with_check_facts(accounts.select(*columns), src)
    quiz_failed = F.coalesce(F.col("quiz_failed"), F.lit(False))
    failed = checked.filter(quiz_failed).select(
        month_year("CreateDate").alias("Month_Year"),
        F.lit(config.QUIZ_FAILURE_ORDER).alias("ActicationActivityOrder"),
        F.lit(config.QUIZ_FAILURE_TEXT).alias("activityDesc"),
        F.col("VCustomerkey").alias("CustomerKey"),
        "AccountKey",
    )
    others = reclassified_failures(checked.filter(~quiz_failed), src, distinct=True)
    return union_distinct(others, failed)


def failure_flags(src: Sources, only: DataFrame | None = None) -> DataFrame:
    """Per customer, which kinds of failure occurred: one row of flags, whatever its activity count."""
    text = "ActivationActivityType"
    kinds = {
        "failed_verification": ci_eq(text, "customer verification"),
        "failed_fraud": ci_eq(text, "fraud check"),
        "failed_address": ci_eq(text, "address validation"),
        "failed_limit": ci_like(text, "%partner%"),
        "failed_oow": ci_like(text, "%oow%"),
        "failed_negative": ci_like(text, "%negative%"),
    }
    types = src["activation_activity_type"].select(
        "ActivationActivityTypeKey",
        *(F.coalesce(test, F.lit(False)).alias(name) for name, test in kinds.items()),
    )
    # At most one row per customer and type meets the few types.
    found = online_failures(src, only).select("CustomerKey", "ActivationActivityTypeKey").distinct()
    return (
        with_spread(found, "CustomerKey")
        .join(types, "ActivationActivityTypeKey")
        .groupBy("CustomerKey", SPREAD)
        .agg(*(F.bool_or(name).alias(name) for name in kinds))
    )


IS_APPROVED = (
    f"lower(rtrim(VerificationStatusType)) = '{config.APPROVED.lower()}' "
    "AND CardActivationDate IS NOT NULL"
)


def online_step(default: str | None = "Incomplete") -> Column:
    """Step of an online account from its failure and quiz flags, NULL flags meaning no.

    A failed quiz stands for all failures of the account.
    """
    checked = "LastIdentityValidationKey IS NOT NULL"
    quiz_failed = f"({checked} AND coalesce(quiz_failed, false))"
    other = f"NOT {quiz_failed} AND"
    return first_match(
        [
            ("Approved", IS_APPROVED),
            ("Ident_Verify", f"{other} failed_verification AND {checked}"),
            ("Addr_Verify", f"{other} failed_address"),
            ("Card_Limit", f"{other} failed_limit"),
            ("OOW", f"{quiz_failed} OR failed_oow"),
            ("Neg_Match", f"{other} (failed_negative OR failed_fraud OR failed_verification)"),
        ],
        default,
    )


def online_steps(
    accounts: DataFrame, src: Sources, default: str | None = "Incomplete"
) -> DataFrame:
    """Step of each given online account."""
    columns = (
        "AccountKey", "VCustomerkey", "LastIdentityValidationKey", "VerificationStatusType",
        "CardActivationDate",
    )
    facts = left_lookup(
        with_check_facts(accounts.select(*columns), src),
        [failure_flags(src)], "VCustomerkey", "CustomerKey", "AccountKey",
    )
    return facts.select("AccountKey", online_step(default).alias(config.STEP_COLUMN))
