"""Facts per identity check: quiz result and internal look-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import ci_eq, same_text_in
from ..operators import SPREAD, has_row, left_lookup, only_keys, set_where, spread_lookup, with_spread
from ..sources import Sources

KEY = "IdentityValidationKey"


def failed_quiz_rows(accounts: DataFrame, src: Sources) -> DataFrame:
    """Failed quizzes of the accounts' checks; only quizzes with a risk row count.

    One row per quiz: several risk rows of a check do not multiply it, the
    greatest value is shown.
    """
    failed = src["quiz"].filter(same_text_in("QuizResultCode", config.FAILED_QUIZ_CODES))
    risks = src["risk"].groupBy(KEY).agg(F.max("RiskValue").alias("RiskValue"))
    return (
        accounts.withColumnRenamed("LastIdentityValidationKey", KEY)
        .join(failed.select(KEY, "QuizResultCode"), KEY)
        .join(risks, KEY)
        .withColumnRenamed(KEY, "LastIdentityValidationKey")
    )


def quiz_facts(src: Sources, only: DataFrame | None = None) -> DataFrame:
    """Per check: greatest quiz result, and whether a quiz with a risk row failed."""
    quizzes = only_keys(src["quiz"], only, KEY)
    risks = only_keys(src["risk"].select(KEY), only, KEY)
    failed = same_text_in("QuizResultCode", config.FAILED_QUIZ_CODES)
    results = with_spread(quizzes, KEY).groupBy(KEY, SPREAD).agg(
        F.max("QuizResultCode").alias("quiz_result"), F.bool_or(failed).alias("__failed")
    )
    assessed = with_spread(risks, KEY).distinct()
    assessed = assessed.withColumn("__assessed", F.lit(True))
    return results.join(assessed, [KEY, SPREAD], "left").select(
        KEY,
        SPREAD,
        F.lit(True).alias("quiz_taken"),
        "quiz_result",
        F.coalesce(F.col("__failed") & F.col("__assessed"), F.lit(False)).alias("quiz_failed"),
    )


def internal_checks(src: Sources, only: DataFrame | None = None) -> DataFrame:
    """Checks answered by the internal vendor with the passing status."""
    passed = (
        only_keys(src["identity_validation_status"], only, KEY)
        .filter(
            (F.col("IdentityValidationVendorKey") == config.INTERNAL_VENDOR)
            & (F.col("IdentityValidationStatusTypeKey") == config.INTERNAL_STATUS_TYPE)
        )
        .select(KEY)
    )
    known = passed.filter(
        has_row(src["identity_validation_vendor"], "IdentityValidationVendorKey", config.INTERNAL_VENDOR)
        & has_row(
            src["identity_validation_status_type"], "IdentityValidationStatusTypeKey",
            config.INTERNAL_STATUS_TYPE,
        )
    )
    return (
        with_spread(known, KEY)
        .distinct()
        .withColumn("internal_check", F.lit(True))
    )


def with_check_facts(
    accounts: DataFrame, src: Sources, only: DataFrame | None = None
) -> DataFrame:
    facts = [quiz_facts(src, only), internal_checks(src, only)]
    return left_lookup(accounts, facts, "LastIdentityValidationKey", KEY, "AccountKey")


def quiz_column(accounts: DataFrame, src: Sources) -> DataFrame:
    """Quiz result of each account whose check had a quiz."""
    return (
        accounts.select("AccountKey", "LastIdentityValidationKey")
        .join(quiz_facts(src), F.col("LastIdentityValidationKey") == F.col(KEY))
        .select("AccountKey", F.col("quiz_result").alias(config.QUIZ_COLUMN))
    )


def may_be_internal():
    """Approved accounts without a last attempt value."""
    return ci_eq(config.STEP_COLUMN, config.APPROVED) & F.col("LastAttemptValue").isNull()


def internal_lookup(accounts: DataFrame, src: Sources) -> DataFrame:
    """Tag of accounts approved by the internal look-up."""
    candidates = accounts.filter(may_be_internal()).filter(
        ci_eq("VerificationStatusType", config.APPROVED)
    )
    return (
        candidates.select("AccountKey", "LastIdentityValidationKey")
        .join(internal_checks(src), F.col("LastIdentityValidationKey") == F.col(KEY))
        .select("AccountKey", F.lit(config.INTERNAL_TAG).alias("LastAttemptValue"))
    )


def current_banks(src: Sources) -> DataFrame:
    """Bank of each product."""
    return (
        src["product"]
        .select("ProductKey", "BankKey")
        .join(src["bank"].select("BankKey", "BankName"), "BankKey")
        .select(
            "ProductKey",
            F.col("BankKey").alias("newbankkey"),
            F.col("BankName").alias("newbankname"),
        )
    )


def bank_changes(master: DataFrame, src: Sources) -> DataFrame:
    """Accounts whose product belongs to another bank by now."""
    accounts = master.select("AccountKey", "ProductKey", "BankKey").filter("ProductKey IS NOT NULL")
    return _with_banks(accounts, src).filter("BankKey <> newbankkey")


def _with_banks(accounts: DataFrame, src: Sources) -> DataFrame:
    """Accounts with their product's bank now; a frequent product, or none, is dealt to many tasks."""
    banks = current_banks(src).withColumnRenamed("ProductKey", "__product")
    return spread_lookup(accounts, banks, "ProductKey", "__product", "AccountKey")


def refresh_bank(master: DataFrame, src: Sources) -> DataFrame:
    """Master with the bank of each account's current product, where that has one."""
    joined = _with_banks(master, src)
    for column, news in (("BankKey", "newbankkey"), ("BankName", "newbankname")):
        joined = set_where(joined, column, F.col(news), F.col("newbankkey").isNotNull())
    return joined.select(*master.columns)
