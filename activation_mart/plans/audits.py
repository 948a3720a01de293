"""Reports and checks on the master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import RunWindow, address_verified, ci_eq, hour_boundaries, in_window
from ..operators import apply_inner, drift_by_column, duplicates, latest_one
from ..session import settle
from ..sources import Sources
from .block import block_per_account
from .cards import BALANCE_COLUMNS, balance_patch, card_resolution, cards_of
from .changes import CHECK, RATING, STATUS, all_changes, changed_accounts
from .identity import latest_check
from .online import IS_APPROVED, all_failures, failure_facts, online_steps


def online_accounts(master: DataFrame, window: RunWindow | None = None) -> DataFrame:
    """Online accounts, of all times or signed up in a window."""
    accounts = master.filter(ci_eq("Channel", config.ONLINE))
    return accounts if window is None else accounts.filter(in_window("CreateDate", window))


def failure_report(accounts: DataFrame, src: Sources, bank: int) -> DataFrame:
    """Accounts per month and kind of failure, for one bank."""
    mine = accounts.filter(F.col("BankKey") == bank)
    return (
        all_failures(mine, src)
        .groupBy("Month_Year", "ActicationActivityOrder", "activityDesc")
        .agg(F.countDistinct("AccountKey").alias("Cnt"))
    )


def step_distribution(master: DataFrame) -> DataFrame:
    """Accounts per channel and step."""
    return master.groupBy("Channel", config.STEP_COLUMN).agg(F.count(F.lit(1)).alias("cnt"))


def duplicate_audit(rows: DataFrame, src: Sources) -> DataFrame:
    """Source cards, with product, of accounts that occur more than once in ``rows``."""
    repeated = duplicates(rows, ["AccountKey"])
    products = src["product"].select("ProductKey", "BankKey", "isOnlineProduct", "isatm")
    cards = src["customer"].select(
        "AccountKey", "CustomerKey", "ProductKey", "CreateDate", "CreditRatingKey"
    )
    return cards.join(repeated, "AccountKey").join(products, "ProductKey")


def repeated_cards(
    rows: DataFrame, src: Sources, cfg: config.MartConfig = config.DEFAULT_CONFIG
) -> DataFrame:
    """Resolved T, P and V card of accounts that occur more than once in ``rows``."""
    return card_resolution(src, cfg, duplicates(rows.select("AccountKey"), ["AccountKey"]))


CHECK_COLUMNS = (
    "LastIdentityValidationKey", "VerificationStatusType", "LastAttemptValue",
    "TCustomerkey", "PCustomerkey", "VCustomerkey", "CardActivationDate",
)
BLOCK_COLUMNS = ("BlockCreditratingkey", "BlockDate", "BlockUser")
DRIFT_PARTS = {"identity": CHECK_COLUMNS, "block": BLOCK_COLUMNS, "balance": BALANCE_COLUMNS}


def drift_report(
    master: DataFrame,
    src: Sources,
    window: RunWindow,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
    null_safe: bool = False,
) -> DataFrame:
    """What an update over the window would change, value by value: identity, block and balance.

    Each part is looked up for the accounts with a change of its kind. Balances
    are those of the cards that the master names before the update. The three
    parts stand side by side, one row per account, and meet the master once.
    """
    changes = settle(all_changes(src, window), "changes")
    accounts = settle(changed_accounts(changes), "changed-accounts")
    held = cards_of(src, accounts)
    rechecked = accounts.filter(CHECK)
    restated = master.join(accounts.filter(STATUS), "AccountKey", "left_semi")
    parts = {
        "identity": apply_inner(
            latest_check(held, rechecked), card_resolution(held, cfg, rechecked), "AccountKey"
        ),
        "block": block_per_account(held, customers=changes.filter(RATING), cfg=cfg),
        "balance": balance_patch(restated, src),
    }
    fresh = accounts.select("AccountKey")
    for name, part in parts.items():
        columns = part.select("AccountKey", F.lit(True).alias(name), *DRIFT_PARTS[name])
        fresh = fresh.join(columns, "AccountKey", "left")
    return drift_by_column(master, fresh, "AccountKey", DRIFT_PARTS, null_safe)


def address_check(accounts: DataFrame, src: Sources) -> DataFrame:
    """Latest check of both addresses of accounts, the verdict and the hours between them."""
    out = accounts
    for name, kind in (("qas_1", config.RESIDENTIAL_ADDRESS), ("qas_2", config.MAILING_ADDRESS)):
        latest = latest_one(
            src["account_address"]
            .filter(F.col("addressTypekey") == kind)
            .select("AccountKey", "CreateDate", "AddressStandardizationResultKey"),
            "AccountKey",
            ["CreateDate", "AddressStandardizationResultKey"],
        )
        checks = (
            latest.join(src["address_result"], "AddressStandardizationResultKey", "left")
            .select(
                "AccountKey",
                F.col("MatchLevel").alias(name),
                F.col("CreateDate").alias(f"{name}_create_date"),
            )
        )
        out = out.join(checks, "AccountKey", "left")
    return out.withColumn("qas", address_verified("qas_1", "qas_2")).withColumn(
        "hours_between", hour_boundaries("qas_1_create_date", "qas_2_create_date")
    )


def unresolved(accounts: DataFrame, src: Sources) -> DataFrame:
    """Failed activities of online accounts that no rung explains."""
    open_accounts = online_steps(accounts, src, default=None).filter(
        F.col(config.STEP_COLUMN).isNull()
    )
    return failure_facts(accounts.join(open_accounts, "AccountKey", "left_semi"), src)


def exceptions(master: DataFrame) -> DataFrame:
    """Approved and activated accounts without a verification status."""
    return master.filter(
        F.col("VerificationStatusType").isNull()
        & ci_eq(config.STEP_COLUMN, config.APPROVED)
        & F.col("CardActivationDate").isNotNull()
    )


def failed_then_approved(accounts: DataFrame, src: Sources) -> DataFrame:
    """Failures of accounts that are approved by now."""
    return all_failures(accounts, src).join(
        accounts.filter(IS_APPROVED).select("AccountKey"), "AccountKey", "left_semi"
    )
