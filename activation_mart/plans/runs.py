"""Initial build, daily add and daily update of the master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import RunWindow, ci_eq, in_window
from ..operators import (
    add_column,
    apply_inner,
    apply_left,
    keyed_patch,
    left_lookup,
    with_surrogate_key,
)
from ..session import settle
from ..sources import Sources
from .audits import BLOCK_COLUMNS, CHECK_COLUMNS
from .block import block_per_account
from .cards import BALANCE_COLUMNS, balance_patch, card_resolution, cards_of
from .changes import CHECK, RATING, STATUS, all_changes, changed_accounts
from .checks import internal_lookup, may_be_internal, quiz_column, refresh_bank, with_check_facts
from .extract import latest_signups, new_only
from .identity import latest_check
from .online import failure_flags, online_step, online_steps
from .retail import refund_flags, retail_customers, retail_step, retail_steps

CHECK_PATCH_COLUMNS, BLOCK_PATCH_COLUMNS = CHECK_COLUMNS, BLOCK_COLUMNS


def assemble(
    signups: DataFrame,
    src: Sources,
    block_window: RunWindow,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
    restrict: bool = False,
) -> DataFrame:
    """Master rows of sign-ups, which hold one row per account.

    All four inputs come out of aggregates by account and join without another
    shuffle. ``restrict`` looks up the given accounts only, for small sets.
    """
    accounts = signups if restrict else None
    checked = apply_left(signups, latest_check(src, accounts), "AccountKey")
    blocked = apply_left(checked, block_per_account(src, block_window, cfg=cfg), "AccountKey")
    carded = apply_inner(blocked, card_resolution(src, cfg, accounts), "AccountKey")
    rows = carded.select(*config.MASTER_COLUMNS)
    for column in (config.STEP_COLUMN, config.QUIZ_COLUMN):
        rows = add_column(rows, column, "string")
    return rows


def build_initial(
    src: Sources,
    window: RunWindow,
    block_window: RunWindow | None = None,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
) -> DataFrame:
    """First master, numbered by account; the block window may differ from the sign-up window.

    One row per account by construction, hence no pass to remove equal rows.
    """
    signups = latest_signups(src, window, cfg)
    rows = assemble(signups, src, block_window or window, cfg)
    return with_surrogate_key(rows, config.SURROGATE_COLUMN, ["AccountKey"])


def classify(
    accounts: DataFrame,
    src: Sources,
    *,
    online: Column,
    retail: Column,
    quiz: Column,
    internal: Column,
    fill_online: bool,
    settled: bool = False,
) -> DataFrame:
    """Set step, quiz result and internal tag where the four scopes allow.

    Everything looked up is one row per identity check or per card, so accounts
    are shuffled twice however many of these facts there are. ``settled``
    accounts are cheap to read again, and the fact tables are cut to their keys
    first.
    """
    checks = accounts.select("LastIdentityValidationKey") if settled else None
    cards = accounts.select("VCustomerkey") if settled else None
    customers = retail_customers(src, cards).withColumn("customer_found", F.lit(True))
    facts = left_lookup(
        with_check_facts(
            accounts.withColumns(
                {"__online": online, "__retail": retail, "__quiz": quiz, "__internal": internal}
            ),
            src,
            checks,
        ),
        [customers, refund_flags(src, cards), failure_flags(src, cards)],
        "VCustomerkey", "CustomerKey", "AccountKey",
    )
    step = F.col(config.STEP_COLUMN)
    publish_online = F.expr("__online AND Activation_step IS NULL" if fill_online else "__online")
    stepped = facts.withColumn(
        config.STEP_COLUMN,
        F.when(publish_online, online_step())
        .when(F.expr("__retail AND customer_found"), retail_step())
        .otherwise(step),
    )
    tagged = (
        F.expr("__internal AND internal_check")
        & may_be_internal()
        & ci_eq("VerificationStatusType", config.APPROVED)
    )
    return stepped.withColumns(
        {
            config.QUIZ_COLUMN: F.expr("CASE WHEN __quiz AND quiz_taken THEN quiz_result ELSE OOW END"),
            "LastAttemptValue": F.when(tagged, config.INTERNAL_TAG).otherwise(
                F.col("LastAttemptValue")
            ),
        }
    ).select(*accounts.columns)


def _is(channel: str) -> Column:
    return ci_eq("Channel", channel)


def backfill(master: DataFrame, src: Sources, online_window: RunWindow) -> DataFrame:
    """Classify a first master: online accounts of the window, all retail ones; refresh banks."""
    classified = classify(
        master, src,
        online=_is(config.ONLINE) & in_window("CreateDate", online_window),
        retail=_is(config.RETAIL),
        quiz=F.lit(True),
        internal=F.lit(True),
        fill_online=True,
    )
    return refresh_bank(classified, src)


def backfill_online(master: DataFrame, src: Sources, window: RunWindow) -> DataFrame:
    """Step of the window's online accounts that have none."""
    accounts = master.filter(_is(config.ONLINE) & in_window("CreateDate", window))
    steps = online_steps(accounts, src)
    return keyed_patch(master, steps, "AccountKey", [config.STEP_COLUMN], "fill_null", once=True)


def backfill_retail(master: DataFrame, src: Sources) -> DataFrame:
    """Step of all retail accounts, NULL where no rung holds."""
    steps = retail_steps(master.filter(_is(config.RETAIL)), src)
    return keyed_patch(master, steps, "AccountKey", [config.STEP_COLUMN], once=True)


def backfill_quiz(master: DataFrame, src: Sources) -> DataFrame:
    """Quiz result of all accounts whose check had a quiz."""
    return keyed_patch(master, quiz_column(master, src), "AccountKey", [config.QUIZ_COLUMN], once=True)


def tag_internal(master: DataFrame, src: Sources) -> DataFrame:
    """Tag of all accounts approved by the internal look-up."""
    return keyed_patch(master, internal_lookup(master, src), "AccountKey", ["LastAttemptValue"], once=True)


def run_add(
    src: Sources,
    master: DataFrame,
    window: RunWindow,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
) -> DataFrame:
    """Master after adding the window's new accounts and classifying what is open.

    Only new accounts, accounts of the window and unclassified online accounts
    are looked up; all others pass from scan to result without a shuffle.
    """
    signups = settle(new_only(latest_signups(src, window, cfg), master), "signups")
    rows = assemble(signups, src, window, cfg, restrict=True)
    if config.SURROGATE_COLUMN in master.columns:
        last = master.agg(F.max(config.SURROGATE_COLUMN)).first()[0] or 0
        rows = with_surrogate_key(rows, config.SURROGATE_COLUMN, ["AccountKey"], last + 1)
    recent = in_window("CreateDate", window)
    open_online = _is(config.ONLINE) & F.col(config.STEP_COLUMN).isNull()
    touched = F.coalesce(recent | open_online, F.lit(False))
    accounts = settle(
        master.filter(touched).unionByName(rows, allowMissingColumns=True), "open-accounts"
    )
    classified = classify(
        accounts, src,
        online=open_online,
        retail=_is(config.RETAIL) & recent,
        quiz=recent,
        internal=recent,
        fill_online=True,
        settled=True,
    )
    return master.filter(~touched).unionByName(classified)


def run_update(
    src: Sources,
    master: DataFrame,
    window: RunWindow,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
) -> DataFrame:
    """Master after refreshing the accounts that changed in the window.

    Order matters: checks set the card keys that balances and steps read, and
    may reset the last attempt value before the internal tag is set again.
    Customers are read four times, whatever changed: for the changes, once for
    all cards of the changed accounts, and by key for steps and for balances.
    """
    changes = settle(all_changes(src, window), "changes")
    accounts = settle(changed_accounts(changes), "changed-accounts")
    touched = master.join(accounts, "AccountKey")
    untouched = master.join(accounts, "AccountKey", "left_anti")  # keyless rows among them

    held = cards_of(src, accounts)
    checked = _patch_checks(touched, accounts.filter(CHECK), held, cfg)
    blocks = block_per_account(held, customers=changes.filter(RATING), cfg=cfg)
    blocked = settle(
        keyed_patch(checked, blocks, "AccountKey", BLOCK_PATCH_COLUMNS, once=True), "changed-master"
    )
    rechecked = F.col("__rechecked")
    classified = classify(
        blocked, src,
        online=_is(config.ONLINE) & rechecked,
        retail=_is(config.RETAIL) & rechecked,
        quiz=rechecked,
        internal=rechecked,
        fill_online=False,
        settled=True,
    )
    # No step looks at a balance, so these come last; they read the cards that the checks have set.
    balances = balance_patch(blocked.filter(STATUS), src)
    balanced = keyed_patch(classified, balances, "AccountKey", BALANCE_COLUMNS, once=True)
    return untouched.unionByName(balanced.select(*master.columns))


def _patch_checks(
    accounts: DataFrame, rechecked: DataFrame, src: Sources, cfg: config.MartConfig
) -> DataFrame:
    fresh = apply_inner(
        latest_check(src, rechecked), card_resolution(src, cfg, rechecked), "AccountKey"
    )
    return keyed_patch(
        accounts, fresh, "AccountKey", CHECK_PATCH_COLUMNS, where=CHECK, flag="__rechecked", once=True
    )
