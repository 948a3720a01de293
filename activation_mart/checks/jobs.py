"""Account look-ups, classification, patches, runs and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import RunWindow
from ..operators import apply_left, drift, keyed_patch, latest_with_ties, repeated_rows
from ..plans import backfill, build_initial, run_add, run_update
from ..plans.audits import (
    DRIFT_PARTS,
    address_check,
    drift_report,
    duplicate_audit,
    exceptions,
    failed_then_approved,
    repeated_cards,
    step_distribution,
    unresolved,
)
from ..plans.block import block_attribution, block_per_account
from ..plans.cards import balance_patch, card_resolution
from ..plans.changes import changed_checks, changed_ratings, changed_status
from ..plans.checks import (
    bank_changes,
    failed_quiz_rows,
    internal_lookup,
    quiz_column,
    refresh_bank,
)
from ..plans.extract import account_extract, latest_signups, new_only
from ..plans.identity import latest_check
from ..plans.online import all_failures, failure_facts, online_steps, reclassified_failures
from ..plans.retail import (
    TRACKER,
    retail_candidates,
    retail_quiz_override,
    retail_steps,
    retail_waterfall,
)
from ..plans.runs import BLOCK_PATCH_COLUMNS, CHECK_PATCH_COLUMNS, assemble
from ..sources.standin import (
    ADD_WINDOW,
    CONFIG,
    INITIAL_BLOCK_WINDOW,
    INITIAL_WINDOW,
    UPDATE_WINDOW,
)
from .fragments import (
    BALANCE_PATCH,
    BLOCK_PATCH,
    FRAGMENTS,
    MASTER,
    SIGNUP,
    balances,
    patched,
)
from .registry import check


def _online(t):
    return t.master.filter(F.col("Channel") == config.ONLINE)


def _retail(t):
    return t.master.filter(F.col("Channel") == config.RETAIL)


@check("t01_latest_check", "SELECT * FROM x_check")
def _(t):
    return latest_check(t.sources)


@check("t02_card_resolution", "SELECT * FROM x_cards")
def _(t):
    return card_resolution(t.sources, CONFIG)


@check("t03_daily_add", "SELECT * FROM x_add_4")
def _(t):
    return run_add(t.sources, t.master, ADD_WINDOW, CONFIG)


@check("t03_daily_update", "SELECT * FROM x_update_4")
def _(t):
    return run_update(t.sources, t.master, UPDATE_WINDOW, CONFIG)


@check(
    "t03_initial_backfill",
    f"""SELECT row_number() OVER (ORDER BY m.AccountKey) AS Tablekey, m.* FROM (
        {patched("x_initial_4", "x_bank_now", {"BankKey": "p.newbankkey", "BankName": "p.newbankname"})}) m""",
)
def _(t):
    master = build_initial(t.sources, INITIAL_WINDOW, INITIAL_BLOCK_WINDOW, CONFIG)
    return backfill(master, t.sources, RunWindow.parse("10/1/1998", "10/25/1998"))


@check("d05_block_attribution", "SELECT * FROM x_attempt_initial")
def _(t):
    return block_attribution(t.sources, INITIAL_BLOCK_WINDOW, cfg=CONFIG)


@check(
    "d06_attach_block",
    f"""SELECT {SIGNUP}, BlockCreditratingkey, BlockDate, BlockUser
        FROM x_signup_initial LEFT JOIN x_block_initial USING (AccountKey)""",
)
def _(t):
    signups = latest_signups(t.sources, INITIAL_WINDOW, CONFIG)
    blocks = block_per_account(t.sources, INITIAL_BLOCK_WINDOW, cfg=CONFIG)
    return apply_left(signups, blocks, "AccountKey")


@check("d07_assemble_master", f"SELECT {MASTER} FROM x_rows_add")
def _(t):
    signups = new_only(latest_signups(t.sources, ADD_WINDOW, CONFIG), t.master)
    rows = assemble(signups, t.sources, ADD_WINDOW, CONFIG, restrict=True)
    return rows.select(*config.MASTER_COLUMNS)


@check("d08_failures", "SELECT * FROM x_held_fail")
def _(t):
    return failure_facts(_online(t), t.sources)


@check("d09_reclassify", "SELECT * FROM x_held_relabelled")
def _(t):
    return reclassified_failures(_online(t), t.sources)


@check(
    "d10_failed_quiz",
    """SELECT c.AccountKey, c.LastIdentityValidationKey, q.QuizResultCode, r.RiskValue
       FROM x_held_cust c
       JOIN src_quiz q ON q.IdentityValidationKey = c.LastIdentityValidationKey
       JOIN (SELECT IdentityValidationKey, max(RiskValue) AS RiskValue FROM src_risk GROUP BY ALL) r
         ON r.IdentityValidationKey = q.IdentityValidationKey
       WHERE lower(q.QuizResultCode) IN ('refer_incomplete', 'refer')""",
)
def _(t):
    accounts = _online(t).select("AccountKey", "LastIdentityValidationKey")
    return failed_quiz_rows(accounts, t.sources)


@check("d11_all_failures", "SELECT * FROM x_held_fail2")
def _(t):
    return all_failures(_online(t), t.sources)


@check("d12_online_waterfall", "SELECT * FROM x_held_onlinestep")
def _(t):
    return online_steps(_online(t), t.sources)


_STEP = {"Activation_step": "p.Activation_step"}


@check(
    "d13_publish_online",
    patched("src_account_master", "x_held_onlinestep", _STEP, "m.Activation_step IS NULL"),
)
def _(t):
    steps = online_steps(_online(t), t.sources)
    return keyed_patch(t.master, steps, "AccountKey", [config.STEP_COLUMN], "fill_null")


@check("d13_publish_online_overwrite", patched("src_account_master", "x_held_onlinestep", _STEP))
def _(t):
    steps = online_steps(_online(t), t.sources)
    return keyed_patch(t.master, steps, "AccountKey", [config.STEP_COLUMN])


@check(
    "d15_retail_candidates",
    """SELECT AccountKey, VCustomerkey, FirstName IS NOT NULL AS has_first_name,
           LastName IS NOT NULL AS has_last_name, SSN IS NOT NULL AS has_ssn,
           ParentFirstName IS NOT NULL AS has_parent_first_name,
           ParentLastName IS NOT NULL AS has_parent_last_name, ParentSSN IS NOT NULL AS has_parent_ssn,
           ParentDOB IS NOT NULL AS has_parent_dob, CH_Age, Parent_Age, refundreasonkey, refundreason,
           comment, activationstatuskey, ActivationSysUserKey, SysUserKey, activationstatus
       FROM x_held_retail""",
)
def _(t):
    return retail_candidates(_retail(t), t.sources).select(
        "AccountKey", "VCustomerkey", "has_first_name", "has_last_name", "has_ssn",
        "has_parent_first_name", "has_parent_last_name", "has_parent_ssn", "has_parent_dob",
        "CH_Age", "Parent_Age", "refundreasonkey", "refundreason", "comment",
        "activationstatuskey", "ActivationSysUserKey", "SysUserKey", "activationstatus",
    )


_TRACKED = ["AccountKey", "VCustomerkey", "refundreasonkey", "activationstatuskey", TRACKER]


@check("d16_retail_waterfall", f"SELECT {', '.join(_TRACKED)} FROM x_held_tracked")
def _(t):
    return retail_waterfall(retail_candidates(_retail(t), t.sources)).select(*_TRACKED)


@check("d17_retail_quiz_override", f"SELECT {', '.join(_TRACKED)} FROM x_held_overridden")
def _(t):
    tracked = retail_waterfall(retail_candidates(_retail(t), t.sources))
    return retail_quiz_override(tracked, t.sources).select(*_TRACKED)


@check("d18_publish_retail", patched("src_account_master", "x_held_retailstep", _STEP))
def _(t):
    steps = retail_steps(_retail(t), t.sources)
    return keyed_patch(t.master, steps, "AccountKey", [config.STEP_COLUMN])


@check(
    "d19_quiz_column",
    patched(
        "src_account_master",
        """(SELECT a.AccountKey, q.QuizResultCode FROM src_account_master a
            JOIN x_quiz_result q ON q.IdentityValidationKey = a.LastIdentityValidationKey)""",
        {"OOW": "p.QuizResultCode"},
    ),
)
def _(t):
    results = quiz_column(t.master, t.sources)
    return keyed_patch(t.master, results, "AccountKey", [config.QUIZ_COLUMN])


@check(
    "d20_internal_lookup",
    patched(
        "src_checked_master",
        """(SELECT a.AccountKey FROM src_checked_master a
            JOIN x_internal i ON i.IdentityValidationKey = a.LastIdentityValidationKey
            WHERE lower(Activation_step) = 'approved' AND LastAttemptValue IS NULL
              AND lower(rtrim(VerificationStatusType)) = 'approved')""",
        {"LastAttemptValue": "'Int'"},
    ),
)
def _(t):
    master = t["src_checked_master"]
    tags = internal_lookup(master, t.sources)
    return keyed_patch(master, tags, "AccountKey", ["LastAttemptValue"])


_BANK_NOW = """(SELECT m.AccountKey, m.BankKey, b.BankKey AS newbankkey, b.BankName AS newbankname
    FROM src_account_master m JOIN src_product p ON p.ProductKey = m.ProductKey
    JOIN src_bank b ON b.BankKey = p.BankKey)"""


@check(
    "d21_bank_refresh",
    patched("src_account_master", _BANK_NOW, {"BankKey": "p.newbankkey", "BankName": "p.newbankname"}),
)
def _(t):
    return refresh_bank(t.master, t.sources)


@check(
    "d21_bank_preview",
    f"SELECT AccountKey, BankKey, newbankkey, newbankname FROM {_BANK_NOW} WHERE BankKey <> newbankkey",
)
def _(t):
    return bank_changes(t.master, t.sources).select(
        "AccountKey", "BankKey", "newbankkey", "newbankname"
    )


@check("d22_changed_checks", "SELECT * FROM x_changed_checks")
def _(t):
    return changed_checks(t.sources, UPDATE_WINDOW)


@check("d23_changed_ratings", "SELECT * FROM x_changed_ratings")
def _(t):
    return changed_ratings(t.sources, UPDATE_WINDOW)


@check("d24_changed_status", "SELECT * FROM x_changed_status")
def _(t):
    return changed_status(t.sources, UPDATE_WINDOW)


@check("d25_patch_identity", FRAGMENTS["x_checked"])
def _(t):
    changed = changed_checks(t.sources, UPDATE_WINDOW)
    fresh = latest_check(t.sources, changed).join(
        card_resolution(t.sources, CONFIG, changed), "AccountKey"
    )
    return keyed_patch(t.master, fresh, "AccountKey", CHECK_PATCH_COLUMNS)


@check("d26_patch_block", patched("src_account_master", "x_block_update", BLOCK_PATCH))
def _(t):
    changed = changed_ratings(t.sources, UPDATE_WINDOW)
    blocks = block_per_account(t.sources, customers=changed, cfg=CONFIG)
    return keyed_patch(t.master, blocks, "AccountKey", BLOCK_PATCH_COLUMNS)


@check(
    "d27_patch_balance",
    patched("src_account_master", f"({balances('src_account_master')})", BALANCE_PATCH),
)
def _(t):
    changed = t.master.join(changed_status(t.sources, UPDATE_WINDOW), "AccountKey", "left_semi")
    return keyed_patch(
        t.master, balance_patch(changed, t.sources), "AccountKey", list(BALANCE_PATCH)
    )


_KEPT = """(SELECT * EXCLUDE (r) FROM (
        SELECT *, dense_rank() OVER (PARTITION BY AccountKey ORDER BY CreateDate DESC) AS r
        FROM x_extract_initial) WHERE r = 1)"""
_REPEATED = f"(SELECT AccountKey, count(*) AS cnt FROM {_KEPT} GROUP BY AccountKey HAVING count(*) > 1)"


def _kept(t):
    """Latest sign-ups with ties, as a master that keeps them would hold them."""
    return latest_with_ties(
        account_extract(t.sources, INITIAL_WINDOW, CONFIG), "AccountKey", "CreateDate"
    )


@check(
    "d28_duplicate_audit",
    f"""SELECT c.AccountKey, c.CustomerKey, c.ProductKey, c.CreateDate, c.CreditRatingKey, d.cnt,
           p.BankKey, p.isOnlineProduct, p.isatm
       FROM {_REPEATED} d
       JOIN src_customer c ON c.AccountKey = d.AccountKey
       JOIN src_product p ON p.ProductKey = c.ProductKey""",
)
def _(t):
    return duplicate_audit(_kept(t), t.sources)


@check(
    "d28_duplicate_rows",
    f"SELECT * FROM {_KEPT} WHERE AccountKey IN (SELECT AccountKey FROM {_REPEATED})",
)
def _(t):
    return repeated_rows(_kept(t), "AccountKey")


@check(
    "d28_duplicate_resolved_cards",
    f"SELECT * FROM x_cards WHERE AccountKey IN (SELECT AccountKey FROM {_REPEATED})",
)
def _(t):
    return repeated_cards(_kept(t), t.sources, CONFIG)


@check(
    "d30_step_distribution",
    "SELECT Channel, Activation_step, count(*) AS cnt FROM src_account_master GROUP BY Channel, Activation_step",
)
def _(t):
    return step_distribution(t.master)


@check(
    "d31_address_check",
    """SELECT c.AccountKey, r1.MatchLevel AS qas_1, r2.MatchLevel AS qas_2,
           CASE WHEN lower(r1.MatchLevel) = 'verified' AND lower(r2.MatchLevel) = 'verified' THEN 'VERIFIED'
                WHEN lower(r1.MatchLevel) = 'verified' AND r2.MatchLevel IS NULL THEN 'VERIFIED'
                WHEN r1.MatchLevel IS NULL AND lower(r2.MatchLevel) = 'verified' THEN 'VERIFIED'
                WHEN r1.MatchLevel IS NULL AND r2.MatchLevel IS NULL THEN 'VERIFIED' END AS qas,
           date_diff('hour', a1.CreateDate, a2.CreateDate) AS hours_between
       FROM (SELECT AccountKey FROM x_held_tracked WHERE ACTIVATION_TRACKER IS NULL) c
       LEFT JOIN x_address a1 ON a1.AccountKey = c.AccountKey AND a1.addressTypekey = 2 AND a1.rn = 1
       LEFT JOIN src_address_result r1
         ON r1.AddressStandardizationResultKey = a1.AddressStandardizationResultKey
       LEFT JOIN x_address a2 ON a2.AccountKey = c.AccountKey AND a2.addressTypekey = 1 AND a2.rn = 1
       LEFT JOIN src_address_result r2
         ON r2.AddressStandardizationResultKey = a2.AddressStandardizationResultKey""",
)
def _(t):
    tracked = retail_waterfall(retail_candidates(_retail(t), t.sources))
    unclassified = tracked.filter(F.col(TRACKER).isNull()).select("AccountKey")
    return address_check(unclassified, t.sources).select(
        "AccountKey", "qas_1", "qas_2", "qas", "hours_between"
    )


@check(
    "d32_drift",
    """SELECT m.AccountKey, m.BlockCreditratingkey, m.BlockDate, b.BlockCreditratingkey AS new_BlockCreditratingkey,
           b.BlockDate AS new_BlockDate
       FROM src_account_master m JOIN x_block_initial b ON b.AccountKey = m.AccountKey
       WHERE m.BlockCreditratingkey <> b.BlockCreditratingkey OR m.BlockDate <> b.BlockDate""",
)
def _(t):
    fresh = block_per_account(t.sources, INITIAL_BLOCK_WINDOW, cfg=CONFIG)
    return drift(t.master, fresh, "AccountKey", ["BlockCreditratingkey", "BlockDate"])


def _changes(differs: str) -> str:
    """Differing values of the three parts in long form, column by column."""
    fresh = {
        "identity": "x_fresh", "block": "x_block_update",
        "balance": f"({balances('src_account_master')})",
    }
    return " UNION ALL ".join(
        f"""SELECT m.AccountKey, '{part}' AS part, '{c}' AS field, CAST(m.{c} AS VARCHAR) AS old_value,
            CAST(p.{c} AS VARCHAR) AS new_value
        FROM src_account_master m JOIN {fresh[part]} p ON p.AccountKey = m.AccountKey
        WHERE m.{c} {differs} p.{c}"""
        for part, columns in DRIFT_PARTS.items()
        for c in columns
    )


@check("d32_drift_parts", _changes("<>"))
def _(t):
    return drift_report(t.master, t.sources, UPDATE_WINDOW, CONFIG)


@check("d32_drift_parts_null_safe", _changes("IS DISTINCT FROM"))
def _(t):
    return drift_report(t.master, t.sources, UPDATE_WINDOW, CONFIG, null_safe=True)


@check(
    "d33_unresolved",
    """SELECT f.* FROM x_held_fail f JOIN x_held_onlinestep s ON s.AccountKey = f.AccountKey
       WHERE s.Activation_step = 'Incomplete'""",
)
def _(t):
    return unresolved(_online(t), t.sources)


@check(
    "d34_exceptions",
    """SELECT AccountKey, Channel, CardActivationDate FROM src_account_master
       WHERE VerificationStatusType IS NULL AND lower(Activation_step) = 'approved'
         AND CardActivationDate IS NOT NULL""",
)
def _(t):
    return exceptions(t.master).select("AccountKey", "Channel", "CardActivationDate")


@check(
    "d35_failed_then_approved",
    """SELECT * FROM x_held_fail2 WHERE AccountKey IN (
           SELECT AccountKey FROM x_held_online
           WHERE lower(rtrim(VerificationStatusType)) = 'approved' AND CardActivationDate IS NOT NULL)""",
)
def _(t):
    return failed_then_approved(_online(t), t.sources)
