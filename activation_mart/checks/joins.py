"""Joins, anti joins and applied look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import apply_inner, apply_left, null_aware_anti
from ..plans.block import latest_blocks
from ..plans.cards import balance_patch, card_resolution
from ..plans.extract import account_extract, latest_signups, new_only
from ..plans.identity import latest_check
from ..sources.standin import ADD_WINDOW, CONFIG, INITIAL_BLOCK_WINDOW, INITIAL_WINDOW
from .fragments import SIGNUP
from .registry import check


@check(
    "j01_inner_chain",
    """SELECT a.CustomerKey, c.AccountKey, a.ActivationActivityTypeKey, t.ActivationActivityType, p.BankKey
       FROM src_activation_activity a
       JOIN src_activation_activity_type t ON t.ActivationActivityTypeKey = a.ActivationActivityTypeKey
       JOIN src_customer c ON c.CustomerKey = a.CustomerKey
       JOIN src_product p ON p.ProductKey = c.ProductKey""",
)
def _(t):
    src = t.sources
    return (
        src["activation_activity"]
        .join(src["activation_activity_type"], "ActivationActivityTypeKey")
        .join(src["customer"].select("CustomerKey", "AccountKey", "ProductKey"), "CustomerKey")
        .join(src["product"].select("ProductKey", "BankKey"), "ProductKey")
        .select(
            "CustomerKey", "AccountKey", "ActivationActivityTypeKey", "ActivationActivityType",
            "BankKey",
        )
    )


@check(
    "j02_left",
    """SELECT r.CustomerKey, r.refundreasonkey, f.refundreason FROM src_refund r
       LEFT JOIN src_refund_reason f ON f.refundreasonkey = r.refundreasonkey""",
)
def _(t):
    return (
        t.sources["refund"]
        .join(t.sources["refund_reason"], "refundreasonkey", "left")
        .select("CustomerKey", "refundreasonkey", "refundreason")
    )


@check(
    "j03_left_on_pred",
    """SELECT s.AccountKey, s.CreateDate, a.CreditRatingKey, a.ChangeDate, a.FullName
       FROM x_signup_initial s LEFT JOIN x_attempt_initial a
         ON a.AccountKey = s.AccountKey AND a.attempt = 1""",
)
def _(t):
    signups = latest_signups(t.sources, INITIAL_WINDOW, CONFIG)
    first = latest_blocks(t.sources, INITIAL_BLOCK_WINDOW, cfg=CONFIG)
    return signups.join(first, "AccountKey", "left").select(
        "AccountKey", "CreateDate", "CreditRatingKey", "ChangeDate", "FullName"
    )


@check(
    "j04_composite",
    """SELECT c.AccountKey, h.CustomerKey, h.CreditRatingKey, h.ChangeDate
       FROM src_rating_history h JOIN src_customer c
         ON c.CustomerKey = h.CustomerKey AND c.CreditRatingKey = h.CreditRatingKey""",
)
def _(t):
    cards = t.sources["customer"].select("AccountKey", "CustomerKey", "CreditRatingKey")
    return (
        t.sources["rating_history"]
        .join(cards, ["CustomerKey", "CreditRatingKey"])
        .select("AccountKey", "CustomerKey", "CreditRatingKey", "ChangeDate")
    )


@check(
    "j05_role_playing",
    """SELECT m.AccountKey, p.CreditRatingKey AS PCreditRatingkey, p.CurrBalance AS PCurrBalance,
           t.CreditRatingKey AS TCreditRatingkey, t.CurrBalance AS TCurrBalance
       FROM src_account_master m
       JOIN src_customer p ON p.CustomerKey = m.PCustomerkey
       JOIN src_customer t ON t.CustomerKey = m.TCustomerkey""",
)
def _(t):
    return balance_patch(t.master, t.sources)


@check(
    "j06_anti",
    """SELECT c.CustomerKey, c.CreateDate FROM src_customer c
       WHERE NOT EXISTS (SELECT 1 FROM src_refund r WHERE r.CustomerKey = c.CustomerKey)""",
)
def _(t):
    return (
        t.sources["customer"]
        .select("CustomerKey", "CreateDate")
        .join(t.sources["refund"].select("CustomerKey").distinct(), "CustomerKey", "left_anti")
    )


@check(
    "j06_null_aware_anti",
    """SELECT 'no null' AS variant, CustomerKey, AccountKey FROM src_customer
       WHERE AccountKey NOT IN (SELECT AccountKey FROM src_account_master)
       UNION ALL
       SELECT 'with null', CustomerKey, AccountKey FROM src_customer
       WHERE AccountKey NOT IN (SELECT AccountKey FROM src_customer WHERE CreditRatingKey = 'B5')
       UNION ALL
       SELECT 'empty', CustomerKey, AccountKey FROM src_customer
       WHERE AccountKey NOT IN (SELECT AccountKey FROM src_customer WHERE CreditRatingKey = 'none')""",
)
def _(t):
    customers = t.sources["customer"].select("CustomerKey", "AccountKey", "CreditRatingKey")
    rights = {
        "no null": t.master,
        "with null": customers.filter(F.col("CreditRatingKey") == "B5"),
        "empty": customers.filter(F.col("CreditRatingKey") == "none"),
    }
    out = None
    for variant, right in rights.items():
        rows = null_aware_anti(customers, right, "AccountKey").select(
            F.lit(variant).alias("variant"), "CustomerKey", "AccountKey"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@check(
    "j07_semi",
    """SELECT CustomerKey, ChangeDate, CreditRatingKey FROM src_rating_history
       WHERE CustomerKey IN (SELECT CustomerKey FROM src_refund)""",
)
def _(t):
    return (
        t.sources["rating_history"]
        .select("CustomerKey", "ChangeDate", "CreditRatingKey")
        .join(t.sources["refund"].select("CustomerKey").distinct(), "CustomerKey", "left_semi")
    )


_SIGNUP_CARDS = "AccountKey, CreateDate, Channel, TCustomerkey, PCustomerkey, VCustomerkey"


@check(
    "j08_lateral_inner",
    f"SELECT {_SIGNUP_CARDS} FROM x_signup_initial JOIN x_cards USING (AccountKey)",
)
def _(t):
    signups = latest_signups(t.sources, INITIAL_WINDOW, CONFIG)
    return apply_inner(signups, card_resolution(t.sources, CONFIG), "AccountKey").select(
        *_SIGNUP_CARDS.split(", ")
    )


_SIGNUP_CHECKS = f"{SIGNUP}, LastIdentityValidationKey, VerificationStatusType, LastAttemptValue"


@check(
    "j09_lateral_left",
    f"SELECT {_SIGNUP_CHECKS} FROM x_signup_add LEFT JOIN x_check USING (AccountKey)",
)
def _(t):
    signups = new_only(
        latest_signups(t.sources, ADD_WINDOW, CONFIG), t.master
    )
    return apply_left(signups, latest_check(t.sources), "AccountKey").select(
        *_SIGNUP_CHECKS.split(", ")
    )


@check("d02_new_only", f"SELECT {SIGNUP} FROM x_extract_new")
def _(t):
    return new_only(account_extract(t.sources, ADD_WINDOW, CONFIG), t.master).select(
        *SIGNUP.split(", ")
    )


@check("d03_latest_signup", "SELECT * FROM x_signup_initial")
def _(t):
    return latest_signups(t.sources, INITIAL_WINDOW, CONFIG)


@check(
    "d04_attach_check",
    f"SELECT {_SIGNUP_CHECKS} FROM x_signup_initial LEFT JOIN x_check USING (AccountKey)",
)
def _(t):
    signups = latest_signups(t.sources, INITIAL_WINDOW, CONFIG)
    return apply_left(signups, latest_check(t.sources), "AccountKey").select(
        *_SIGNUP_CHECKS.split(", ")
    )
