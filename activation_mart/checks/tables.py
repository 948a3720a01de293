"""Scans, table changes, projections and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..functions import (
    channel_label,
    ci_eq,
    ci_like,
    code_needs_trusted_user,
    exclude_patterns,
    has_all,
    in_window,
)
from ..operators import (
    add_column,
    append_new,
    keyed_patch,
    latest_one,
    set_where,
    with_surrogate_key,
)
from ..plans import build_initial
from ..plans.extract import SIGNUP_COLUMNS, account_extract, latest_signups
from ..plans.runs import assemble
from ..sources import activity_type_order
from ..sources.standin import ADD_WINDOW, CONFIG, INITIAL_BLOCK_WINDOW, INITIAL_WINDOW
from .fragments import MASTER, SIGNUP, STEP_COLUMNS, TRUSTED, within
from .registry import check


@check(
    "s01_scan",
    "SELECT CustomerKey, AccountKey, ProductKey, CreateDate, CreditRatingKey, CurrBalance FROM src_customer",
)
def _(t):
    return t.sources.get("customer").select(
        "CustomerKey", "AccountKey", "ProductKey", "CreateDate", "CreditRatingKey", "CurrBalance"
    )


@check(
    "s02_inline_lookup",
    """SELECT o.ActivationActivityTypeKey, o.ActicationActivityOrder, o.IsActive, o.ActivityTypeDesc,
           count(a.CustomerKey) AS activities
       FROM x_type_order o LEFT JOIN src_activation_activity a
         ON a.ActivationActivityTypeKey = o.ActivationActivityTypeKey
       GROUP BY ALL""",
)
def _(t):
    activities = (
        t.sources["activation_activity"]
        .groupBy("ActivationActivityTypeKey")
        .agg(F.count("CustomerKey").alias("activities"))
    )
    return (
        activity_type_order(t.spark)
        .drop("id")
        .join(activities, "ActivationActivityTypeKey", "left")
        .fillna(0, ["activities"])
    )


@check(
    "s04_append_new",
    f"""SELECT {MASTER}, Activation_step, OOW FROM src_account_master
        UNION ALL SELECT {MASTER}, {STEP_COLUMNS} FROM x_rows_add""",
)
def _(t):
    signups = latest_signups(t.sources, ADD_WINDOW, CONFIG)
    return append_new(t.master, assemble(signups, t.sources, ADD_WINDOW, CONFIG), "AccountKey")


_ORDER_PATCH = """(SELECT l_orderkey, nullif(l_linestatus, 'O') AS status FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_linestatus DESC) AS rn
    FROM lineitem) WHERE rn = 1)"""


def _order_patch(t):
    columns = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_linestatus"]
    latest = latest_one(t["lineitem"].select("l_orderkey", *columns), "l_orderkey", columns)
    return latest.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.nullif("l_linestatus", F.lit("O")).alias("o_orderstatus"),
    )


@check(
    "s05_patch_overwrite",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN l_orderkey IS NOT NULL THEN status ELSE o_orderstatus END
            AS o_orderstatus, o_orderdate
        FROM orders LEFT JOIN {_ORDER_PATCH} ON l_orderkey = o_orderkey""",
)
def _(t):
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return keyed_patch(orders, _order_patch(t), "o_orderkey", ["o_orderstatus"])


@check(
    "s06_patch_fill_null",
    f"""SELECT o_orderkey, o_custkey, coalesce(nullif(o_orderstatus, 'P'), status) AS o_orderstatus, o_orderdate
        FROM orders LEFT JOIN {_ORDER_PATCH} ON l_orderkey = o_orderkey""",
)
def _(t):
    orders = t["orders"].select(
        "o_orderkey", "o_custkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), "o_orderdate",
    )
    return keyed_patch(orders, _order_patch(t), "o_orderkey", ["o_orderstatus"], "fill_null")


@check(
    "s07_set_where",
    """SELECT AccountKey, CASE WHEN VerificationStatusType <> 'Declined' THEN 'other' ELSE
            CASE WHEN Channel = 'Online' THEN 'declined online' ELSE Activation_step END END AS Activation_step
       FROM src_account_master""",
)
def _(t):
    rows = t.master.select("AccountKey", "Channel", "VerificationStatusType", config.STEP_COLUMN)
    rows = set_where(rows, config.STEP_COLUMN, "declined online", F.col("Channel") == "Online")
    rows = set_where(rows, config.STEP_COLUMN, "other", F.col("VerificationStatusType") != "Declined")
    return rows.select("AccountKey", config.STEP_COLUMN)


@check(
    "s08_add_column",
    "SELECT CustomerKey, CreateDate, CAST(NULL AS VARCHAR) AS ACTIVATION_TRACKER FROM src_customer",
)
def _(t):
    return add_column(
        t.sources["customer"].select("CustomerKey", "CreateDate"), "ACTIVATION_TRACKER", "string"
    )


@check(
    "s09_surrogate_key",
    """SELECT row_number() OVER (ORDER BY CreateDate, CustomerKey) AS Tablekey,
           CustomerKey, AccountKey, CreateDate FROM src_customer""",
)
def _(t):
    rows = t.sources["customer"].select("CustomerKey", "AccountKey", "CreateDate")
    return with_surrogate_key(rows, "Tablekey", ["CreateDate", "CustomerKey"])


@check(
    "s11_initial_build",
    f"""SELECT row_number() OVER (ORDER BY AccountKey) AS Tablekey, {MASTER}, {STEP_COLUMNS}
        FROM x_rows_initial""",
)
def _(t):
    return build_initial(t.sources, INITIAL_WINDOW, INITIAL_BLOCK_WINDOW, CONFIG)


@check(
    "p01_project",
    """SELECT CustomerKey AS card, AccountKey AS account, CurrBalance AS balance, 'card' AS kind,
           CASE WHEN DOB IS NULL THEN 'unknown' ELSE 'known' END AS birth FROM src_customer""",
)
def _(t):
    return t.sources["customer"].select(
        F.col("CustomerKey").alias("card"),
        F.col("AccountKey").alias("account"),
        F.col("CurrBalance").alias("balance"),
        F.lit("card").alias("kind"),
        F.when(F.col("DOB").isNull(), "unknown").otherwise("known").alias("birth"),
    )


@check(
    "p02_time_window",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
        WHERE {within('l_shipdate', ADD_WINDOW)}""",
)
def _(t):
    lines = t["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return lines.filter(in_window("l_shipdate", ADD_WINDOW))


@check(
    "p03_exclude_patterns",
    """SELECT CustomerKey, SecretWord, FirstName, LastName, Address1, Email FROM src_customer
       WHERE coalesce(SecretWord, '') NOT ILIKE 'probetest%' AND coalesce(FirstName, '') NOT ILIKE 'test%'
         AND coalesce(LastName, '') NOT ILIKE 'test%'
         AND coalesce(Address1, '') NOT ILIKE '%12 sample plaza%'
         AND coalesce(ResidentialAddress1, '') NOT ILIKE '%12 sample plaza%'
         AND coalesce(Email, '') NOT ILIKE '%@issuer.example%'""",
)
def _(t):
    return (
        t.sources["customer"]
        .filter(exclude_patterns(CONFIG.test_accounts.patterns()))
        .select("CustomerKey", "SecretWord", "FirstName", "LastName", "Address1", "Email")
    )


@check(
    "p04_ci_like",
    """SELECT CustomerKey, ActivationActivityTypeKey, ActivationActivityType
       FROM src_activation_activity JOIN src_activation_activity_type USING (ActivationActivityTypeKey)
       WHERE ActivationActivityType ILIKE '%VALIDATION%'""",
)
def _(t):
    types = t.sources["activation_activity_type"].filter(
        ci_like("ActivationActivityType", "%VALIDATION%")
    )
    return (
        t.sources["activation_activity"]
        .join(types, "ActivationActivityTypeKey")
        .select("CustomerKey", "ActivationActivityTypeKey", "ActivationActivityType")
    )


@check(
    "p05_const_eq",
    "SELECT CustomerKey, ActivationActivityTypeKey FROM src_activation_activity WHERE ActivationTypeKey = 2",
)
def _(t):
    return (
        t.sources["activation_activity"]
        .filter(F.col("ActivationTypeKey") == config.ONLINE_ACTIVATION_TYPE)
        .select("CustomerKey", "ActivationActivityTypeKey")
    )


@check(
    "p06_in_list",
    """SELECT CustomerKey, ChangeDate, CreditRatingKey FROM src_rating_history
       WHERE CreditRatingKey IN ('B5', 'P9', 'C5')""",
)
def _(t):
    return (
        t.sources["rating_history"]
        .filter(F.col("CreditRatingKey").isin(*config.LATEST_BLOCK_CODES))
        .select("CustomerKey", "ChangeDate", "CreditRatingKey")
    )


@check(
    "p07_nested_bool",
    f"""SELECT CustomerKey, ChangeDate, CreditRatingKey, SysUserKey FROM src_rating_history
        WHERE CreditRatingKey IN ('B5', 'P9', 'B3')
           OR (CreditRatingKey = 'C5' AND SysUserKey IN ({TRUSTED}))""",
)
def _(t):
    return t.sources["rating_history"].filter(
        code_needs_trusted_user(
            "CreditRatingKey", "SysUserKey", config.OPEN_BLOCK_CODES,
            config.RESTRICTED_BLOCK_CODE, config.TRUSTED_BLOCK_USERS,
        )
    )


@check(
    "p08_completeness",
    """SELECT CustomerKey, FirstName, LastName, DOB FROM src_customer
       WHERE (FirstName IS NOT NULL OR ParentFirstName IS NOT NULL)
         AND (LastName IS NOT NULL OR ParentLastName IS NOT NULL)
         AND (DOB IS NOT NULL OR ParentDOB IS NOT NULL) AND (SSN IS NOT NULL OR ParentSSN IS NOT NULL)
         AND (CellPhone IS NOT NULL OR HomePhone IS NOT NULL)
         AND ResidentialAddress1 IS NOT NULL AND ResidentialZipcode IS NOT NULL""",
)
def _(t):
    groups = [
        ("FirstName", "ParentFirstName"), ("LastName", "ParentLastName"), ("DOB", "ParentDOB"),
        ("SSN", "ParentSSN"), ("CellPhone", "HomePhone"), ("ResidentialAddress1",),
        ("ResidentialZipcode",),
    ]
    return t.sources["customer"].filter(has_all(groups)).select(
        "CustomerKey", "FirstName", "LastName", "DOB"
    )


@check(
    "p09_not_equal",
    """SELECT IdentityValidationKey, VerificationStatusType FROM src_identity_validation
       WHERE VerificationStatusType <> 'Approved'""",
)
def _(t):
    return (
        t.sources["identity_validation"]
        .filter(F.col("VerificationStatusType") != "Approved")
        .select("IdentityValidationKey", "VerificationStatusType")
    )


@check(
    "p10_ci_eq",
    """SELECT IdentityValidationKey, VerificationStatusType FROM src_identity_validation
       WHERE lower(rtrim(VerificationStatusType)) = 'approved'""",
)
def _(t):
    return (
        t.sources["identity_validation"]
        .filter(ci_eq("VerificationStatusType", "approved"))
        .select("IdentityValidationKey", "VerificationStatusType")
    )


@check(
    "f04_case",
    """SELECT CustomerKey, ProductKey, CASE WHEN isOnlineProduct = true THEN 'Online' ELSE 'Retail' END AS Channel
       FROM src_customer JOIN src_product USING (ProductKey)""",
)
def _(t):
    return (
        t.sources["customer"]
        .join(t.sources["product"], "ProductKey")
        .select("CustomerKey", "ProductKey", channel_label("isOnlineProduct").alias("Channel"))
    )


@check("d01_account_extract", f"SELECT {SIGNUP} FROM x_extract_initial")
def _(t):
    return account_extract(t.sources, INITIAL_WINDOW, CONFIG).select(*SIGNUP_COLUMNS)
