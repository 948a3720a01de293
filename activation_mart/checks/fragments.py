"""SQL building blocks of the oracles, stated row by row and step by step.

They do not follow the shape of the Spark code: where that aggregates facts
first, these join all rows and pick afterwards.
"""

from __future__ import annotations

from .. import config
from ..functions import RunWindow
from ..sources.standin import (
    ADD_WINDOW,
    INITIAL_BLOCK_WINDOW,
    INITIAL_WINDOW,
    REPORT_BANK,
    UPDATE_WINDOW,
)

FRAGMENTS: dict[str, str] = {}

MASTER = ", ".join(config.MASTER_COLUMNS)
SIGNUP = "AccountKey, CreateDate, BankKey, BankName, Channel"
TRUSTED = ", ".join(map(str, config.TRUSTED_BLOCK_USERS))


def within(column: str, window: RunWindow) -> str:
    return f"({column} >= TIMESTAMP '{window.start}' AND {column} < TIMESTAMP '{window.end}')"


def patched(target: str, patch: str, columns: dict[str, str], condition: str = "true") -> str:
    """SELECT with ``columns`` of ``target`` replaced where ``patch`` has the account."""
    news = ", ".join(
        f"CASE WHEN p.AccountKey IS NOT NULL AND {condition} THEN {value} ELSE m.{column} END AS {column}"
        for column, value in columns.items()
    )
    return (
        f"SELECT m.* REPLACE ({news}) FROM {target} m "
        f"LEFT JOIN {patch} p ON p.AccountKey = m.AccountKey"
    )


# --- Extract, checks and cards -------------------------------------------------

FRAGMENTS["x_extract"] = """
    SELECT c.AccountKey, c.CustomerKey, c.CreateDate, p.BankKey, b.BankName,
        CASE WHEN p.isOnlineProduct = true THEN 'Online' ELSE 'Retail' END AS Channel
    FROM src_customer c
    JOIN src_product p ON c.ProductKey = p.ProductKey
    JOIN src_bank b ON p.BankKey = b.BankKey
    WHERE c.AccountKey IS NOT NULL AND p.ourcardtypekey = 1
      AND coalesce(c.SecretWord, '') NOT ILIKE 'PROBETEST%'
      AND coalesce(c.FirstName, '') NOT ILIKE 'test%'
      AND coalesce(c.LastName, '') NOT ILIKE 'test%'
      AND coalesce(c.Address1, '') NOT ILIKE '%12 sample plaza%'
      AND coalesce(c.ResidentialAddress1, '') NOT ILIKE '%12 sample plaza%'
      AND coalesce(c.Email, '') NOT ILIKE '%@issuer.example%'"""


def signup(source: str) -> str:
    return f"""
    SELECT {SIGNUP} FROM (
        SELECT *, row_number() OVER (
            PARTITION BY AccountKey ORDER BY CreateDate DESC, CustomerKey DESC) AS rn
        FROM {source}) WHERE rn = 1"""


FRAGMENTS["x_extract_initial"] = f"SELECT * FROM x_extract WHERE {within('CreateDate', INITIAL_WINDOW)}"
FRAGMENTS["x_signup_initial"] = signup("x_extract_initial")
FRAGMENTS["x_extract_add"] = f"SELECT * FROM x_extract WHERE {within('CreateDate', ADD_WINDOW)}"
FRAGMENTS["x_extract_new"] = """
    SELECT * FROM x_extract_add
    WHERE AccountKey NOT IN (SELECT AccountKey FROM src_account_master)"""
FRAGMENTS["x_signup_add"] = signup("x_extract_new")

FRAGMENTS["x_check"] = """
    SELECT AccountKey, IdentityValidationKey AS LastIdentityValidationKey,
        VerificationStatusType, LastAttemptValue
    FROM (
        SELECT c.AccountKey, v.IdentityValidationKey, v.VerificationStatusType, v.LastAttemptValue,
            row_number() OVER (PARTITION BY c.AccountKey
                ORDER BY v.CreateDate DESC, v.IdentityValidationKey DESC) AS rn
        FROM src_identity_validation v
        JOIN src_identity_validation_customer l ON l.IdentityValidationKey = v.IdentityValidationKey
        JOIN src_customer c ON c.CustomerKey = l.CustomerKey
        WHERE c.AccountKey IS NOT NULL) WHERE rn = 1"""

FRAGMENTS["x_card_rank"] = """
    SELECT c.*, coalesce(p.isatm, false) AS perso,
        row_number() OVER (PARTITION BY c.AccountKey, coalesce(p.isatm, false)
            ORDER BY c.CreateDate DESC, c.CustomerKey DESC) AS rn
    FROM src_customer c JOIN src_product p ON p.ProductKey = c.ProductKey
    WHERE c.AccountKey IS NOT NULL"""
FRAGMENTS["x_cards"] = """
    SELECT a.AccountKey,
        t.CustomerKey AS TCustomerkey, t.CreditRatingKey AS TCreditRatingkey, t.CurrBalance AS TCurrBalance,
        p.CustomerKey AS PCustomerkey, p.CreditRatingKey AS PCreditRatingkey, p.CurrBalance AS PCurrBalance,
        v.CustomerKey AS VCustomerkey, v.DOB, v.CardActivationDate, v.ProductKey, v.HomePhone,
        v.CellPhone, v.Email, v.ResidentialAddress1, v.ResidentialAddress2, v.ResidentialCity,
        v.ResidentialState, v.ResidentialZipcode, v.Address1, v.Address2, v.City, v.State, v.ZipCode
    FROM (SELECT DISTINCT AccountKey FROM x_card_rank) a
    LEFT JOIN (SELECT * FROM x_card_rank WHERE rn = 1 AND NOT perso) t ON t.AccountKey = a.AccountKey
    LEFT JOIN (SELECT * FROM x_card_rank WHERE rn = 1 AND perso) p ON p.AccountKey = a.AccountKey
    JOIN src_customer v ON v.CustomerKey = coalesce(t.CustomerKey, p.CustomerKey)"""


# --- Blocks --------------------------------------------------------------------

def block_fragments(name: str, condition: str) -> None:
    """Attempts and one-per-account blocks of the rating changes that meet ``condition``."""
    FRAGMENTS[f"x_attempt_{name}"] = f"""
    SELECT f.AccountKey, h.CustomerKey, h.ChangeDate, h.CreditRatingKey, h.SysUserKey, u.FullName,
        CAST(dense_rank() OVER (PARTITION BY f.AccountKey ORDER BY h.ChangeDate DESC) AS INT) AS attempt
    FROM (SELECT CustomerKey, max(ChangeDate) AS LatestDate FROM src_rating_history
          WHERE CreditRatingKey IN ('B5', 'P9', 'C5') AND {condition} GROUP BY CustomerKey) m
    JOIN src_rating_history h ON h.CustomerKey = m.CustomerKey AND h.ChangeDate = m.LatestDate
    JOIN src_sys_user u ON u.SysUserKey = h.SysUserKey
    JOIN src_customer f ON f.CustomerKey = h.CustomerKey AND f.CreditRatingKey = h.CreditRatingKey
    WHERE f.AccountKey IS NOT NULL AND (h.CreditRatingKey IN ('B5', 'P9', 'B3')
        OR (h.CreditRatingKey = 'C5' AND h.SysUserKey IN ({TRUSTED})))"""
    FRAGMENTS[f"x_block_{name}"] = f"""
    SELECT AccountKey, CreditRatingKey AS BlockCreditratingkey, ChangeDate AS BlockDate,
        FullName AS BlockUser
    FROM (SELECT *, row_number() OVER (PARTITION BY AccountKey
            ORDER BY CustomerKey DESC, CreditRatingKey DESC, SysUserKey DESC) AS rn
          FROM x_attempt_{name} WHERE attempt = 1) WHERE rn = 1"""


block_fragments("initial", within("ChangeDate", INITIAL_BLOCK_WINDOW))
block_fragments("add", within("ChangeDate", ADD_WINDOW))
block_fragments("update", "CustomerKey IN (SELECT CustomerKey FROM x_changed_ratings)")

for _name in ("initial", "add"):
    FRAGMENTS[f"x_rows_{_name}"] = f"""
    SELECT DISTINCT {MASTER}
    FROM x_signup_{_name} s
    LEFT JOIN x_check USING (AccountKey)
    LEFT JOIN x_block_{_name} USING (AccountKey)
    JOIN x_cards USING (AccountKey)"""


# --- Changes ---------------------------------------------------------------------

FRAGMENTS["x_changed_checks"] = f"""
    SELECT DISTINCT AccountKey FROM src_identity_validation v
    JOIN src_identity_validation_customer l ON l.IdentityValidationKey = v.IdentityValidationKey
    JOIN src_customer c ON c.CustomerKey = l.CustomerKey
    WHERE {within('v.CreateDate', UPDATE_WINDOW)} AND AccountKey IS NOT NULL"""
FRAGMENTS["x_changed_ratings"] = f"""
    SELECT DISTINCT c.AccountKey, c.CustomerKey FROM src_rating_history h
    JOIN src_customer c ON c.CustomerKey = h.CustomerKey
    WHERE {within('h.ChangeDate', UPDATE_WINDOW)} AND c.AccountKey IS NOT NULL"""
FRAGMENTS["x_changed_status"] = f"""
    SELECT DISTINCT c.AccountKey FROM src_card_status_history h
    JOIN src_customer c ON c.SerialNbr = h.SerialNbr
    WHERE {within('h.StartDate', UPDATE_WINDOW)} AND c.AccountKey IS NOT NULL"""


# --- Classification of a scope of accounts ------------------------------------------

def classification(name: str, accounts: str) -> None:
    """Online and retail steps of the rows of ``accounts``, as rows and sequential rungs."""
    FRAGMENTS.update({
        f"x_{name}_online": f"SELECT * FROM {accounts} WHERE Channel = 'Online'",
        f"x_{name}_cust": f"SELECT * FROM x_{name}_online WHERE LastIdentityValidationKey IS NOT NULL",
        f"x_{name}_fail": f"""
    SELECT CAST(month(a.ActivationActivityCreateDate) * 10000 + year(a.ActivationActivityCreateDate) AS INT)
            AS Month_Year,
        o.ActicationActivityOrder, t.ActivationActivityType AS activityDesc, a.CustomerKey, c.AccountKey
    FROM x_{name}_online c
    JOIN src_activation_activity a ON c.VCustomerkey = a.CustomerKey
    JOIN src_activation_type k ON k.ActivationTypeKey = a.ActivationTypeKey
    JOIN src_activation_activity_type t ON t.ActivationActivityTypeKey = a.ActivationActivityTypeKey
    LEFT JOIN x_type_order o ON o.ActivationActivityTypeKey = a.ActivationActivityTypeKey
    WHERE a.ActivationTypeKey = 2 AND a.IsConfirmed = false""",
        f"x_{name}_relabelled": f"""
    SELECT Month_Year, CASE WHEN neg THEN 4 ELSE ActicationActivityOrder END AS ActicationActivityOrder,
        CASE WHEN neg THEN 'Negative Match' ELSE activityDesc END AS activityDesc, CustomerKey, AccountKey
    FROM (SELECT *, lower(activityDesc) = 'fraud check' OR (lower(activityDesc) = 'customer verification'
            AND AccountKey NOT IN (SELECT AccountKey FROM x_{name}_cust)) AS neg FROM x_{name}_fail)""",
        f"x_{name}_quiz": f"""
    SELECT c.AccountKey, c.LastIdentityValidationKey, c.CreateDate, c.VCustomerkey, q.QuizResultCode, r.RiskValue
    FROM x_{name}_cust c
    JOIN src_quiz q ON q.IdentityValidationKey = c.LastIdentityValidationKey
    JOIN src_risk r ON r.IdentityValidationKey = q.IdentityValidationKey
    WHERE lower(q.QuizResultCode) IN ('refer_incomplete', 'refer')""",
        f"x_{name}_fail2": f"""
    SELECT Month_Year, ActicationActivityOrder, activityDesc, CustomerKey, AccountKey
    FROM x_{name}_relabelled WHERE AccountKey NOT IN (SELECT AccountKey FROM x_{name}_quiz)
    UNION
    SELECT CAST(month(CreateDate) * 10000 + year(CreateDate) AS INT), 10000, 'OOW Declined', VCustomerkey, AccountKey
    FROM x_{name}_quiz""",
        f"x_{name}_onlinestep": f"""
    SELECT c.AccountKey, CASE
        WHEN lower(rtrim(VerificationStatusType)) = 'approved' AND CardActivationDate IS NOT NULL THEN 'Approved'
        WHEN EXISTS (SELECT 1 FROM x_{name}_fail2 f WHERE f.AccountKey = c.AccountKey
            AND lower(activityDesc) = 'customer verification') THEN 'Ident_Verify'
        WHEN EXISTS (SELECT 1 FROM x_{name}_fail2 f WHERE f.AccountKey = c.AccountKey
            AND lower(activityDesc) = 'address validation') THEN 'Addr_Verify'
        WHEN EXISTS (SELECT 1 FROM x_{name}_fail2 f WHERE f.AccountKey = c.AccountKey
            AND activityDesc ILIKE '%partner%') THEN 'Card_Limit'
        WHEN EXISTS (SELECT 1 FROM x_{name}_fail2 f WHERE f.AccountKey = c.AccountKey
            AND activityDesc ILIKE '%oow%') THEN 'OOW'
        WHEN EXISTS (SELECT 1 FROM x_{name}_fail2 f WHERE f.AccountKey = c.AccountKey
            AND activityDesc ILIKE '%negative%') THEN 'Neg_Match'
        ELSE 'Incomplete' END AS Activation_step
    FROM x_{name}_online c""",
        f"x_{name}_retail": f"""
    SELECT m.*, c.FirstName, c.LastName, c.SSN, c.ParentFirstName, c.ParentLastName, c.ParentSSN, c.ParentDOB,
        CAST(date_diff('month', c.DOB, c.CreateDate) / 12.0 AS DECIMAL(17,6)) AS CH_Age,
        CAST(date_diff('month', c.ParentDOB, c.CreateDate) / 12.0 AS DECIMAL(17,6)) AS Parent_Age,
        r.refundreasonkey, f.refundreason, r.comment, c.activationstatuskey, c.ActivationSysUserKey,
        c.SysUserKey, s.activationstatus
    FROM {accounts} m
    JOIN src_customer c ON c.CustomerKey = m.VCustomerkey
    LEFT JOIN src_activation_status s ON s.activationstatuskey = c.activationstatuskey
    LEFT JOIN src_refund r ON r.CustomerKey = c.CustomerKey
    LEFT JOIN src_refund_reason f ON f.refundreasonkey = r.refundreasonkey
    WHERE m.Channel = 'Retail'""",
        f"x_{name}_tracked": f"""
    SELECT *, CASE
        WHEN FirstName IS NULL OR LastName IS NULL OR DOB IS NULL OR SSN IS NULL
            OR (CellPhone IS NULL AND HomePhone IS NULL) OR ResidentialAddress1 IS NULL
            OR ResidentialZipcode IS NULL
            OR ((ParentFirstName IS NULL OR ParentLastName IS NULL OR ParentDOB IS NULL OR ParentSSN IS NULL)
                AND CH_Age < 18) THEN 'Missing_Info'
        WHEN lower(rtrim(VerificationStatusType)) = 'approved' AND CardActivationDate IS NOT NULL THEN 'Approved'
        WHEN activationstatuskey IN (50, 140) OR refundreasonkey = 8 THEN 'Neg_Match'
        WHEN activationstatuskey = 145 OR refundreasonkey = 23 THEN 'Card_Limit'
        WHEN lower(rtrim(VerificationStatusType)) <> 'approved' THEN 'Ident_Verify' END AS ACTIVATION_TRACKER
    FROM x_{name}_retail""",
        f"x_{name}_retailquiz": f"""
    SELECT t.AccountKey FROM x_{name}_tracked t
    JOIN src_quiz q ON q.IdentityValidationKey = t.LastIdentityValidationKey
    JOIN src_risk r ON r.IdentityValidationKey = q.IdentityValidationKey
    WHERE t.ACTIVATION_TRACKER = 'Ident_Verify' AND lower(q.QuizResultCode) IN ('refer_incomplete', 'refer')""",
        f"x_{name}_overridden": f"""
    SELECT * REPLACE (CASE WHEN AccountKey IN (SELECT AccountKey FROM x_{name}_retailquiz) THEN 'OOW'
        ELSE ACTIVATION_TRACKER END AS ACTIVATION_TRACKER) FROM x_{name}_tracked""",
        f"x_{name}_retailstep": f"""
    SELECT AccountKey, ACTIVATION_TRACKER AS Activation_step FROM (
        SELECT *, row_number() OVER (PARTITION BY AccountKey ORDER BY CASE ACTIVATION_TRACKER
            WHEN 'Missing_Info' THEN 1 WHEN 'Approved' THEN 2 WHEN 'Neg_Match' THEN 3
            WHEN 'Card_Limit' THEN 4 WHEN 'Ident_Verify' THEN 5 WHEN 'OOW' THEN 6 ELSE 7 END) AS rn
        FROM x_{name}_overridden) WHERE rn = 1""",
    })


FRAGMENTS["x_type_order"] = "SELECT * FROM (VALUES {}) AS t({})".format(
    ", ".join(
        f"({i}, {key}, {order}, {str(active).lower()}, '{text}')"
        for i, (key, order, active, text) in enumerate(config.ACTIVITY_TYPE_ORDER, start=1)
    ),
    "id, ActivationActivityTypeKey, ActicationActivityOrder, IsActive, ActivityTypeDesc",
)
FRAGMENTS["x_quiz_result"] = """
    SELECT IdentityValidationKey, max(QuizResultCode) AS QuizResultCode
    FROM src_quiz GROUP BY IdentityValidationKey"""
FRAGMENTS["x_internal"] = """
    SELECT DISTINCT s.IdentityValidationKey
    FROM src_identity_validation_status s
    JOIN src_identity_validation_status_type t USING (IdentityValidationStatusTypeKey)
    JOIN src_identity_validation_vendor v USING (IdentityValidationVendorKey)
    WHERE IdentityValidationVendorKey = 4 AND IdentityValidationStatusTypeKey = 1"""

FRAGMENTS["x_address"] = """
    SELECT *, row_number() OVER (PARTITION BY AccountKey, addressTypekey
        ORDER BY CreateDate DESC, AddressStandardizationResultKey DESC) AS rn
    FROM src_account_address"""

FRAGMENTS["x_report_accounts"] = f"SELECT * FROM src_account_master WHERE BankKey = {REPORT_BANK}"
classification("held", "src_account_master")
classification("report", "x_report_accounts")


# --- Runs -----------------------------------------------------------------------------

def publish(name: str, start: str, scope: str, online: str, retail: str, fill: bool) -> None:
    """Fragments x_{name}_1 … 4: steps, quiz column and internal tag put into ``start``."""
    held = " AND m.Activation_step IS NULL" if fill else ""
    quiz = f"""(SELECT a.AccountKey, q.QuizResultCode FROM x_{name}_2 a
        JOIN x_quiz_result q ON q.IdentityValidationKey = a.LastIdentityValidationKey WHERE {scope})"""
    internal = f"""(SELECT a.AccountKey FROM x_{name}_3 a
        JOIN x_internal i ON i.IdentityValidationKey = a.LastIdentityValidationKey
        WHERE {scope} AND Activation_step = 'Approved' AND LastAttemptValue IS NULL
          AND lower(rtrim(VerificationStatusType)) = 'approved')"""
    step = {"Activation_step": "p.Activation_step"}
    FRAGMENTS.update({
        f"x_{name}_1": patched(start, online, step, "true" + held),
        f"x_{name}_2": patched(f"x_{name}_1", retail, step),
        f"x_{name}_3": patched(f"x_{name}_2", quiz, {"OOW": "p.QuizResultCode"}),
        f"x_{name}_4": patched(f"x_{name}_3", internal, {"LastAttemptValue": "'Int'"}),
    })


STEP_COLUMNS = "CAST(NULL AS VARCHAR) AS Activation_step, CAST(NULL AS VARCHAR) AS OOW"

FRAGMENTS["x_added"] = f"""
    SELECT {MASTER}, Activation_step, OOW FROM src_account_master
    UNION ALL SELECT {MASTER}, {STEP_COLUMNS} FROM x_rows_add"""
FRAGMENTS["x_addonline_scope"] = "SELECT * FROM x_added WHERE Activation_step IS NULL"
FRAGMENTS["x_addretail_scope"] = f"SELECT * FROM x_added WHERE {within('CreateDate', ADD_WINDOW)}"
classification("addonline", "x_addonline_scope")
classification("addretail", "x_addretail_scope")
publish("add", "x_added", within("CreateDate", ADD_WINDOW),
        "x_addonline_onlinestep", "x_addretail_retailstep", True)

FRAGMENTS["x_fresh"] = """
    SELECT * FROM x_changed_checks JOIN x_check USING (AccountKey) JOIN x_cards USING (AccountKey)"""
FRAGMENTS["x_checked"] = patched(
    "src_account_master", "x_fresh",
    {c: f"p.{c}" for c in (
        "LastIdentityValidationKey", "VerificationStatusType", "LastAttemptValue", "TCustomerkey",
        "PCustomerkey", "VCustomerkey", "CardActivationDate")},
)


def balances(master: str) -> str:
    return f"""
    SELECT m.AccountKey, p.CreditRatingKey AS PCreditRatingkey, p.CurrBalance AS PCurrBalance,
        t.CreditRatingKey AS TCreditRatingkey, t.CurrBalance AS TCurrBalance
    FROM {master} m
    JOIN src_customer p ON p.CustomerKey = m.PCustomerkey
    JOIN src_customer t ON t.CustomerKey = m.TCustomerkey
    WHERE m.AccountKey IN (SELECT AccountKey FROM x_changed_status)"""


BLOCK_PATCH = {c: f"p.{c}" for c in ("BlockCreditratingkey", "BlockDate", "BlockUser")}
BALANCE_PATCH = {
    c: f"p.{c}" for c in ("PCreditRatingkey", "PCurrBalance", "TCreditRatingkey", "TCurrBalance")
}
FRAGMENTS["x_blocked"] = patched("x_checked", "x_block_update", BLOCK_PATCH)
FRAGMENTS["x_balances"] = balances("x_blocked")
FRAGMENTS["x_balanced"] = patched("x_blocked", "x_balances", BALANCE_PATCH)
FRAGMENTS["x_update_scope"] = """
    SELECT * FROM x_balanced WHERE AccountKey IN (SELECT AccountKey FROM x_fresh)"""
classification("updated", "x_update_scope")
publish("update", "x_balanced", "a.AccountKey IN (SELECT AccountKey FROM x_fresh)",
        "x_updated_onlinestep", "x_updated_retailstep", False)

FRAGMENTS["x_initial"] = f"SELECT {MASTER}, {STEP_COLUMNS} FROM x_rows_initial"
FRAGMENTS["x_initonline_scope"] = f"""
    SELECT * FROM x_initial
    WHERE CreateDate >= TIMESTAMP '1998-10-01' AND CreateDate < TIMESTAMP '1998-10-25'"""
classification("initonline", "x_initonline_scope")
classification("init", "x_initial")
publish("initial", "x_initial", "true", "x_initonline_onlinestep", "x_init_retailstep", True)
FRAGMENTS["x_bank_now"] = """
    SELECT m.AccountKey, b.BankKey AS newbankkey, b.BankName AS newbankname
    FROM x_initial m JOIN src_product p ON p.ProductKey = m.ProductKey
    JOIN src_bank b ON b.BankKey = p.BankKey"""
