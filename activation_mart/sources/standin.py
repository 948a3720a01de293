"""Source tables of the documented schemas, made from star-schema and event tables.

Each table is one SELECT that Spark and DuckDB read alike; ``{name}`` stands for
a table of the star schema or for another stand-in. Keys and dates are taken
from orders and line items, so every table grows with them; codes and empty
fields come from remainders of the keys.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from .. import config
from ..functions import RunWindow
from .registry import Sources

# Given, so that opening a table does not cost a job to read its schema.
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

CONFIG = config.MartConfig(
    test_accounts=config.TestAccountRules(
        secret_words=("PROBETEST%",), house_addresses=("%12 SAMPLE PLAZA%",), house_emails=("%@issuer.example%",)
    )
)

INITIAL_WINDOW = RunWindow.parse("1/1/1995", "1/1/1999")
INITIAL_BLOCK_WINDOW = RunWindow.parse("1/1/1995", "2/1/1999")
ADD_WINDOW = RunWindow.parse("1/1/1999", "7/1/1999")
UPDATE_WINDOW = RunWindow.parse("1/1/1999", "4/1/1999")
REPORT_BANK = 2

STANDINS: dict[str, str] = {
    "src_bank": "SELECT r_regionkey AS BankKey, r_name AS BankName FROM {region}",
    "src_product": """
        SELECT n_nationkey AS ProductKey, n_regionkey AS BankKey,
            CASE n_nationkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS isOnlineProduct,
            CASE WHEN n_nationkey % 11 = 10 THEN 2 ELSE 1 END AS ourcardtypekey,
            n_nationkey % 2 = 0 AS isatm
        FROM {nation}""",
    "src_customer": """
        SELECT o_orderkey AS CustomerKey,
            CASE WHEN o_orderkey % 101 <> 0 THEN o_custkey * 4 + o_orderkey % 4 END AS AccountKey,
            CAST(o_orderkey % 25 AS INT) AS ProductKey,
            'S' || CAST(o_orderkey AS STRING) AS SerialNbr,
            o_orderdate AS CreateDate,
            CASE WHEN o_orderkey % 211 = 0 THEN 'ProbeTest one'
                WHEN o_orderkey % 3 <> 0 THEN 'word' END AS SecretWord,
            CASE WHEN o_orderkey % 223 = 0 THEN 'TESTER'
                WHEN o_orderkey % 19 <> 0 THEN 'F' || CAST(o_orderkey % 997 AS STRING) END AS FirstName,
            CASE WHEN o_orderkey % 227 = 0 THEN 'Testing'
                WHEN o_orderkey % 23 <> 0 THEN 'L' || CAST(o_orderkey % 991 AS STRING) END AS LastName,
            CASE WHEN o_orderkey % 229 = 0 THEN 'c/o 12 Sample Plaza'
                ELSE CAST(o_orderkey % 983 AS STRING) || ' Main Street' END AS Address1,
            CASE WHEN o_orderkey % 5 = 0 THEN 'Unit 5' END AS Address2,
            'Town ' || CAST(o_custkey % 50 AS STRING) AS City,
            'ST' AS State,
            CAST(10000 + o_custkey % 90000 AS STRING) AS ZipCode,
            CASE WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderkey % 977 AS STRING) || ' Hill Road' END
                AS ResidentialAddress1,
            CASE WHEN o_orderkey % 7 = 0 THEN 'Rear' END AS ResidentialAddress2,
            'Town ' || CAST(o_custkey % 40 AS STRING) AS ResidentialCity,
            'RS' AS ResidentialState,
            CASE WHEN o_orderkey % 31 <> 0 THEN CAST(20000 + o_custkey % 70000 AS STRING) END
                AS ResidentialZipcode,
            CASE WHEN o_orderkey % 3 <> 0 THEN '555-' || CAST(o_orderkey % 9973 AS STRING) END AS HomePhone,
            CASE WHEN o_orderkey % 8 <> 0 THEN '777-' || CAST(o_orderkey % 9967 AS STRING) END AS CellPhone,
            CASE WHEN o_orderkey % 233 = 0 THEN 'qa@Issuer.example'
                WHEN o_orderkey % 13 <> 0 THEN 'u' || CAST(o_orderkey AS STRING) || '@mail.example' END AS Email,
            CASE o_orderkey % 6 WHEN 0 THEN 'B5' WHEN 1 THEN 'P9' WHEN 2 THEN 'C5' WHEN 3 THEN 'B3'
                ELSE 'A1' END AS CreditRatingKey,
            CAST(o_totalprice AS DECIMAL(19,4)) AS CurrBalance,
            CASE WHEN o_orderkey % 37 <> 0
                THEN CAST(o_orderdate AS DATE) - CAST(5000 + o_orderkey % 12000 AS INT) END AS DOB,
            CASE WHEN o_orderkey % 8 < 5 THEN o_orderdate + INTERVAL '48' HOUR END AS CardActivationDate,
            CASE WHEN o_orderkey % 2 = 0 THEN 'PF' END AS ParentFirstName,
            CASE WHEN o_orderkey % 5 <> 0 THEN 'PL' END AS ParentLastName,
            CASE WHEN o_orderkey % 41 <> 0 THEN 'given' END AS SSN,
            CASE WHEN o_orderkey % 3 <> 0 THEN 'given' END AS ParentSSN,
            CASE WHEN o_orderkey % 7 <> 0
                THEN CAST(o_orderdate AS DATE) - CAST(14000 + o_orderkey % 3000 AS INT) END AS ParentDOB,
            CASE o_orderkey % 20 WHEN 0 THEN 50 WHEN 1 THEN 140 WHEN 2 THEN 145 WHEN 3 THEN 30
                WHEN 4 THEN 7 END AS activationstatuskey,
            CAST(o_custkey % 100 AS INT) AS ActivationSysUserKey,
            CAST(o_custkey % 90 AS INT) AS SysUserKey
        FROM {orders}""",
    "src_identity_validation": """
        SELECT o_orderkey + 1000000 AS IdentityValidationKey,
            o_orderdate + INTERVAL '36' HOUR AS CreateDate,
            CASE WHEN o_orderkey % 9 < 3 THEN 'Approved' WHEN o_orderkey % 9 = 3 THEN 'APPROVED '
                WHEN o_orderkey % 9 < 8 THEN 'Declined' END AS VerificationStatusType,
            CASE o_orderkey % 4 WHEN 1 THEN 'Pass' WHEN 2 THEN 'Fail' END AS LastAttemptValue
        FROM {orders}""",
    # A negative key belongs to nobody: all rows are there, and some customers have no check.
    "src_identity_validation_customer": """
        SELECT o_orderkey + 1000000 AS IdentityValidationKey,
            CASE WHEN o_orderkey % 5 = 4 THEN -o_orderkey ELSE o_orderkey END AS CustomerKey
        FROM {orders}""",
    "src_identity_validation_status": """
        SELECT o_orderkey + 1000000 AS IdentityValidationKey,
            o_orderdate + INTERVAL '37' HOUR AS CreateDate,
            'C' || CAST(o_orderkey % 10 AS STRING) AS ValidationResultCode,
            CAST(o_orderkey % 2 AS INT) AS IdentityValidationStatusTypeKey,
            CAST(o_orderkey % 5 AS INT) AS IdentityValidationVendorKey
        FROM {orders}""",
    "src_identity_validation_status_type": """
        SELECT r_regionkey AS IdentityValidationStatusTypeKey,
            'Status ' || r_name AS IdentityValidationStatusType FROM {region}""",
    "src_identity_validation_vendor": """
        SELECT r_regionkey AS IdentityValidationVendorKey,
            'Vendor ' || r_name AS IdentityValidationVendor FROM {region}""",
    "src_quiz": """
        SELECT l_orderkey + 1000000 AS IdentityValidationKey,
            CASE l_suppkey % 8 WHEN 0 THEN 'refer' WHEN 1 THEN 'REFER_incomplete'
                WHEN 2 THEN NULL ELSE 'accept' END AS QuizResultCode
        FROM {lineitem}""",
    # Several rows a check; those of a negative key leave checks without any.
    "src_risk": """
        SELECT CASE WHEN l_orderkey % 3 = 2 THEN -l_orderkey ELSE l_orderkey + 1000000 END AS IdentityValidationKey,
            'R' || CAST((l_orderkey + l_linenumber) % 3 AS STRING) AS RiskValue
        FROM {lineitem}""",
    "src_rating_history": """
        SELECT l_orderkey AS CustomerKey, l_shipdate AS ChangeDate,
            CASE l_linenumber WHEN 1 THEN 'B5' WHEN 2 THEN 'P9' WHEN 3 THEN 'C5' WHEN 4 THEN 'B3'
                ELSE 'A1' END AS CreditRatingKey,
            CAST(l_suppkey + 980 AS INT) AS SysUserKey
        FROM {lineitem}""",
    "src_sys_user": "SELECT CAST(s_suppkey + 980 AS INT) AS SysUserKey, s_name AS FullName FROM {supplier}",
    "src_card_status_history": """
        SELECT 'S' || CAST(l_orderkey AS STRING) AS SerialNbr, l_shipdate AS StartDate
        FROM {lineitem} WHERE l_linestatus = 'F'""",
    "src_activation_activity": """
        SELECT l_orderkey AS CustomerKey,
            CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 2 END AS ActivationTypeKey,
            CASE (l_suppkey + l_linenumber) % 9 WHEN 0 THEN 9 WHEN 1 THEN 3 WHEN 2 THEN 20
                WHEN 3 THEN 5 WHEN 4 THEN 2 WHEN 5 THEN 12 WHEN 6 THEN 8 WHEN 7 THEN 7 ELSE 2 END
                AS ActivationActivityTypeKey,
            l_returnflag = 'N' AS IsConfirmed,
            l_shipdate AS ActivationActivityCreateDate
        FROM {lineitem}""",
    "src_activation_type": "SELECT r_regionkey AS ActivationTypeKey FROM {region}",
    "src_activation_activity_type": """
        SELECT n_nationkey AS ActivationActivityTypeKey,
            CASE n_nationkey WHEN 2 THEN 'Customer Verification' WHEN 3 THEN 'Age Verification'
                WHEN 5 THEN 'Partner Card Limit' WHEN 8 THEN 'fraud check' WHEN 9 THEN 'IP Validation'
                WHEN 12 THEN 'Activation Error' WHEN 20 THEN 'Address validation'
                ELSE 'Other ' || n_name END AS ActivationActivityType
        FROM {nation}""",
    "src_refund": """
        SELECT l_orderkey AS CustomerKey,
            CASE l_suppkey % 3 WHEN 0 THEN 8 WHEN 1 THEN 23 ELSE l_linenumber + 19 END AS refundreasonkey,
            CASE WHEN l_partkey % 4 = 0 THEN 'asked by phone' END AS comment
        FROM {lineitem} WHERE l_returnflag = 'R'""",
    "src_refund_reason": "SELECT n_nationkey AS refundreasonkey, n_name AS refundreason FROM {nation}",
    "src_activation_status": """
        SELECT n_nationkey * 5 + 25 AS activationstatuskey, 'Status ' || n_name AS activationstatus
        FROM {nation}""",
    "src_account_address": """
        SELECT o_custkey * 4 + 1 AS AccountKey,
            CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS addressTypekey,
            o_orderkey AS AddressStandardizationResultKey,
            o_orderdate + INTERVAL '90' MINUTE AS CreateDate
        FROM {orders}""",
    "src_address_result": """
        SELECT o_orderkey AS AddressStandardizationResultKey,
            CASE o_orderkey % 5 WHEN 0 THEN 'Verified' WHEN 1 THEN 'verified' WHEN 2 THEN 'Street'
                ELSE NULL END AS MatchLevel
        FROM {orders}""",
    # A master as an earlier run may have left it: one row per account signed up
    # before the add window, partly stale and partly classified.
    "src_account_master": """
        SELECT c.AccountKey, c.CreateDate,
            CAST(CASE WHEN c.CustomerKey % 13 = 0 THEN (p.BankKey + 1) % 5 ELSE p.BankKey END AS INT) AS BankKey,
            CASE WHEN c.CustomerKey % 13 = 0 THEN 'Former bank' ELSE b.BankName END AS BankName,
            CASE WHEN p.isOnlineProduct THEN 'Online' ELSE 'Retail' END AS Channel,
            v.IdentityValidationKey AS LastIdentityValidationKey,
            v.VerificationStatusType, v.LastAttemptValue,
            CASE WHEN c.CustomerKey % 17 = 0 THEN 'B5' END AS BlockCreditratingkey,
            CASE WHEN c.CustomerKey % 17 = 0 THEN c.CreateDate END AS BlockDate,
            CASE WHEN c.CustomerKey % 17 = 0 THEN 'Former user' END AS BlockUser,
            CASE WHEN c.CustomerKey % 9 <> 0 THEN c.CustomerKey END AS TCustomerkey,
            CASE WHEN c.CustomerKey % 9 <> 0 THEN 'A1' END AS TCreditRatingkey,
            CASE WHEN c.CustomerKey % 9 <> 0 THEN CAST(0 AS DECIMAL(19,4)) END AS TCurrBalance,
            CASE WHEN c.CustomerKey % 4 <> 0 THEN f.FirstKey END AS PCustomerkey,
            CASE WHEN c.CustomerKey % 4 <> 0 THEN 'A1' END AS PCreditRatingkey,
            CASE WHEN c.CustomerKey % 4 <> 0 THEN CAST(0 AS DECIMAL(19,4)) END AS PCurrBalance,
            CASE WHEN c.CustomerKey % 47 <> 0 THEN c.CustomerKey END AS VCustomerkey,
            c.DOB, c.CardActivationDate, c.ProductKey, c.HomePhone, c.CellPhone, c.Email,
            c.ResidentialAddress1, c.ResidentialAddress2, c.ResidentialCity, c.ResidentialState,
            c.ResidentialZipcode, c.Address1, c.Address2, c.City, c.State, c.ZipCode,
            CASE c.CustomerKey % 7 WHEN 0 THEN 'Incomplete' WHEN 1 THEN 'Approved'
                WHEN 2 THEN 'Neg_Match' END AS Activation_step,
            CASE WHEN c.CustomerKey % 18 = 0 THEN 'accept' END AS OOW
        FROM (
            SELECT s.*,
                row_number() OVER (PARTITION BY AccountKey ORDER BY CreateDate DESC, CustomerKey DESC) AS rn
            FROM {src_customer} s
            WHERE AccountKey IS NOT NULL AND CreateDate < TIMESTAMP_NTZ '1999-01-01 00:00:00'
        ) c
        JOIN (
            SELECT AccountKey, min(CustomerKey) AS FirstKey FROM {src_customer}
            WHERE AccountKey IS NOT NULL AND CreateDate < TIMESTAMP_NTZ '1999-01-01 00:00:00'
            GROUP BY AccountKey
        ) f ON f.AccountKey = c.AccountKey
        JOIN {src_product} p ON p.ProductKey = c.ProductKey
        JOIN {src_bank} b ON b.BankKey = p.BankKey
        LEFT JOIN {src_identity_validation} v
            ON v.IdentityValidationKey = c.CustomerKey + 1000000 AND c.CustomerKey % 5 <> 4
        WHERE c.rn = 1""",
}
# The same master, where every account whose sign-up had a check has it, whoever answered it.
STANDINS["src_checked_master"] = STANDINS["src_account_master"].replace(" AND c.CustomerKey % 5 <> 4", "")


def needs(name: str) -> list[str]:
    """Tables a stand-in reads."""
    return sorted({field for _, field, _, _ in Formatter().parse(STANDINS[name]) if field})


class StandinTables:
    """Star-schema tables of a folder and the stand-ins over them, as frames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in STANDINS:
                tables = {table: self[table] for table in needs(name)}
                self._frames[name] = self.spark.sql(STANDINS[name], **tables)
            else:
                reader = self.spark.read.schema(RAW_SCHEMAS[name])
                self._frames[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self._frames[name]

    @property
    def sources(self) -> Sources:
        return Sources(
            self.spark,
            {name: lambda n=name: self[f"src_{n}"] for name in config.SOURCE_SCHEMAS},
        )

    @property
    def master(self) -> DataFrame:
        return self["src_account_master"]


def oracle_tables(names) -> list[tuple[str, str]]:
    """(name, SQL) of the stand-ins needed for ``names``, each after those it reads."""
    out: dict[str, str] = {}

    def add(name: str) -> None:
        if name in STANDINS and name not in out:
            tables = needs(name)
            for table in tables:
                add(table)
            text = STANDINS[name].format(**{t: t for t in tables})
            out[name] = text.replace("TIMESTAMP_NTZ '", "TIMESTAMP '")

    for name in names:
        add(name)
    return list(out.items())
