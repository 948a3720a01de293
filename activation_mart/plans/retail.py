"""Candidates and activation step of retail accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import month_boundaries
from ..operators import SPREAD, first_match, left_lookup, only_keys, set_where, with_spread
from ..operators.waterfall import Rung
from ..session import settle
from ..sources import Sources
from .checks import with_check_facts
from .online import IS_APPROVED

TRACKER = "ACTIVATION_TRACKER"


def retail_customers(src: Sources, only: DataFrame | None = None) -> DataFrame:
    """What the retail ladder needs of a customer; personal data only as 'is given'."""
    given = {
        "has_first_name": "FirstName", "has_last_name": "LastName", "has_ssn": "SSN",
        "has_parent_first_name": "ParentFirstName", "has_parent_last_name": "ParentLastName",
        "has_parent_ssn": "ParentSSN", "has_parent_dob": "ParentDOB",
    }
    return only_keys(src["customer"], only, "CustomerKey").select(
        "CustomerKey",
        *(F.col(column).isNotNull().alias(name) for name, column in given.items()),
        month_boundaries("DOB", "CreateDate").alias("age_months"),
        month_boundaries("ParentDOB", "CreateDate").alias("parent_age_months"),
        "activationstatuskey",
        "ActivationSysUserKey",
        "SysUserKey",
    )


#: What the ladder, its quiz override and the reports need of an account.
ACCOUNT_COLUMNS = (
    "AccountKey", "VCustomerkey", "LastIdentityValidationKey", "VerificationStatusType",
    "CardActivationDate", "DOB", "CellPhone", "HomePhone", "ResidentialAddress1",
    "ResidentialZipcode",
)


def retail_candidates(accounts: DataFrame, src: Sources) -> DataFrame:
    """Retail accounts with their customer, status and refunds: one row per refund, at least one.

    Refunds meet the settled accounts in an inner join by themselves, which the
    adaptive skew join can split where one customer has very many; it could not
    split a left join on that side, nor a join on top of another. Accounts
    without refunds are added. Settled are the columns that the ladder reads.
    """
    customers = retail_customers(src).withColumnRenamed("CustomerKey", "VCustomerkey")
    refunds = src["refund"].select(
        F.col("CustomerKey").alias("VCustomerkey"), "refundreasonkey", "comment"
    )
    years = F.lit(12).cast("decimal(3,1)")
    known = settle(
        accounts.select(*ACCOUNT_COLUMNS).join(customers, "VCustomerkey")
        .join(src["activation_status"], "activationstatuskey", "left")
        .withColumn("CH_Age", (F.col("age_months") / years).cast("decimal(17,6)"))
        .withColumn("Parent_Age", (F.col("parent_age_months") / years).cast("decimal(17,6)")),
        "retail-accounts",
    )
    refunded = known.join(refunds, "VCustomerkey").join(
        src["refund_reason"], "refundreasonkey", "left"
    )
    others = known.join(refunds.select("VCustomerkey").distinct(), "VCustomerkey", "left_anti")
    return refunded.unionByName(others, allowMissingColumns=True)


def refund_flags(src: Sources, only: DataFrame | None = None) -> DataFrame:
    """Per customer, which kinds of refund reason occurred."""
    reason = F.col("refundreasonkey")
    negative = F.coalesce(reason == config.NEGATIVE_REFUND, F.lit(False))
    limit = F.coalesce(reason == config.LIMIT_REFUND, F.lit(False))
    refunds = with_spread(only_keys(src["refund"], only, "CustomerKey"), "CustomerKey")
    return refunds.groupBy("CustomerKey", SPREAD).agg(
        F.bool_or(negative).alias("refund_negative"),
        F.bool_or(limit).alias("refund_limit"),
        F.bool_or(~negative & ~limit).alias("refund_other"),
    )


HAS_PHONE = "(CellPhone IS NOT NULL OR HomePhone IS NOT NULL)"
HAS_RESIDENCE = "(ResidentialAddress1 IS NOT NULL AND ResidentialZipcode IS NOT NULL)"
# Own or parent's data present for each required field.
IS_COMPLETE = (
    "((has_first_name OR has_parent_first_name) AND (has_last_name OR has_parent_last_name) "
    "AND (DOB IS NOT NULL OR has_parent_dob) AND (has_ssn OR has_parent_ssn) "
    f"AND {HAS_PHONE} AND {HAS_RESIDENCE})"
)
HAS_OWN_DATA = (
    "(has_first_name AND has_last_name AND has_ssn AND DOB IS NOT NULL "
    f"AND {HAS_PHONE} AND {HAS_RESIDENCE})"
)
HAS_PARENT_DATA = (
    "(has_parent_first_name AND has_parent_last_name AND has_parent_dob AND has_parent_ssn)"
)
IS_MINOR = f"age_months < {config.ADULT_MONTHS}"


def _among(column: str, keys) -> str:
    return f"{column} IN ({', '.join(map(str, keys))})"


def retail_rungs(negative_refund: str, limit_refund: str) -> list[Rung]:
    """The retail ladder; the refund tests differ between refund rows and per-customer flags."""
    status = "activationstatuskey"
    return [
        ("Missing_Info", f"NOT {HAS_OWN_DATA} OR (NOT {HAS_PARENT_DATA} AND {IS_MINOR})"),
        ("Incomplete", f"NOT {IS_COMPLETE}"),
        ("Approved", IS_APPROVED),
        ("Neg_Match", f"{_among(status, config.NEGATIVE_STATUS_KEYS)} OR {negative_refund}"),
        ("Card_Limit", f"{_among(status, config.LIMIT_STATUS_KEYS)} OR {limit_refund}"),
        ("Ident_Verify", f"lower(rtrim(VerificationStatusType)) <> '{config.APPROVED.lower()}'"),
    ]


def retail_waterfall(candidates: DataFrame) -> DataFrame:
    """Tracker of each candidate row; NULL where no rung holds."""
    rungs = retail_rungs(
        f"refundreasonkey = {config.NEGATIVE_REFUND}", f"refundreasonkey = {config.LIMIT_REFUND}"
    )
    return candidates.withColumn(TRACKER, first_match(rungs))


def retail_quiz_override(tracked: DataFrame, src: Sources) -> DataFrame:
    """All rows of an account become OOW if one of them is Ident_Verify with a failed quiz."""
    unverified = tracked.filter(F.col(TRACKER) == "Ident_Verify")
    failed = (
        with_check_facts(unverified.select("AccountKey", "LastIdentityValidationKey").distinct(), src)
        .filter("quiz_failed")
        .select("AccountKey", F.lit(True).alias("__failed"))
    )
    marked = tracked.join(failed, "AccountKey", "left")
    return set_where(marked, TRACKER, "OOW", F.col("__failed")).drop("__failed")


def retail_step() -> Column:
    """Step of a retail account from its customer, refund and quiz facts.

    Same result as the smallest rung over the candidate rows of the account
    after the quiz override, without making these rows: the override needs a
    refund row (or none at all) that leaves the account at Ident_Verify.
    """
    plain_row_step = first_match(retail_rungs("false", "false"))
    overridden = F.expr("coalesce(refund_other, true) AND quiz_failed") & (
        plain_row_step == "Ident_Verify"
    )
    return F.when(overridden, "OOW").otherwise(
        first_match(retail_rungs("refund_negative", "refund_limit"))
    )


def retail_steps(accounts: DataFrame, src: Sources) -> DataFrame:
    """Step, possibly NULL, of each given retail account that has a customer row."""
    customers = retail_customers(src).withColumn("customer_found", F.lit(True))
    facts = left_lookup(
        with_check_facts(accounts.select(*ACCOUNT_COLUMNS), src),
        [customers, refund_flags(src)], "VCustomerkey", "CustomerKey", "AccountKey",
    )
    return facts.filter("customer_found").select(
        "AccountKey", retail_step().alias(config.STEP_COLUMN)
    )
