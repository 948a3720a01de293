"""Scalar functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import (
    RunWindow,
    address_verified,
    hour_boundaries,
    in_window,
    month_boundaries,
    month_year,
    parse_date,
)
from .registry import check


@check(
    "f02_month_year",
    """SELECT CustomerKey, CAST(month(ActivationActivityCreateDate) * 10000
           + year(ActivationActivityCreateDate) AS INT) AS Month_Year,
           date_trunc('month', ActivationActivityCreateDate)::TIMESTAMP AS first_of_month
       FROM src_activation_activity""",
)
def _(t):
    moment = "ActivationActivityCreateDate"
    return t.sources["activation_activity"].select(
        "CustomerKey",
        month_year(moment).alias("Month_Year"),
        F.date_trunc("month", moment).cast("timestamp_ntz").alias("first_of_month"),
    )


@check(
    "f03_age_months",
    """SELECT CustomerKey, CAST(date_diff('month', DOB, CreateDate) AS INT) AS months,
           CAST(date_diff('month', DOB, CreateDate) / 12.0 AS DECIMAL(17,6)) AS CH_Age
       FROM src_customer""",
)
def _(t):
    months = month_boundaries("DOB", "CreateDate")
    years = F.lit(12).cast("decimal(3,1)")
    return t.sources["customer"].select(
        "CustomerKey", months.alias("months"), (months / years).cast("decimal(17,6)").alias("CH_Age")
    )


@check(
    "f05_parse_date",
    """SELECT o_orderkey, strptime(strftime(o_orderdate, '%-m/%-d/%Y'), '%m/%d/%Y') AS parsed
       FROM orders""",
)
def _(t):
    text = F.date_format("o_orderdate", "M/d/yyyy")
    return t["orders"].select("o_orderkey", parse_date(text).alias("parsed"))


@check(
    "f06_hours_between",
    """SELECT event_id, date_diff('hour', date_trunc('day', ts), ts) AS hours_today,
           date_diff('hour', ts, TIMESTAMP '2024-02-01 00:30:00') AS hours_left FROM events""",
)
def _(t):
    end = F.lit("2024-02-01 00:30:00").cast("timestamp_ntz")
    return t["events"].select(
        "event_id",
        hour_boundaries(F.date_trunc("day", "ts").cast("timestamp_ntz"), "ts").alias("hours_today"),
        hour_boundaries("ts", end).alias("hours_left"),
    )


@check(
    "f07_trailing_window",
    """SELECT CustomerKey, ChangeDate, CreditRatingKey FROM src_rating_history
       WHERE ChangeDate >= TIMESTAMP '1998-12-16' AND ChangeDate < TIMESTAMP '1999-01-15 09:30:00'""",
)
def _(t):
    window = RunWindow.trailing(30, datetime(1999, 1, 15, 9, 30))
    return (
        t.sources["rating_history"]
        .filter(in_window("ChangeDate", window))
        .select("CustomerKey", "ChangeDate", "CreditRatingKey")
    )


@check(
    "f08_two_status",
    """SELECT a.IdentityValidationKey, CASE
           WHEN lower(a.VerificationStatusType) = 'verified' AND lower(b.MatchLevel) = 'verified' THEN 'VERIFIED'
           WHEN lower(a.VerificationStatusType) = 'verified' AND b.MatchLevel IS NULL THEN 'VERIFIED'
           WHEN a.VerificationStatusType IS NULL AND lower(b.MatchLevel) = 'verified' THEN 'VERIFIED'
           WHEN a.VerificationStatusType IS NULL AND b.MatchLevel IS NULL THEN 'VERIFIED' END AS verdict
       FROM src_identity_validation a
       JOIN src_address_result b ON b.AddressStandardizationResultKey = a.IdentityValidationKey - 1000000""",
)
def _(t):
    results = t.sources["address_result"].withColumn(
        "IdentityValidationKey", F.col("AddressStandardizationResultKey") + 1000000
    )
    return (
        t.sources["identity_validation"]
        .join(results, "IdentityValidationKey")
        .select(
            "IdentityValidationKey",
            address_verified("VerificationStatusType", "MatchLevel").alias("verdict"),
        )
    )
