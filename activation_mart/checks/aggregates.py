"""Aggregates, windows, set operations and sorted previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config
from ..operators import (
    duplicates,
    latest_one,
    latest_with_ties,
    preview,
    rows_at_latest,
    top_n,
    union_distinct,
    with_attempt,
)
from ..plans.audits import failure_report
from ..sources.standin import REPORT_BANK
from .registry import check


@check(
    "a01_group_max",
    """SELECT CustomerKey, max(ChangeDate) AS LatestDate FROM src_rating_history
       WHERE CreditRatingKey IN ('B5', 'P9', 'C5') GROUP BY CustomerKey""",
)
def _(t):
    return (
        t.sources["rating_history"]
        .filter(F.col("CreditRatingKey").isin(*config.LATEST_BLOCK_CODES))
        .groupBy("CustomerKey")
        .agg(F.max("ChangeDate").alias("LatestDate"))
    )


@check(
    "a02_rows_at_latest",
    """SELECT h.CustomerKey, h.ChangeDate, h.CreditRatingKey, h.SysUserKey
       FROM src_rating_history h
       JOIN (SELECT CustomerKey, max(ChangeDate) AS LatestDate FROM src_rating_history
             WHERE CreditRatingKey IN ('B5', 'P9', 'C5') GROUP BY CustomerKey) m
         ON m.CustomerKey = h.CustomerKey AND m.LatestDate = h.ChangeDate""",
)
def _(t):
    return rows_at_latest(
        t.sources["rating_history"], "CustomerKey", "ChangeDate",
        F.col("CreditRatingKey").isin(*config.LATEST_BLOCK_CODES),
    )


@check(
    "a03_having",
    """SELECT AccountKey, CreateDate, count(*) AS cnt FROM src_customer
       GROUP BY AccountKey, CreateDate HAVING count(*) > 1""",
)
def _(t):
    return duplicates(t.sources["customer"], ["AccountKey", "CreateDate"])


@check(
    "a04_count_distinct",
    """SELECT CreditRatingKey, count(DISTINCT AccountKey) AS accounts, count(*) AS cards
       FROM src_customer GROUP BY CreditRatingKey""",
)
def _(t):
    return t.sources["customer"].groupBy("CreditRatingKey").agg(
        F.countDistinct("AccountKey").alias("accounts"), F.count(F.lit(1)).alias("cards")
    )


@check("a05_count", "SELECT count(*) AS cnt FROM src_rating_history")
def _(t):
    return t.sources["rating_history"].agg(F.count(F.lit(1)).alias("cnt"))


@check("a06_distinct", "SELECT DISTINCT AccountKey, CreditRatingKey FROM src_customer")
def _(t):
    return t.sources["customer"].select("AccountKey", "CreditRatingKey").distinct()


@check(
    "a07_bucket_count",
    "SELECT Activation_step, count(*) AS cnt FROM src_account_master GROUP BY Activation_step",
)
def _(t):
    return t.master.groupBy(config.STEP_COLUMN).agg(F.count(F.lit(1)).alias("cnt"))


@check(
    "a08_failure_report",
    """SELECT Month_Year, ActicationActivityOrder, activityDesc, count(DISTINCT AccountKey) AS Cnt
       FROM x_report_fail2 GROUP BY Month_Year, ActicationActivityOrder, activityDesc""",
)
def _(t):
    online = t.master.filter(F.col("Channel") == config.ONLINE)
    return failure_report(online, t.sources, REPORT_BANK)


_RANKED = """(SELECT CustomerKey, AccountKey, CreateDate, CreditRatingKey,
    CAST(dense_rank() OVER (PARTITION BY AccountKey ORDER BY CreateDate DESC) AS INT) AS attempt FROM src_customer)"""


def _cards(t):
    return t.sources["customer"].select("CustomerKey", "AccountKey", "CreateDate", "CreditRatingKey")


@check(
    "w01_latest_with_ties",
    f"SELECT CustomerKey, AccountKey, CreateDate, CreditRatingKey FROM {_RANKED} WHERE attempt = 1",
)
def _(t):
    return latest_with_ties(_cards(t), "AccountKey", "CreateDate")


@check("w02_attempt", f"SELECT * FROM {_RANKED}")
def _(t):
    return with_attempt(_cards(t), "AccountKey", "CreateDate")


@check(
    "w03_latest_one",
    """SELECT CustomerKey, AccountKey, CreateDate, CreditRatingKey FROM (
           SELECT *, row_number() OVER (PARTITION BY AccountKey
               ORDER BY CreateDate DESC, CustomerKey DESC) AS rn FROM src_customer) WHERE rn = 1""",
)
def _(t):
    return latest_one(_cards(t), "AccountKey", ["CreateDate", "CustomerKey"], row_id="CustomerKey")


@check(
    "l01_limit",
    """SELECT least(10, count(*)) AS n_rows, least(10, count(*)) AS n_of_master FROM src_account_master""",
)
def _(t):
    # Which rows come is open; how many, and that the master has them, is not.
    rows = preview(t.master, 10)
    found = rows.join(t.master.select(F.col("AccountKey").alias("held")).distinct(), F.expr("AccountKey <=> held"), "left")
    return found.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.expr("AccountKey <=> held")).alias("n_of_master"),
    )


@check(
    "l02_top_n",
    """SELECT AccountKey, Channel, Activation_step FROM src_account_master
       ORDER BY Activation_step DESC NULLS LAST, AccountKey LIMIT 20""",
)
def _(t):
    rows = t.master.select("AccountKey", "Channel", config.STEP_COLUMN)
    return top_n(rows, 20, [F.col(config.STEP_COLUMN).desc_nulls_last(), "AccountKey"])


@check(
    "u01_union_distinct",
    """SELECT CustomerKey, CreditRatingKey FROM src_rating_history
       UNION SELECT CustomerKey, CreditRatingKey FROM src_customer""",
)
def _(t):
    history = t.sources["rating_history"].select("CustomerKey", "CreditRatingKey")
    cards = t.sources["customer"].select("CustomerKey", F.col("CreditRatingKey").alias("rating"))
    return union_distinct(history, cards)
