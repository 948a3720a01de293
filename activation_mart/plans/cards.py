"""Temporary, personalised and verification card of each account."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..operators import order_number
from ..session import settle
from ..sources import Sources

CONTACT_COLUMNS = (
    "DOB", "CardActivationDate", "ProductKey", "HomePhone", "CellPhone", "Email",
    "ResidentialAddress1", "ResidentialAddress2", "ResidentialCity", "ResidentialState",
    "ResidentialZipcode", "Address1", "Address2", "City", "State", "ZipCode",
)
BALANCE_COLUMNS = ("PCreditRatingkey", "PCurrBalance", "TCreditRatingkey", "TCurrBalance")
#: What the checks, cards and blocks of given accounts need of their customers.
CARD_COLUMNS = (
    "AccountKey", "CustomerKey", "CreateDate", "CreditRatingKey", "CurrBalance", *CONTACT_COLUMNS,
)


def cards_of(src: Sources, accounts: DataFrame) -> Sources:
    """The same sources with only the cards of the accounts, settled: customers are read once for all that follows."""
    cards = src["customer"].select(*CARD_COLUMNS).join(
        accounts.select("AccountKey"), "AccountKey", "left_semi"
    )
    return src.holding(customer=settle(cards, "cards"))


def winning_cards(
    src: Sources, cfg: config.MartConfig = config.DEFAULT_CONFIG, accounts: DataFrame | None = None
) -> DataFrame:
    """(AccountKey, TCustomerkey, PCustomerkey): keys of the latest temporary and personalised card.

    Only the card's keys and date enter the aggregate, all of fixed width, so it
    hashes and combines before the shuffle.
    """
    cards = src["customer"].select("AccountKey", "CustomerKey", "CreateDate", "ProductKey").filter(
        "AccountKey is not null"
    )
    if accounts is not None:
        cards = cards.join(accounts.select("AccountKey"), "AccountKey", "left_semi")
    products = src["product"].select(
        "ProductKey", F.coalesce(F.col(cfg.personalised_flag), F.lit(False)).alias("__perso")
    )
    ordered = cards.withColumn("__number", order_number(cards, ["CreateDate", "CustomerKey"]))
    perso, number = F.col("__perso"), F.col("__number")
    return (
        ordered.join(products, "ProductKey")
        .groupBy("AccountKey")
        .agg(
            F.max_by("CustomerKey", F.when(~perso, number)).alias("TCustomerkey"),
            F.max_by("CustomerKey", F.when(perso, number)).alias("PCustomerkey"),
        )
    )


def card_resolution(
    src: Sources,
    cfg: config.MartConfig = config.DEFAULT_CONFIG,
    accounts: DataFrame | None = None,
) -> DataFrame:
    """One row per account: its latest temporary (T) and personalised (P) card.

    The verification card (V) is T, or P where there is no T; contact columns
    are V's. The cards are chosen on their keys alone. Then each account has a
    row for V, and one for P where V is another card, and these rows fetch the
    wide columns: the customers stream past them unsorted, and only the winners'
    contact columns are dealt again. A customer key names one customer.
    """
    winners = winning_cards(src, cfg, accounts).withColumn(
        "VCustomerkey", F.coalesce("TCustomerkey", "PCustomerkey")
    )
    wanted = winners.select(
        "*", F.explode(F.expr("array_compact(array(VCustomerkey, CASE WHEN TCustomerkey IS NOT NULL THEN PCustomerkey END))")).alias("__card")
    )
    customers = src["customer"].select("CustomerKey", "CreditRatingKey", "CurrBalance", *CONTACT_COLUMNS)
    fetched = settle(
        customers.join(wanted.hint("shuffle_hash"), F.col("CustomerKey") == F.col("__card")), "cards"
    )
    verified = fetched.filter("CustomerKey = VCustomerkey")
    second = fetched.filter("CustomerKey <> VCustomerkey").select(
        "AccountKey", F.col("CreditRatingKey").alias("__rating"), F.col("CurrBalance").alias("__balance")
    )
    both = verified.join(second, "AccountKey", "left")
    own, other = {"rating": "CreditRatingKey", "balance": "CurrBalance"}, {"rating": "__rating", "balance": "__balance"}

    def value(role: str, part: str) -> str:
        if role == "T":
            return f"CASE WHEN TCustomerkey IS NOT NULL THEN {own[part]} END"
        return f"CASE WHEN TCustomerkey IS NULL THEN {own[part]} ELSE {other[part]} END"

    return both.selectExpr(
        "AccountKey",
        *(
            column
            for role in ("T", "P")
            for column in (
                f"{role}Customerkey", f"{value(role, 'rating')} AS {role}CreditRatingkey",
                f"{value(role, 'balance')} AS {role}CurrBalance",
            )
        ),
        "VCustomerkey",
        *CONTACT_COLUMNS,
    )


def card_roles(accounts: DataFrame) -> DataFrame:
    """(AccountKey, role, CustomerKey): the P and the T card of accounts that have both."""
    both = accounts.filter("AccountKey IS NOT NULL AND PCustomerkey IS NOT NULL AND TCustomerkey IS NOT NULL")
    return both.selectExpr("AccountKey", "stack(2, 'P', PCustomerkey, 'T', TCustomerkey) AS (role, CustomerKey)")


def balance_patch(accounts: DataFrame, src: Sources) -> DataFrame:
    """Fresh ratings and balances of accounts that have both a P and a T card, one row each.

    The two cards of an account are two rows, which meet the customers in one
    join and are folded again: customers are read and dealt once for both. The
    accounts' keys are on the side that may be broadcast, or whose Bloom filter
    cuts the customers before their shuffle.
    """
    cards = src["customer"].select("CustomerKey", "CreditRatingKey", "CurrBalance")
    found = cards.join(card_roles(accounts), "CustomerKey")
    card = F.struct(F.col("CreditRatingKey").alias("rating"), F.col("CurrBalance").alias("balance"))
    roles = {role: F.max(F.when(F.col("role") == role, card)).alias(role) for role in ("P", "T")}
    folded = found.groupBy("AccountKey").agg(*roles.values()).filter("P IS NOT NULL AND T IS NOT NULL")
    return folded.selectExpr(
        "AccountKey", "P.rating AS PCreditRatingkey", "P.balance AS PCurrBalance",
        "T.rating AS TCreditRatingkey", "T.balance AS TCurrBalance",
    )
