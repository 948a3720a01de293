"""Daily update over accounts with known answers."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from world import (
    BEFORE,
    DAY,
    LIMIT,
    ONLINE_PERSO,
    ONLINE_TEMP,
    RETAIL_TEMP,
    VERIFICATION,
    WINDOW,
    World,
    by_account,
)

from activation_mart.plans import run_update

DONE = datetime(2012, 12, 12)
AFTER = datetime(2013, 3, 1)


def build_world() -> World:
    w = World()
    # 1: a new check; step overwritten, attempt value reset, then tagged.
    w.card(10, 1, CardActivationDate=DONE)
    w.validation(1001, 10, "Approved", None)
    w.add("identity_validation_status", IdentityValidationKey=1001,
          IdentityValidationVendorKey=4, IdentityValidationStatusTypeKey=1)
    w.held(1, VCustomerkey=10, Activation_step="Incomplete", LastAttemptValue="Old",
           HomePhone="kept")
    # 2: a check outside the window; nothing happens.
    w.card(20, 2)
    w.validation(1002, 20, on=AFTER)
    w.held(2, VCustomerkey=20, Activation_step="Incomplete")
    # 3: status change, but no P card; balances stay.
    w.card(30, 3, CurrBalance=Decimal("5.0000"))
    w.add("card_status_history", SerialNbr="S30", StartDate=DAY)
    w.held(3, TCustomerkey=30, TCurrBalance=Decimal("1.0000"), VCustomerkey=30)
    # 4: status change and a new check which moves the P card; balance is the new card's.
    w.card(40, 4, ONLINE_TEMP, CurrBalance=Decimal("4.0000"))
    w.card(41, 4, ONLINE_PERSO, CurrBalance=Decimal("41.0000"), CreateDate=BEFORE)
    w.card(42, 4, ONLINE_PERSO, CurrBalance=Decimal("42.0000"), CreditRatingKey="N1")
    w.add("card_status_history", SerialNbr="S40", StartDate=DAY)
    w.validation(1004, 40)
    w.held(4, TCustomerkey=40, PCustomerkey=41, PCurrBalance=Decimal("0.0000"), VCustomerkey=40)
    # 5: status change only; both balances refreshed, step untouched.
    w.card(50, 5)
    w.card(51, 5, ONLINE_PERSO, CurrBalance=Decimal("51.0000"))
    w.failure(50, LIMIT)
    w.add("card_status_history", SerialNbr="S51", StartDate=DAY)
    w.held(5, TCustomerkey=50, PCustomerkey=51, VCustomerkey=50, Activation_step="Incomplete")
    # 6: rating change in the window; the block comes from the whole history.
    w.card(60, 6, CreditRatingKey="B5")
    w.rating(60, "B5", on=BEFORE)
    w.rating(60, "A1")
    w.held(6, VCustomerkey=60)
    # 7: rating change, no block in force; the old block stays.
    w.card(70, 7)
    w.rating(70, "B5")
    w.held(7, VCustomerkey=70, BlockCreditratingkey="P9", BlockUser="Old User")
    # 8: online, a failed step is overwritten.
    w.card(80, 8)
    w.validation(1008, 80)
    w.failure(80, VERIFICATION)
    w.held(8, VCustomerkey=80, Activation_step="Approved", OOW="old")
    w.quiz(1008, None)
    # 9: retail, no rung holds; the old step is removed.
    w.card(90, 9, RETAIL_TEMP)
    w.validation(1009, 90, None)
    w.held(9, Channel="Retail", VCustomerkey=90, Activation_step="Approved")
    return w


@pytest.fixture(scope="module")
def result(spark):
    w = build_world()
    return by_account(run_update(w.sources(spark), w.master(spark), WINDOW))


def test_keeps_all_accounts(result):
    assert sorted(result) == list(range(1, 10))


def test_identity_patch_then_tag(result):
    row = result[1]
    assert row["Activation_step"] == "Approved"
    assert row["LastIdentityValidationKey"] == 1001
    assert row["LastAttemptValue"] == "Int"
    assert row["HomePhone"] == "kept"  # not among the patched columns


def test_check_outside_the_window(result):
    assert result[2]["LastIdentityValidationKey"] is None


def test_balance_needs_both_cards(result):
    assert result[3]["TCurrBalance"] == Decimal("1.0000")


def test_balance_reads_the_new_card(result):
    row = result[4]
    assert (row["PCustomerkey"], row["PCurrBalance"], row["PCreditRatingkey"]) == (
        42, Decimal("42.0000"), "N1",
    )


def test_status_change_alone(result):
    row = result[5]
    assert row["PCurrBalance"] == Decimal("51.0000")
    assert row["Activation_step"] == "Incomplete"


def test_block_from_whole_history(result):
    assert (result[6]["BlockCreditratingkey"], result[6]["BlockDate"]) == ("B5", BEFORE)


def test_lifted_block_is_not_cleared(result):
    assert result[7]["BlockCreditratingkey"] == "P9"


def test_online_step_is_overwritten(result):
    assert result[8]["Activation_step"] == "Ident_Verify"
    assert result[8]["OOW"] is None  # a quiz without result overwrites, too


def test_retail_step_is_overwritten_by_null(result):
    assert result[9]["Activation_step"] is None
