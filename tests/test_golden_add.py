"""Daily add over accounts with known answers."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from world import (
    ADDRESS,
    BEFORE,
    DAY,
    FRAUD,
    GIFT,
    IP,
    LIMIT,
    NO_FLAG,
    RETAIL_PERSO,
    RETAIL_TEMP,
    TRUSTED,
    VERIFICATION,
    WINDOW,
    World,
    by_account,
)

from activation_mart import config
from activation_mart.plans import run_add

CONFIG = config.MartConfig(
    test_accounts=config.TestAccountRules(
        house_addresses=("%12 SAMPLE PLAZA%",), house_emails=("%@issuer.example%",)
    )
)
DONE = datetime(2012, 12, 12)


def build_world() -> World:
    w = World()
    # Extract
    w.card(10, 1, FirstName="tEsTer")
    w.card(20, 2, FirstName=None, LastName=None, SecretWord=None, Email=None)
    w.card(30, 3, CreateDate=WINDOW.start)
    w.card(40, 4, CreateDate=WINDOW.end)
    w.card(50, 5, NO_FLAG)
    w.card(60, 6)
    w.card(61, 6)
    w.card(70, 7)
    w.held(7, CreateDate=BEFORE, Activation_step="Approved", VCustomerkey=70)
    w.card(80, 8, GIFT)
    w.card(90, None)
    w.card(91, 9, Address1="at 12 Sample Plaza")
    w.card(92, 9, Email="qa@ISSUER.example")
    # Blocks
    w.card(100, 10, CreditRatingKey="C5")
    w.rating(100, "B5", on=datetime(2012, 12, 2))
    w.rating(100, "C5", on=datetime(2012, 12, 3))
    w.card(110, 11, CreditRatingKey="B3")
    w.rating(110, "P9")
    w.rating(110, "B3")
    w.card(120, 12, CreditRatingKey="A1")
    w.rating(120, "B5")
    w.card(130, 13, CreditRatingKey="C5")
    w.rating(130, "C5", TRUSTED)
    w.card(140, 14, CreditRatingKey="B5")
    w.rating(140, "B5", on=BEFORE)
    # Cards
    w.card(150, 15, RETAIL_PERSO, CreateDate=datetime(2012, 12, 20))
    w.card(151, 15, RETAIL_TEMP, CreateDate=datetime(2012, 12, 5), CellPhone="temp")
    w.card(160, 16, RETAIL_PERSO, CellPhone="perso")
    # Online steps
    for account in (20, 21, 23, 24, 25, 26, 27, 29):
        approved = account == 20
        w.card(account * 10, account, CardActivationDate=DONE if approved else None)
        w.validation(1000 + account, account * 10, "APPROVED " if approved else "Declined")
    w.failure(200, VERIFICATION)
    w.failure(210, VERIFICATION)
    w.card(220, 22)
    w.failure(220, VERIFICATION)
    w.failure(230, FRAUD)
    w.failure(240, ADDRESS)
    w.failure(240, LIMIT)
    w.failure(250, VERIFICATION)
    w.quiz(1025, "Refer")
    w.quiz(1025, "accept")
    w.failure(260, VERIFICATION)
    w.quiz(1026, "refer_incomplete", risk=False)
    w.failure(270, IP)
    w.failure(290, LIMIT, confirmed=True)
    w.failure(290, LIMIT, channel=1)
    w.card(280, 28, CreateDate=BEFORE)
    w.failure(280, LIMIT)
    w.held(28, VCustomerkey=280)
    # Retail steps
    young = dict(CreateDate=datetime(2012, 12, 10))
    w.card(400, 40, RETAIL_TEMP, DOB=date(1994, 12, 31), **young)
    w.card(410, 41, RETAIL_TEMP, DOB=date(1995, 1, 1), **young)
    w.card(411, 42, RETAIL_TEMP, DOB=date(1995, 1, 1), ParentFirstName="P", ParentLastName="P",
           ParentSSN="given", ParentDOB=date(1960, 1, 1))
    w.card(420, 43, RETAIL_TEMP, FirstName=None, ParentFirstName="P")
    w.card(430, 44, RETAIL_TEMP, activationstatuskey=140)
    w.card(440, 45, RETAIL_TEMP)
    w.refund(440, 8)
    w.card(450, 46, RETAIL_TEMP, activationstatuskey=145)
    w.card(460, 47, RETAIL_TEMP)
    w.refund(460, 23)
    w.card(470, 48, RETAIL_TEMP)
    w.held(48, CreateDate=DAY, Channel="Retail", VCustomerkey=470, Activation_step="Approved")
    w.card(480, 49, RETAIL_TEMP)
    w.refund(480, 23)
    w.refund(480, 8)
    for account, reasons in ((50, (8, None)), (51, (8,)), (52, ())):
        w.card(account * 10, account, RETAIL_TEMP)
        w.validation(1000 + account, account * 10)
        w.quiz(1000 + account, "refer")
        for reason in reasons:
            w.refund(account * 10, reason)
    w.card(530, 53, RETAIL_TEMP)
    w.validation(1053, 530)
    w.card(540, 54, RETAIL_TEMP, CardActivationDate=DONE, activationstatuskey=50)
    w.validation(1054, 540, "Approved", "Pass")
    # Internal look-up
    for account, vendor in ((60, 4), (61, 3)):
        w.card(account * 10, account, RETAIL_TEMP, CardActivationDate=DONE)
        w.validation(1000 + account, account * 10, "Approved", None)
        w.add("identity_validation_status", IdentityValidationKey=1000 + account,
              IdentityValidationVendorKey=vendor, IdentityValidationStatusTypeKey=1)
    # Latest of several checks
    w.card(620, 62)
    w.card(621, 62)
    w.validation(1062, 620, "Approved", on=datetime(2012, 12, 11))
    w.validation(1063, 621, "Declined", on=datetime(2012, 12, 11))
    w.validation(1064, 621, "Approved", on=datetime(2012, 12, 9))
    return w


@pytest.fixture(scope="module")
def result(spark):
    w = build_world()
    return by_account(run_add(w.sources(spark), w.master(spark), WINDOW, CONFIG))


@pytest.mark.parametrize("account", [1, 4, 8, 9, None])
def test_not_added(result, account):
    assert account not in result


@pytest.mark.parametrize("account", [2, 3, 5, 6])
def test_added(result, account):
    assert account in result


def test_channel_without_flag_is_retail(result):
    assert result[5]["Channel"] == "Retail"
    assert result[3]["Channel"] == "Online"


def test_held_account_is_not_replaced(result):
    assert result[7]["CreateDate"] == BEFORE
    assert result[7]["Activation_step"] == "Approved"


def test_no_check_leaves_nulls(result):
    assert result[3]["LastIdentityValidationKey"] is None
    assert result[3]["VerificationStatusType"] is None


def test_latest_check_breaks_ties_by_key(result):
    assert result[62]["LastIdentityValidationKey"] == 1063


@pytest.mark.parametrize(
    "account, code, user",
    [(10, None, None), (11, "B3", "Some User"), (12, None, None), (13, "C5", "Trusted User"),
     (14, None, None)],
)
def test_blocks(result, account, code, user):
    assert result[account]["BlockCreditratingkey"] == code
    assert result[account]["BlockUser"] == user


def test_cards(result):
    both, perso = result[15], result[16]
    assert (both["TCustomerkey"], both["PCustomerkey"], both["VCustomerkey"]) == (151, 150, 151)
    assert both["CellPhone"] == "temp"
    assert (perso["TCustomerkey"], perso["PCustomerkey"], perso["VCustomerkey"]) == (None, 160, 160)
    assert perso["CellPhone"] == "perso"


@pytest.mark.parametrize(
    "account, step",
    [(20, "Approved"), (21, "Ident_Verify"), (22, "Neg_Match"), (23, "Neg_Match"),
     (24, "Addr_Verify"), (25, "OOW"), (26, "Ident_Verify"), (27, "Incomplete"),
     (28, "Card_Limit"), (29, "Incomplete")],
)
def test_online_steps(result, account, step):
    assert result[account]["Activation_step"] == step


@pytest.mark.parametrize(
    "account, step",
    [(40, None), (41, "Missing_Info"), (42, None), (43, "Missing_Info"), (44, "Neg_Match"),
     (45, "Neg_Match"), (46, "Card_Limit"), (47, "Card_Limit"), (48, None), (49, "Neg_Match"),
     (50, "OOW"), (51, "Neg_Match"), (52, "OOW"), (53, "Ident_Verify"), (54, "Approved")],
)
def test_retail_steps(result, account, step):
    assert result[account]["Activation_step"] == step


def test_quiz_column_takes_the_greatest_result(result):
    assert result[25]["OOW"] == "accept"
    assert result[26]["OOW"] == "refer_incomplete"
    assert result[27]["OOW"] is None


def test_internal_tag(result):
    assert result[60]["LastAttemptValue"] == "Int"
    assert result[61]["LastAttemptValue"] is None


def test_second_add_changes_nothing(spark, result):
    w = build_world()
    src = w.sources(spark)
    once = run_add(src, w.master(spark), WINDOW, CONFIG)
    assert by_account(run_add(src, once, WINDOW, CONFIG)) == result


