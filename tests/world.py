"""Source tables of a handful of accounts, for tests with known answers."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from activation_mart import config
from activation_mart.functions import RunWindow
from activation_mart.sources import Sources
from activation_mart.sources.registry import source_schema

WINDOW = RunWindow.parse("12/1/2012", "1/22/2013")
DAY = datetime(2012, 12, 10)
BEFORE = datetime(2012, 6, 1)

ONLINE_TEMP, NO_FLAG, RETAIL_TEMP, GIFT, RETAIL_PERSO, ONLINE_PERSO = range(1, 7)
VERIFICATION, ADDRESS, LIMIT, FRAUD, IP = 2, 20, 5, 8, 9
TRUSTED, STRANGER = 3227, 77

MASTER_SCHEMA = (
    "AccountKey bigint, CreateDate timestamp_ntz, BankKey int, BankName string, Channel string, "
    "LastIdentityValidationKey bigint, VerificationStatusType string, LastAttemptValue string, "
    "BlockCreditratingkey string, BlockDate timestamp_ntz, BlockUser string, "
    "TCustomerkey bigint, TCreditRatingkey string, TCurrBalance decimal(19,4), "
    "PCustomerkey bigint, PCreditRatingkey string, PCurrBalance decimal(19,4), "
    "VCustomerkey bigint, DOB date, CardActivationDate timestamp_ntz, ProductKey int, "
    "HomePhone string, CellPhone string, Email string, ResidentialAddress1 string, "
    "ResidentialAddress2 string, ResidentialCity string, ResidentialState string, "
    "ResidentialZipcode string, Address1 string, Address2 string, City string, State string, "
    "ZipCode string, Activation_step string, OOW string"
)


class World:
    def __init__(self):
        self.rows: dict[str, list[dict]] = {name: [] for name in config.SOURCE_SCHEMAS}
        self.master_rows: list[dict] = []
        flags = {
            ONLINE_TEMP: (True, 1, False), NO_FLAG: (None, 1, False), RETAIL_TEMP: (False, 1, False),
            GIFT: (True, 2, False), RETAIL_PERSO: (False, 1, True), ONLINE_PERSO: (True, 1, True),
        }
        for key, (online, card_type, atm) in flags.items():
            self.add("product", ProductKey=key, BankKey=key % 2, isOnlineProduct=online,
                     ourcardtypekey=card_type, isatm=atm)
        for key in (0, 1):
            self.add("bank", BankKey=key, BankName=f"Bank {key}")
        for key, text in ((VERIFICATION, "Customer Verification"), (ADDRESS, "Address Validation"),
                          (LIMIT, "Partner Card Limit"), (FRAUD, "Fraud Check"), (IP, "IP Validation")):
            self.add("activation_activity_type", ActivationActivityTypeKey=key,
                     ActivationActivityType=text)
        for key in (1, 2):
            self.add("activation_type", ActivationTypeKey=key)
        for key in (1, 2, 3, 4):
            self.add("identity_validation_vendor", IdentityValidationVendorKey=key)
            self.add("identity_validation_status_type", IdentityValidationStatusTypeKey=key)
        self.add("sys_user", SysUserKey=TRUSTED, FullName="Trusted User")
        self.add("sys_user", SysUserKey=STRANGER, FullName="Some User")

    def add(self, table: str, **values) -> None:
        self.rows[table].append(values)

    def card(self, customer: int, account: int | None, product: int = ONLINE_TEMP, **values) -> None:
        row = dict(
            CustomerKey=customer, AccountKey=account, ProductKey=product, SerialNbr=f"S{customer}",
            CreateDate=DAY, FirstName="First", LastName="Last", DOB=date(1980, 1, 1), SSN="given",
            CellPhone="1", ResidentialAddress1="Road", ResidentialZipcode="1", CreditRatingKey="A1",
            CurrBalance=Decimal("0.0000"),
        )
        self.add("customer", **{**row, **values})

    def validation(self, key: int, customer: int, status: str | None = "Declined",
                   attempt: str | None = "Fail", on: datetime = DAY) -> None:
        self.add("identity_validation", IdentityValidationKey=key, CreateDate=on,
                 VerificationStatusType=status, LastAttemptValue=attempt)
        self.add("identity_validation_customer", IdentityValidationKey=key, CustomerKey=customer)

    def failure(self, customer: int, kind: int, confirmed: bool = False, channel: int = 2,
                on: datetime = DAY) -> None:
        self.add("activation_activity", CustomerKey=customer, ActivationTypeKey=channel,
                 ActivationActivityTypeKey=kind, IsConfirmed=confirmed,
                 ActivationActivityCreateDate=on)

    def quiz(self, key: int, code: str | None, risk: bool = True) -> None:
        self.add("quiz", IdentityValidationKey=key, QuizResultCode=code)
        if risk:
            self.add("risk", IdentityValidationKey=key, RiskValue="R")

    def rating(self, customer: int, code: str, user: int = STRANGER, on: datetime = DAY) -> None:
        self.add("rating_history", CustomerKey=customer, ChangeDate=on, CreditRatingKey=code,
                 SysUserKey=user)

    def refund(self, customer: int, reason: int | None) -> None:
        self.add("refund", CustomerKey=customer, refundreasonkey=reason)

    def held(self, account: int, **values) -> None:
        """A row of the master as it is before the run."""
        row = dict(AccountKey=account, CreateDate=BEFORE, Channel="Online", DOB=date(1980, 1, 1),
                   CellPhone="1", ResidentialAddress1="Road", ResidentialZipcode="1")
        self.master_rows.append({**row, **values})

    def sources(self, spark) -> Sources:
        return Sources.from_frames(
            spark,
            {name: frame(spark, rows, source_schema(name)) for name, rows in self.rows.items()},
        )

    def master(self, spark):
        from pyspark.sql.types import StructType

        return frame(spark, self.master_rows, StructType.fromDDL(MASTER_SCHEMA))


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(row.get(n) for n in schema.names) for row in rows], schema)


def by_account(df) -> dict[int, dict]:
    rows = [row.asDict() for row in df.collect()]
    out = {row["AccountKey"]: row for row in rows}
    assert len(out) == len(rows), "more than one row for an account"
    return out
