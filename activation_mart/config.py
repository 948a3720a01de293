"""Constants the results depend on, and the few settings a site has to supply."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: master schema -------------------------------------------

MASTER_COLUMNS = (
    "AccountKey", "CreateDate", "BankKey", "BankName", "Channel",
    "LastIdentityValidationKey", "VerificationStatusType", "LastAttemptValue",
    "BlockCreditratingkey", "BlockDate", "BlockUser",
    "TCustomerkey", "TCreditRatingkey", "TCurrBalance",
    "PCustomerkey", "PCreditRatingkey", "PCurrBalance",
    "VCustomerkey", "DOB", "CardActivationDate", "ProductKey",
    "HomePhone", "CellPhone", "Email",
    "ResidentialAddress1", "ResidentialAddress2", "ResidentialCity",
    "ResidentialState", "ResidentialZipcode",
    "Address1", "Address2", "City", "State", "ZipCode",
)
STEP_COLUMN = "Activation_step"
QUIZ_COLUMN = "OOW"
SURROGATE_COLUMN = "Tablekey"

# --- Fixed values: source schemas (name -> Spark DDL) -----------------------

SOURCE_SCHEMAS = {
    "customer": (
        "CustomerKey bigint, AccountKey bigint, ProductKey int, SerialNbr string, "
        "CreateDate timestamp_ntz, SecretWord string, FirstName string, LastName string, "
        "Address1 string, Address2 string, City string, State string, ZipCode string, "
        "ResidentialAddress1 string, ResidentialAddress2 string, ResidentialCity string, "
        "ResidentialState string, ResidentialZipcode string, "
        "HomePhone string, CellPhone string, Email string, "
        "CreditRatingKey string, CurrBalance decimal(19,4), DOB date, "
        "CardActivationDate timestamp_ntz, ParentFirstName string, ParentLastName string, "
        "SSN string, ParentSSN string, ParentDOB date, activationstatuskey int, "
        "ActivationSysUserKey int, SysUserKey int"
    ),
    "product": (
        "ProductKey int, BankKey int, isOnlineProduct boolean, "
        "ourcardtypekey int, isatm boolean"
    ),
    "bank": "BankKey int, BankName string",
    "identity_validation": (
        "IdentityValidationKey bigint, CreateDate timestamp_ntz, "
        "VerificationStatusType string, LastAttemptValue string"
    ),
    "identity_validation_customer": "IdentityValidationKey bigint, CustomerKey bigint",
    "identity_validation_status": (
        "IdentityValidationKey bigint, CreateDate timestamp_ntz, "
        "ValidationResultCode string, IdentityValidationStatusTypeKey int, "
        "IdentityValidationVendorKey int"
    ),
    "identity_validation_status_type": (
        "IdentityValidationStatusTypeKey int, IdentityValidationStatusType string"
    ),
    "identity_validation_vendor": (
        "IdentityValidationVendorKey int, IdentityValidationVendor string"
    ),
    "quiz": "IdentityValidationKey bigint, QuizResultCode string",
    "risk": "IdentityValidationKey bigint, RiskValue string",
    "rating_history": (
        "CustomerKey bigint, ChangeDate timestamp_ntz, CreditRatingKey string, SysUserKey int"
    ),
    "sys_user": "SysUserKey int, FullName string",
    "card_status_history": "SerialNbr string, StartDate timestamp_ntz",
    "activation_activity": (
        "CustomerKey bigint, ActivationTypeKey int, ActivationActivityTypeKey int, "
        "IsConfirmed boolean, ActivationActivityCreateDate timestamp_ntz"
    ),
    "activation_type": "ActivationTypeKey int",
    "activation_activity_type": (
        "ActivationActivityTypeKey int, ActivationActivityType string"
    ),
    "refund": "CustomerKey bigint, refundreasonkey int, comment string",
    "refund_reason": "refundreasonkey int, refundreason string",
    "activation_status": "activationstatuskey int, activationstatus string",
    "account_address": (
        "AccountKey bigint, addressTypekey int, AddressStandardizationResultKey bigint, "
        "CreateDate timestamp_ntz"
    ),
    "address_result": "AddressStandardizationResultKey bigint, MatchLevel string",
}

# --- Fixed values: activity type order (key, order, active, description) ----

ACTIVITY_TYPE_ORDER = (
    (9, 1, True, "IP Validation"),
    (3, 2, True, "Age Verification"),
    (20, 3, True, "Address Validation"),
    (5, 5, True, "Partner Card Limit"),
    (2, 6, True, "Customer Verification and Incomplete Customer Activation"),
    (12, 7, True, "Activation Error (General Exception)"),
    (8, 8, True, "Fraud Check"),
    (10000, 9, True, "OOW Declined"),
)

# --- Fixed values: codes, labels and keys -----------------------------------

LATEST_BLOCK_CODES = ("B5", "P9", "C5")
OPEN_BLOCK_CODES = ("B5", "P9", "B3")
RESTRICTED_BLOCK_CODE = "C5"
TRUSTED_BLOCK_USERS = (
    3227, 2933, 989, 1884, 4561, 4562, 988, 2370, 4153, 2690, 2687, 6838, 4176,
    7347, 7090, 6917, 6918,
)
STANDARD_CARD_TYPE = 1
ONLINE_ACTIVATION_TYPE = 2
ONLINE, RETAIL = "Online", "Retail"
APPROVED = "Approved"
FAILED_QUIZ_CODES = ("refer_incomplete", "refer")
NEGATIVE_MATCH_ORDER, NEGATIVE_MATCH_TEXT = 4, "Negative Match"
QUIZ_FAILURE_ORDER, QUIZ_FAILURE_TEXT = 10000, "OOW Declined"
INTERNAL_VENDOR, INTERNAL_STATUS_TYPE, INTERNAL_TAG = 4, 1, "Int"
NEGATIVE_STATUS_KEYS, NEGATIVE_REFUND = (50, 140), 8
LIMIT_STATUS_KEYS, LIMIT_REFUND = (145,), 23
ADULT_MONTHS = 216
RESIDENTIAL_ADDRESS, MAILING_ADDRESS = 2, 1


# --- Settings ----------------------------------------------------------------

@dataclass(frozen=True)
class TestAccountRules:
    """LIKE patterns, per customer column, of accounts opened for testing.

    The secret word of test accounts, the house street address and the e-mail
    domain differ per site and have no default: give them as ``secret_words``,
    ``house_addresses`` and ``house_emails``.
    """

    __test__ = False

    secret_words: tuple[str, ...] = ()
    names: tuple[str, ...] = ("test%",)
    house_addresses: tuple[str, ...] = ()
    house_emails: tuple[str, ...] = ()

    def patterns(self) -> dict[str, tuple[str, ...]]:
        return {
            "SecretWord": self.secret_words,
            "FirstName": self.names,
            "LastName": self.names,
            "Address1": self.house_addresses,
            "ResidentialAddress1": self.house_addresses,
            "Email": self.house_emails,
        }


@dataclass(frozen=True)
class MartConfig:
    test_accounts: TestAccountRules = field(default_factory=TestAccountRules)
    trusted_block_users: tuple[int, ...] = TRUSTED_BLOCK_USERS
    # Products with this flag are personalised cards, the others temporary ones.
    personalised_flag: str = "isatm"


DEFAULT_CONFIG = MartConfig()
