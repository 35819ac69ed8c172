"""The ten bank tables: columns, keys, domains, rules and parents, stated once.

Everything else (reading, validation, standardising, audits, publication) is driven by
this registry.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from vaultline.operators import rules as R

# The closed domains.
ACCOUNT_TYPES = ("Savings", "Current", "Salary", "Fixed Deposit", "NRI")
ACCOUNT_STATUSES = ("Active", "Dormant", "Closed")
TRANSACTION_TYPES = ("Deposit", "Withdrawal", "Transfer Out", "Transfer In", "Fee Debit", "Interest Credit")
CHANNELS = ("Mobile App", "Branch", "ATM", "UPI", "POS", "Online Banking")
LOAN_TYPES = ("Auto Loan", "Business Loan", "Education Loan", "Gold Loan", "Home Loan", "Personal Loan")
LOAN_STATUSES = ("Active", "Closed", "Defaulted", "Written Off")
CARD_TYPES = ("Debit", "Credit - Classic", "Credit - Gold", "Credit - Platinum")
CARD_STATUSES = ("Active", "Blocked", "Expired")
EMPLOYEE_ROLES = (
    "Teller", "Customer Service", "Relationship Manager", "Loan Officer", "Branch Manager", "Compliance Officer",
)
TICKET_STATUSES = ("Resolved", "Open", "Escalated")

# Mail address form, credit score bounds, tolerance of a payment split.
EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
CREDIT_SCORE_LOW, CREDIT_SCORE_HIGH = 300, 850
SPLIT_TOLERANCE = 0.05

ROUNDED, AS_TYPED = "rounded", "as_typed"


@dataclass(frozen=True)
class Field:
    """One column: how it is read (``kind``), how it is cleaned, and what its curated type allows."""

    name: str
    kind: str  # key | text | date | number
    type: T.DataType
    clean: str = AS_TYPED
    required: bool = False
    max_length: int | None = None
    check: str | None = None


@dataclass(frozen=True)
class Parent:
    """A foreign key. ``validated`` ones reject rows; all are audited before publication."""

    column: str
    table: str
    validated: bool = True


@dataclass(frozen=True)
class Table:
    name: str
    key: str
    fields: tuple[Field, ...]
    parents: tuple[Parent, ...]
    rules: tuple[R.Rule, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type) for f in self.fields])

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    @property
    def validated_parents(self) -> tuple[Parent, ...]:
        return tuple(p for p in self.parents if p.validated)


def key(name: str) -> Field:
    return Field(name, "key", T.LongType(), required=True)


def text(name: str, length: int, clean: str = "strip", required: bool = False) -> Field:
    return Field(name, "text", T.StringType(), clean, required, length)


def date(name: str, required: bool = False) -> Field:
    return Field(name, "date", T.DateType(), required=required)


def money(name: str, precision: int, scale: int = 2, check: str | None = None, clean: str = ROUNDED,
          required: bool = True) -> Field:
    return Field(name, "number", T.DecimalType(precision, scale), clean, required, check=check)


def whole(name: str, check: str | None = None, required: bool = True, type: T.DataType | None = None) -> Field:
    return Field(name, "number", type or T.IntegerType(), required=required, check=check)


def _identity(name: str, entity: str) -> tuple[R.Rule, ...]:
    return R.missing_key(name, entity), R.non_numeric_key(name, entity), R.duplicate_key(name, entity)


BRANCHES = Table(
    "branches",
    "branch_id",
    (
        key("branch_id"),
        text("branch_name", 150, "title", True),
        text("city", 100, "title", True),
        text("state", 100, "title", True),
        date("opened_date"),
        text("ifsc_code", 30, "upper", True),
    ),
    (),
    (
        *_identity("branch_id", "Branch"),
        R.blank("branch_name", reason="Missing Branch Name"),
        R.blank("city", "state", reason="Missing City or State"),
        R.bad_date("opened_date", reason="Invalid Opened Date"),
        R.blank("ifsc_code", reason="Missing IFSC Code"),
    ),
)

EMPLOYEES = Table(
    "employees",
    "employee_id",
    (
        key("employee_id"),
        text("name", 150, "title", True),
        key("branch_id"),
        text("role", 100, "title_words", True),
        date("hire_date"),
        money("salary", 12, check="salary > 0"),
    ),
    (Parent("branch_id", "branches"),),
    (
        *_identity("employee_id", "Employee"),
        R.orphan_key("branch_id", "Branch", "Branches"),
        R.not_in_domain("role", EMPLOYEE_ROLES, "Invalid Employee Role ({})"),
        R.out_of_range("salary", "Invalid Salary ({})", above=0),
        R.bad_date("hire_date", reason="Invalid Hire Date"),
    ),
)

CUSTOMERS = Table(
    "customers",
    "customer_id",
    (
        key("customer_id"),
        text("name", 150, "title", True),
        text("gender", 20, "capitalise"),
        date("date_of_birth"),
        text("city", 100, "title"),
        text("state", 100, "title"),
        text("phone", 30, "raw"),
        text("email", 150, "lower", True),
        text("occupation", 100, "title"),
        money("annual_income", 15, check="annual_income > 0", clean=AS_TYPED, required=False),
        date("join_date"),
        whole("credit_score", "credit_score BETWEEN 300 AND 850", required=False),
    ),
    (),
    (
        *_identity("customer_id", "Customer"),
        R.pattern_mismatch("email", EMAIL, "Invalid Email"),
        R.out_of_range("credit_score", "Invalid Credit Score ({})", low=CREDIT_SCORE_LOW, high=CREDIT_SCORE_HIGH),
        R.out_of_range("annual_income", "Non-positive Annual Income", above=0),
    ),
)

ACCOUNTS = Table(
    "accounts",
    "account_id",
    (
        key("account_id"),
        key("customer_id"),
        key("branch_id"),
        text("account_type", 50, "account_type", True),
        money("balance", 15, check="balance >= 0"),
        date("open_date"),
        text("status", 30, "capitalise", True),
    ),
    (Parent("customer_id", "customers"), Parent("branch_id", "branches", validated=False)),
    (
        *_identity("account_id", "Account"),
        R.orphan_key("customer_id", "Customer", "Customers"),
        R.out_of_range("balance", "Invalid Balance ({})", low=0),
        R.not_in_domain("account_type", ACCOUNT_TYPES, "Invalid Account Type ({})"),
        R.not_in_domain("status", ACCOUNT_STATUSES, "Invalid Status ({})", as_status=True),
    ),
)

TRANSACTIONS = Table(
    "transactions",
    "transaction_id",
    (
        key("transaction_id"),
        key("account_id"),
        date("txn_date", True),
        text("txn_type", 50, "title_words", True),
        money("amount", 15, check="amount > 0"),
        text("channel", 50, "title_words"),
        text("merchant_category", 100, "title"),
    ),
    (Parent("account_id", "accounts"),),
    (
        *_identity("transaction_id", "Transaction"),
        R.orphan_key("account_id", "Account", "Accounts"),
        R.out_of_range("amount", "Invalid Transaction Amount ({})", above=0),
        R.not_in_domain("txn_type", TRANSACTION_TYPES, "Invalid Transaction Type ({})"),
        R.not_in_domain("channel", CHANNELS, "Invalid Channel ({})"),
        R.bad_date("txn_date", reason="Invalid Date format ({})"),
    ),
)

LOANS = Table(
    "loans",
    "loan_id",
    (
        key("loan_id"),
        key("customer_id"),
        key("branch_id"),
        text("loan_type", 50, "title_words", True),
        money("loan_amount", 15, check="loan_amount > 0"),
        money("interest_rate", 5),
        whole("term_months", "term_months > 0"),
        date("start_date", True),
        text("status", 30, "title_words", True),
    ),
    (Parent("customer_id", "customers"), Parent("branch_id", "branches", validated=False)),
    (
        *_identity("loan_id", "Loan"),
        R.orphan_key("customer_id", "Customer", "Customers"),
        R.out_of_range("loan_amount", "Invalid Loan Amount ({})", above=0),
        R.out_of_range("interest_rate", "Invalid Interest Rate ({})", above=0, high=50),
        R.out_of_range("term_months", "Invalid Term Months ({})", above=0),
        R.not_in_domain("loan_type", LOAN_TYPES, "Invalid Loan Type ({})"),
        R.not_in_domain("status", LOAN_STATUSES, "Invalid Loan Status ({})"),
        R.bad_date("start_date", reason="Invalid Start Date ({})"),
    ),
)

LOAN_PAYMENTS = Table(
    "loan_payments",
    "payment_id",
    (
        key("payment_id"),
        key("loan_id"),
        date("payment_date", True),
        money("amount_paid", 15, check="amount_paid > 0"),
        money("principal_component", 15),
        money("interest_component", 15),
        whole("late_payment_flag", "late_payment_flag IN (0, 1)", type=T.ShortType()),
    ),
    (Parent("loan_id", "loans"),),
    (
        *_identity("payment_id", "Payment"),
        R.orphan_key("loan_id", "Loan", "Loans"),
        R.out_of_range("amount_paid", "Invalid Amount Paid ({})", above=0),
        R.components_unbalanced(
            "amount_paid",
            ("principal_component", "interest_component"),
            SPLIT_TOLERANCE,
            "Principal and Interest components do not balance to Amount Paid",
        ),
        R.not_binary("late_payment_flag", "Invalid Late Payment Flag ({})"),
        R.bad_date("payment_date", reason="Invalid Payment Date ({})"),
    ),
)

CARDS = Table(
    "cards",
    "card_id",
    (
        key("card_id"),
        key("customer_id"),
        key("account_id"),
        text("card_type", 50, "title_words", True),
        date("issue_date", True),
        date("expiry_date", True),
        money("credit_limit", 15, check="credit_limit >= 0"),
        text("status", 30, "capitalise", True),
    ),
    (Parent("customer_id", "customers"), Parent("account_id", "accounts")),
    (
        *_identity("card_id", "Card"),
        R.orphan_key("customer_id", "Customer", "Customers"),
        R.orphan_key("account_id", "Account", "Accounts"),
        R.not_in_domain("card_type", CARD_TYPES, "Invalid Card Type ({})"),
        R.not_in_domain("status", CARD_STATUSES, "Invalid Card Status ({})"),
        R.bad_date("issue_date", "expiry_date", reason="Invalid date format in issue_date or expiry_date"),
        R.date_before("expiry_date", "issue_date", "Expiry date ({}) before issue date ({})"),
        R.out_of_range("credit_limit", "Invalid Credit Limit ({})", low=0),
    ),
)

CARD_TRANSACTIONS = Table(
    "card_transactions",
    "card_txn_id",
    (
        key("card_txn_id"),
        key("card_id"),
        date("txn_date", True),
        text("merchant_category", 100, "title", True),
        money("amount", 15, check="amount > 0"),
        whole("is_fraud", "is_fraud IN (0, 1)", type=T.ShortType()),
    ),
    (Parent("card_id", "cards"),),
    (
        *_identity("card_txn_id", "Card Txn"),
        R.orphan_key("card_id", "Card", "Cards"),
        R.out_of_range("amount", "Invalid Transaction Amount ({})", above=0),
        R.blank("merchant_category", reason="Missing Merchant Category"),
        R.bad_date("txn_date", reason="Invalid Txn Date ({})"),
        R.not_binary("is_fraud", "Invalid Fraud Flag ({})"),
    ),
)

SUPPORT_TICKETS = Table(
    "support_tickets",
    "ticket_id",
    (
        key("ticket_id"),
        key("customer_id"),
        text("issue_type", 100, "title", True),
        date("date_opened", True),
        date("date_resolved"),
        text("status", 30, "capitalise", True),
        whole("satisfaction_score", "satisfaction_score BETWEEN 1 AND 5", required=False),
    ),
    (Parent("customer_id", "customers"),),
    (
        *_identity("ticket_id", "Ticket"),
        R.orphan_key("customer_id", "Customer", "Customers"),
        R.blank("issue_type", reason="Missing Issue Type"),
        R.not_in_domain("status", TICKET_STATUSES, "Invalid Status ({})"),
        R.bad_date("date_opened", reason="Invalid Date Opened"),
        R.date_before("date_resolved", "date_opened", "Date resolved ({}) before opened ({})"),
        R.out_of_range("satisfaction_score", "Invalid Satisfaction Score ({})", low=1, high=5),
    ),
)

# Parents stand before children; every run follows this order.
TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        BRANCHES, EMPLOYEES, CUSTOMERS, ACCOUNTS, TRANSACTIONS,
        LOANS, LOAN_PAYMENTS, CARDS, CARD_TRANSACTIONS, SUPPORT_TICKETS,
    )
}

# The subset that the lake job curates.
LAKE_TABLES = ("branches", "employees", "customers", "accounts", "transactions")


def with_parents(tables) -> list[str]:
    """The given tables and everything they depend on, parents first."""
    wanted = set(tables)
    for name in reversed(TABLES):
        if name in wanted:
            wanted |= {p.table for p in TABLES[name].validated_parents}
    return [name for name in TABLES if name in wanted]
