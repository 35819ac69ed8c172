"""The three marts and the monthly account rollup they share.

A fact is always aggregated on its own foreign key before it meets another table. The
aggregation combines on the map side, so an account that owns a third of all transactions
enters every join as one row per month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.functions.columns import month_of

# Transaction types that count as money in and money out of a customer, and,
# more narrowly, as deposits and withdrawals of a branch.
INCOME_TYPES = ("Deposit", "Transfer In", "Interest Credit")
EXPENSE_TYPES = ("Withdrawal", "Transfer Out", "Fee Debit")
DEPOSIT_TYPES = ("Deposit", "Transfer In")
WITHDRAWAL_TYPES = ("Withdrawal", "Transfer Out")

# Bounds and names of the customer segments.
PREMIUM_SCORE, PREMIUM_BALANCE, STANDARD_SCORE = 750, 50000, 650
PREMIUM, STANDARD, SUBPRIME = "Premium / Low Risk", "Standard / Moderate Risk", "Subprime / High Risk"

MONEY = "decimal(25,2)"


def total(column: str | Column) -> Column:
    return F.sum(column).cast(MONEY)


def total_of_types(types: tuple[str, ...]) -> Column:
    amount = F.when(F.col("txn_type").isin(*types), F.col("amount")).otherwise(F.lit(0).cast("decimal(15,2)"))
    return total(amount)


def or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0) if column.endswith("_count") else F.lit(0).cast(MONEY))


def account_month(bank) -> DataFrame:
    """Transactions per account and month: the one scan of the fact that all marts share."""
    return (
        bank["transactions"]
        .groupBy("account_id", month_of(F.col("txn_date")).alias("month_year"))
        .agg(
            F.count("*").alias("transactions"),
            total("amount").alias("volume"),
            total_of_types(INCOME_TYPES).alias("income"),
            total_of_types(EXPENSE_TYPES).alias("expense"),
            total_of_types(DEPOSIT_TYPES).alias("deposits"),
            total_of_types(WITHDRAWAL_TYPES).alias("withdrawals"),
        )
    )


def _customer_month(bank) -> DataFrame:
    owners = bank["accounts"].select("account_id", "customer_id")
    return (
        bank["account_month"]
        .join(owners, "account_id")
        .groupBy("customer_id", "month_year")
        .agg(
            F.sum("transactions").alias("bank_transactions_count"),
            total("income").alias("total_income_credits"),
            total("expense").alias("total_expense_debits"),
        )
    )


def card_month(bank) -> DataFrame:
    """Card transactions per card and month."""
    return (
        bank["card_transactions"]
        .groupBy("card_id", month_of(F.col("txn_date")).alias("month_year"))
        .agg(total("amount").alias("spend"), F.sum("is_fraud").alias("frauds"))
    )


def _card_month(bank) -> DataFrame:
    return (
        bank["card_month"].join(bank["cards"].select("card_id", "customer_id"), "card_id")
        .groupBy("customer_id", "month_year")
        .agg(total("spend").alias("total_card_spend"), F.sum("frauds").alias("card_fraud_count"))
    )


def _active_loans(bank) -> DataFrame:
    return (
        bank["loans"].where(F.col("status") == "Active").groupBy("customer_id")
        .agg(total("loan_amount").alias("outstanding_loan_balance"))
    )


def _monthly_customer_rows(bank, months: DataFrame) -> DataFrame:
    customers = bank["customers"].select(
        "customer_id", F.col("name").alias("customer_name"), "annual_income", "credit_score"
    )
    return (
        customers.join(months, "customer_id", "left")
        .join(_active_loans(bank), "customer_id", "left")
        .select(
            "customer_id",
            "customer_name",
            "month_year",
            "annual_income",
            "credit_score",
            or_zero("bank_transactions_count").alias("bank_transactions_count"),
            or_zero("total_income_credits").alias("total_income_credits"),
            or_zero("total_expense_debits").alias("total_expense_debits"),
            (or_zero("total_income_credits") - or_zero("total_expense_debits")).cast(MONEY).alias("net_cashflow"),
            or_zero("total_card_spend").alias("total_card_spend"),
            or_zero("card_fraud_count").alias("card_fraud_count"),
            or_zero("outstanding_loan_balance").alias("outstanding_loan_balance"),
        )
    )


def monthly_customer_summary(bank) -> DataFrame:
    """Cash flow per customer and month with bank transactions.

    Card figures appear beside the bank figures of the same month; a month with card
    transactions alone does not appear, and a customer without transactions has one row without
    a month.
    """
    months = _customer_month(bank).join(_card_month(bank), ["customer_id", "month_year"], "left")
    return _monthly_customer_rows(bank, months)


def monthly_customer_summary_full(bank) -> DataFrame:
    """The same, with the months in which a customer used cards only."""
    months = _customer_month(bank).join(_card_month(bank), ["customer_id", "month_year"], "full")
    return _monthly_customer_rows(bank, months)


def monthly_branch_summary(bank) -> DataFrame:
    """Activity per branch and month.

    The rollup holds an account once per month, so accounts are counted, not de-duplicated;
    customers are made distinct by grouping on them first.
    """
    owners = bank["accounts"].select("account_id", "customer_id", "branch_id")
    per_customer = (
        bank["account_month"]
        .join(owners, "account_id")
        .groupBy("branch_id", "month_year", "customer_id")
        .agg(
            F.count("*").alias("accounts"),
            F.sum("transactions").alias("transactions"),
            *[total(c).alias(c) for c in ("volume", "deposits", "withdrawals")],
        )
    )
    return per_customer.groupBy("branch_id", "month_year").agg(
        F.count("customer_id").alias("active_customers"),
        F.sum("accounts").alias("total_accounts"),
        F.sum("transactions").alias("total_transactions"),
        total("volume").alias("total_volume"),
        total("deposits").alias("deposit_volume"),
        total("withdrawals").alias("withdrawal_volume"),
    )


def customer_360(bank) -> DataFrame:
    """One row per customer: holdings, loans, cards, activity and segment."""
    lifetime = bank["account_month"].groupBy("account_id").agg(
        F.sum("transactions").alias("transactions"), total("volume").alias("volume")
    )
    accounts = (
        bank["accounts"].select("account_id", "customer_id", "balance")
        .join(lifetime, "account_id", "left")
        .groupBy("customer_id")
        .agg(
            F.count("account_id").alias("total_accounts"),
            total("balance").alias("total_deposit_balance"),
            F.sum("transactions").alias("lifetime_transactions"),
            total("volume").alias("lifetime_transaction_volume"),
        )
    )
    zero = F.lit(0).cast("decimal(15,2)")
    loans = bank["loans"].groupBy("customer_id").agg(
        F.count("loan_id").alias("total_loans"),
        total(F.when(F.col("status") == "Active", F.col("loan_amount")).otherwise(zero)).alias("active_loan_amount"),
    )
    cards = bank["cards"].groupBy("customer_id").agg(
        F.count("card_id").alias("total_cards"), total("credit_limit").alias("total_credit_limit")
    )
    counts = ("total_accounts", "total_loans", "total_cards", "lifetime_transactions")
    amounts = ("total_deposit_balance", "active_loan_amount", "total_credit_limit", "lifetime_transaction_volume")
    joined = (
        bank["customers"]
        .join(accounts, "customer_id", "left")
        .join(loans, "customer_id", "left")
        .join(cards, "customer_id", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
        .withColumns({c: F.coalesce(F.col(c), F.lit(0).cast(MONEY)) for c in amounts})
    )
    premium = (F.col("credit_score") >= PREMIUM_SCORE) & (F.col("total_deposit_balance") > PREMIUM_BALANCE)
    return joined.select(
        "customer_id", "name", "gender", "city", "state", "email", "occupation",
        "annual_income", "credit_score", "join_date",
        "total_accounts", "total_deposit_balance",
        "total_loans", "active_loan_amount",
        "total_cards", "total_credit_limit",
        "lifetime_transactions", "lifetime_transaction_volume",
        F.when(premium, PREMIUM)
        .when(F.col("credit_score") >= STANDARD_SCORE, STANDARD)
        .otherwise(SUBPRIME)
        .alias("customer_segment"),
    )


MARTS = {
    "account_month": account_month,
    "card_month": card_month,
    "monthly_customer_summary": monthly_customer_summary,
    "monthly_customer_summary_full": monthly_customer_summary_full,
    "monthly_branch_summary": monthly_branch_summary,
    "customer_360": customer_360,
}
PUBLIC_MARTS = tuple(name for name in MARTS if name not in ("account_month", "card_month"))


def build_mart(bank, name: str, path: str) -> None:
    """Compute a mart and store it, replacing what was there."""
    MARTS[name](bank).write.mode("overwrite").parquet(path)
