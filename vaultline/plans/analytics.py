"""The 25 analytics queries over curated tables and marts.

Every query takes a :class:`~vaultline.plans.bank.Bank`. Facts are aggregated on their own key
before they are joined, and every limit has the key as its last ordering, so results do not
depend on the order of rows.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vaultline.functions.columns import age_in_years, mean, month_of, percent_of_count, percent_of_money
from vaultline.plans.marts import MONEY, total

# Names of the credit tiers and age cohorts.
CREDIT_TIERS = ((750, "Excellent (750-850)"), (650, "Good (650-749)"), (550, "Fair (550-649)"))
LOWEST_TIER = "Poor (< 550)"
AGE_COHORTS = ((30, "Gen Z (< 30)"), (50, "Millennials (30-49)"))
OLDEST_COHORT = "Seniors (50+)"

BAD_LOANS = ("Defaulted", "Written Off")


def down(column: str) -> Column:
    """Descending, missing values first, as the warehouse orders."""
    return F.desc_nulls_first(column)


def up(column: str) -> Column:
    """Ascending, missing values last."""
    return F.asc_nulls_last(column)


def _summary(frame: DataFrame, by: str, measure: str, count: str, sum_: str, avg: str) -> DataFrame:
    """Count, total and average of a money column per group."""
    return (
        frame.groupBy(by)
        .agg(F.count("*").alias(count), total(measure).alias(sum_), F.count(measure).alias("_n"))
        .select(by, count, sum_, mean(F.col(sum_), F.col("_n")).alias(avg))
    )


def top_customers_by_volume(bank) -> DataFrame:
    return (
        bank["customer_360"]
        .select("customer_id", "name", "city", "annual_income", "lifetime_transaction_volume")
        .orderBy(down("lifetime_transaction_volume"), up("customer_id"))
        .limit(10)
    )


def monthly_txn_trend(bank) -> DataFrame:
    months = bank["transactions"].select(month_of(F.col("txn_date")).alias("txn_month"), "amount")
    return _summary(months, "txn_month", "amount", "transaction_count", "total_volume", "avg_ticket_size").orderBy(
        up("txn_month")
    )


def loan_portfolio_by_type(bank) -> DataFrame:
    return (
        bank["loans"].groupBy("loan_type")
        .agg(
            F.count("*").alias("total_loans"),
            total("loan_amount").alias("total_principal_disbursed"),
            total("interest_rate").alias("_rates"),
        )
        .select(
            "loan_type",
            "total_loans",
            "total_principal_disbursed",
            mean(F.col("_rates"), F.col("total_loans")).alias("avg_interest_rate"),
            mean(F.col("total_principal_disbursed"), F.col("total_loans")).alias("avg_ticket_size"),
        )
        .orderBy(down("total_principal_disbursed"), up("loan_type"))
    )


def loan_status_share(bank) -> DataFrame:
    """The share of each status. The window sees the aggregated rows only, one per status."""
    grouped = bank["loans"].groupBy(F.col("status").alias("loan_status")).agg(
        F.count("*").alias("loan_count"), total("loan_amount").alias("total_exposure")
    )
    everything = F.sum("loan_count").over(Window.partitionBy())
    return grouped.select(
        "loan_status",
        "loan_count",
        percent_of_count(F.col("loan_count"), everything).alias("pct_of_portfolio"),
        "total_exposure",
    ).orderBy(down("total_exposure"), up("loan_status"))


def deposits_by_branch(bank) -> DataFrame:
    return (
        _summary(bank["accounts"], "branch_id", "balance", "total_accounts", "total_branch_deposits", "avg_account_balance")
        .orderBy(down("total_branch_deposits"), up("branch_id"))
        .limit(15)
    )


def dormant_high_balance(bank, above: int = 50000) -> DataFrame:
    return (
        bank["accounts"]
        .where((F.col("status") == "Dormant") & (F.col("balance") > above))
        .select("account_id", "customer_id", "branch_id", "account_type", "balance", "open_date")
        .orderBy(down("balance"), up("account_id"))
        .limit(20)
    )


def multi_loan_customers(bank) -> DataFrame:
    borrowers = (
        bank["loans"].where(F.col("status") == "Active").groupBy("customer_id")
        .agg(F.count("loan_id").alias("active_loan_count"), total("loan_amount").alias("total_borrowed"))
        .where("active_loan_count > 1")
    )
    return (
        bank["customers"].select("customer_id", "name", "annual_income")
        .join(borrowers, "customer_id")
        .orderBy(down("active_loan_count"), down("total_borrowed"), up("customer_id"))
        .limit(20)
    )


def merchant_spend(bank) -> DataFrame:
    return _summary(
        bank["card_transactions"], "merchant_category", "amount", "transaction_count", "total_spend", "avg_spend"
    ).orderBy(down("total_spend"), up("merchant_category"))


def fraud_by_merchant(bank) -> DataFrame:
    zero = F.lit(0).cast("decimal(15,2)")
    return (
        bank["card_transactions"].groupBy("merchant_category")
        .agg(
            F.count("*").alias("total_txns"),
            F.sum("is_fraud").alias("fraudulent_txns"),
            total(F.when(F.col("is_fraud") == 1, F.col("amount")).otherwise(zero)).alias("total_fraud_loss"),
        )
        .select(
            "merchant_category",
            "total_txns",
            "fraudulent_txns",
            percent_of_count(F.col("fraudulent_txns"), F.col("total_txns"), 3).alias("fraud_rate_pct"),
            "total_fraud_loss",
        )
        .orderBy(down("total_fraud_loss"), up("merchant_category"))
    )


def late_payment_rate(bank) -> DataFrame:
    per_loan = bank["loan_payments"].groupBy("loan_id").agg(
        F.count("payment_id").alias("n"), F.sum("late_payment_flag").alias("late")
    )
    return (
        per_loan.join(bank["loans"].select("loan_id", "loan_type"), "loan_id")
        .groupBy("loan_type")
        .agg(F.sum("n").alias("total_installments_paid"), F.sum("late").alias("late_installments_count"))
        .withColumn(
            "delinquency_rate_pct",
            percent_of_count(F.col("late_installments_count"), F.col("total_installments_paid")),
        )
        .orderBy(down("delinquency_rate_pct"), up("loan_type"))
    )


def segment_breakdown(bank) -> DataFrame:
    return (
        bank["customer_360"].groupBy("customer_segment")
        .agg(
            F.count("*").alias("customer_count"),
            total("annual_income").alias("_income"),
            F.count("annual_income").alias("_incomes"),
            total("total_deposit_balance").alias("_balance"),
            F.sum("credit_score").alias("_score"),
            F.count("credit_score").alias("_scores"),
        )
        .select(
            "customer_segment",
            "customer_count",
            mean(F.col("_income"), F.col("_incomes")).alias("avg_annual_income"),
            mean(F.col("_balance"), F.col("customer_count")).alias("avg_deposit_balance"),
            mean(F.col("_score"), F.col("_scores"), 1).alias("avg_credit_score"),
        )
        .orderBy(down("avg_deposit_balance"), up("customer_segment"))
    )


def channel_velocity(bank) -> DataFrame:
    return _summary(
        bank["transactions"], "channel", "amount", "txn_count", "total_volume", "avg_transaction_value"
    ).orderBy(down("txn_count"), up("channel"))


def credit_card_tiers(bank) -> DataFrame:
    credit = bank["cards"].where(F.col("card_type").startswith("Credit"))
    return _summary(
        credit, "card_type", "credit_limit", "card_count", "total_credit_exposure", "avg_credit_limit"
    ).orderBy(down("total_credit_exposure"), up("card_type"))


def high_net_worth(bank, income_above: int = 1000000) -> DataFrame:
    ratio = F.round(
        F.col("total_deposit_balance") / F.when(F.col("annual_income") != 0, F.col("annual_income")), 2
    )
    return (
        bank["customer_360"].where(F.col("annual_income") > income_above)
        .select(
            "customer_id", "name", "annual_income", "total_deposit_balance", ratio.alias("balance_to_income_ratio")
        )
        .orderBy(down("total_deposit_balance"), up("customer_id"))
        .limit(10)
    )


def interest_yield_by_year(bank) -> DataFrame:
    return (
        bank["loan_payments"].groupBy(F.date_format("payment_date", "yyyy").alias("payment_year"))
        .agg(
            total("amount_paid").alias("total_collections"),
            total("principal_component").alias("total_principal_recovered"),
            total("interest_component").alias("total_interest_earned"),
        )
        .withColumn(
            "interest_yield_pct", percent_of_money(F.col("total_interest_earned"), F.col("total_collections"))
        )
        .orderBy(up("payment_year"))
    )


def account_type_mix(bank) -> DataFrame:
    return _summary(
        bank["accounts"], "account_type", "balance", "account_count", "total_balance", "avg_balance"
    ).orderBy(down("total_balance"), up("account_type"))


def _branch_totals(bank, distinct: bool) -> DataFrame:
    """Deposits and loans per branch, each side aggregated on its own.

    Joining accounts to loans on the branch would multiply every account by every loan of the
    branch. Distinct sums do not see that multiplication, so aggregating first is equal.
    """
    add = (lambda c: F.sum_distinct(c).cast(MONEY)) if distinct else total
    deposits = bank["accounts"].groupBy("branch_id").agg(add(F.col("balance")).alias("total_deposits"))
    loans = bank["loans"].groupBy("branch_id").agg(add(F.col("loan_amount")).alias("loans"))
    return (
        deposits.join(loans, "branch_id", "left")
        .select("branch_id", "total_deposits", F.coalesce("loans", F.lit(0).cast(MONEY)).alias("total_loans_issued"))
        .orderBy(down("total_deposits"), up("branch_id"))
        .limit(15)
    )


def branch_deposits_vs_loans(bank) -> DataFrame:
    """Equal balances of a branch count once."""
    return _branch_totals(bank, distinct=True)


def branch_deposits_vs_loans_exact(bank) -> DataFrame:
    """Every balance counts."""
    return _branch_totals(bank, distinct=False)


def fraud_victims(bank) -> DataFrame:
    per_card = bank["card_transactions"].where(F.col("is_fraud") == 1).groupBy("card_id").agg(
        F.count("card_txn_id").alias("events"), total("amount").alias("amount")
    )
    per_customer = (
        per_card.join(bank["cards"].select("card_id", "customer_id"), "card_id")
        .groupBy("customer_id")
        .agg(F.sum("events").alias("fraudulent_events"), total("amount").alias("total_fraud_amount"))
    )
    return (
        bank["customers"].select("customer_id", "name", "city")
        .join(per_customer, "customer_id")
        .orderBy(down("total_fraud_amount"), up("customer_id"))
        .limit(15)
    )


def monthly_surplus(bank, above: int = 100000) -> DataFrame:
    return (
        bank["monthly_customer_summary"].where(F.col("net_cashflow") > above)
        .select(
            "customer_id", "customer_name", "month_year", "total_income_credits", "total_expense_debits", "net_cashflow"
        )
        .orderBy(down("net_cashflow"), up("customer_id"), up("month_year"))
        .limit(15)
    )


def _banded(value: Column, bands, last: str, below: bool) -> Column:
    chain = None
    for bound, label in bands:
        inside = value < bound if below else value >= bound
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    return chain.otherwise(last)


def credit_tier_default_rate(bank) -> DataFrame:
    per_customer = bank["loans"].groupBy("customer_id").agg(
        F.count("loan_id").alias("loans"), F.count_if(F.col("status").isin(*BAD_LOANS)).alias("bad")
    )
    tier = _banded(F.col("credit_score"), CREDIT_TIERS, LOWEST_TIER, below=False)
    return (
        per_customer.join(bank["customers"].select("customer_id", "credit_score"), "customer_id")
        .groupBy(tier.alias("credit_tier"))
        .agg(F.sum("loans").alias("total_loans"), F.sum("bad").alias("defaulted_loans"))
        .withColumn("default_rate_pct", percent_of_count(F.col("defaulted_loans"), F.col("total_loans")))
        .orderBy(down("default_rate_pct"), up("credit_tier"))
    )


def daily_channel_peaks(bank) -> DataFrame:
    return (
        bank["transactions"].groupBy("txn_date", "channel")
        .agg(F.count("*").alias("daily_txns"), total("amount").alias("daily_amount"))
        .orderBy(down("daily_amount"), up("txn_date"), up("channel"))
        .limit(10)
    )


def cards_expiring(bank, first: date = date(2026, 9, 30), last: date = date(2027, 3, 31)) -> DataFrame:
    return (
        bank["cards"]
        .where((F.col("status") == "Active") & F.col("expiry_date").between(F.lit(first), F.lit(last)))
        .select("card_id", "customer_id", "card_type", "expiry_date", "status")
        .orderBy(up("expiry_date"), up("card_id"))
        .limit(15)
    )


def deposits_by_state(bank) -> DataFrame:
    """The mart holds a customer once, so counting rows counts distinct customers."""
    return (
        _summary(
            bank["customer_360"], "state", "total_deposit_balance",
            "customer_count", "aggregate_state_deposits", "avg_deposits_per_customer",
        )
        .orderBy(down("aggregate_state_deposits"), up("state"))
        .limit(10)
    )


def age_cohort_channel(bank, as_of: date | None = None) -> DataFrame:
    """Channel use per age cohort on a given day (today unless given)."""
    per_account = bank["transactions"].groupBy("account_id", "channel").agg(
        F.count("*").alias("n"), total("amount").alias("amount")
    )
    per_customer = (
        per_account.join(bank["accounts"].select("account_id", "customer_id"), "account_id")
        .groupBy("customer_id", "channel")
        .agg(F.sum("n").alias("n"), total("amount").alias("amount"))
    )
    age = age_in_years(F.col("date_of_birth"), F.lit(as_of or date.today()))
    return (
        per_customer.join(bank["customers"].select("customer_id", "date_of_birth"), "customer_id")
        .groupBy(_banded(age, AGE_COHORTS, OLDEST_COHORT, below=True).alias("age_cohort"), "channel")
        .agg(F.sum("n").alias("txn_count"), total("amount").alias("total_channel_spend"))
        .orderBy(up("age_cohort"), down("txn_count"), up("channel"))
    )


def _one_row(parts: list[DataFrame], columns: list[str]) -> DataFrame:
    """Put single-row aggregates of several tables beside each other."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in columns])


def _kpis(bank, names: dict[str, str]) -> DataFrame:
    """One aggregation per table, each table scanned once. ``names`` renames the measures."""
    active = F.col("status") == "Active"
    parts = [
        bank["customers"].agg(F.count("*").alias("customers")),
        bank["accounts"].agg(F.count("*").alias("accounts"), total("balance").alias("deposits")),
        bank["loans"].agg(
            F.count_if(active).alias("active_loans"),
            total(F.when(active, F.col("loan_amount"))).alias("active_portfolio"),
        ),
        bank["cards"].agg(F.count_if(active).alias("active_cards")),
        bank["transactions"].agg(F.count("*").alias("transactions")),
        bank["card_transactions"].agg(
            F.count("*").alias("card_transactions"),
            *([F.sum("is_fraud").alias("frauds")] if "frauds" in names else []),
        ),
    ]
    return _one_row(parts, list(names)).select(*[F.col(c).alias(alias) for c, alias in names.items()])


def bank_kpis(bank) -> DataFrame:
    return _kpis(
        bank,
        {
            "customers": "total_curated_customers",
            "accounts": "total_curated_accounts",
            "deposits": "total_deposit_holdings",
            "active_loans": "total_active_loans",
            "active_portfolio": "active_loan_portfolio",
            "active_cards": "active_cards",
            "transactions": "lifetime_transactions_recorded",
            "card_transactions": "lifetime_card_transactions_recorded",
        },
    )


def dashboard_kpis(bank) -> DataFrame:
    return _kpis(
        bank,
        {
            "customers": "total_customers",
            "accounts": "total_accounts",
            "deposits": "total_deposits",
            "active_loans": "total_active_loans",
            "active_portfolio": "active_loan_portfolio",
            "active_cards": "active_cards",
            "transactions": "lifetime_transactions",
            "card_transactions": "lifetime_card_transactions",
            "frauds": "total_fraud_transactions",
        },
    )


QUERIES = {
    "q01_top_customers_by_volume": top_customers_by_volume,
    "q02_monthly_txn_trend": monthly_txn_trend,
    "q03_loan_portfolio_by_type": loan_portfolio_by_type,
    "q04_loan_status_share": loan_status_share,
    "q05_deposits_by_branch": deposits_by_branch,
    "q06_dormant_high_balance": dormant_high_balance,
    "q07_multi_loan_customers": multi_loan_customers,
    "q08_merchant_spend": merchant_spend,
    "q09_fraud_by_merchant": fraud_by_merchant,
    "q10_late_payment_rate": late_payment_rate,
    "q11_segment_breakdown": segment_breakdown,
    "q12_channel_velocity": channel_velocity,
    "q13_credit_card_tiers": credit_card_tiers,
    "q14_high_net_worth": high_net_worth,
    "q15_interest_yield_by_year": interest_yield_by_year,
    "q16_account_type_mix": account_type_mix,
    "q17_branch_deposits_vs_loans": branch_deposits_vs_loans,
    "q17_exact": branch_deposits_vs_loans_exact,
    "q18_fraud_victims": fraud_victims,
    "q19_monthly_surplus": monthly_surplus,
    "q20_credit_tier_default_rate": credit_tier_default_rate,
    "q21_daily_channel_peaks": daily_channel_peaks,
    "q22_cards_expiring": cards_expiring,
    "q23_deposits_by_state": deposits_by_state,
    "q24_age_cohort_channel": age_cohort_channel,
    "q25_bank_kpis": bank_kpis,
}
