"""Marts, queries and reads on a small bank whose answers are known."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from vaultline.plans import analytics, marts, reads
from vaultline.plans.analytics import down, up
from vaultline.plans.bank import Bank
from tests.helpers import VALID, curated_frame

ROWS = {
    "customers": [
        (1, "Ann", "Female", "1990-01-01", "Pune", "MH", "1", "a@x.io", "E", "1000000.01", "2020-01-01", 760),
        (2, "Bob", "Male", "2000-02-29", "PUNE", "MH", "2", "b@x.io", "E", "100.00", "2020-01-01", 700),
        (3, "Cyd", None, None, "Goa", "GA", "3", "c@x.io", "E", "100.00", "2020-01-01", 500),
    ],
    "accounts": [
        (11, 1, 10, "Savings", "40000.00", "2020-01-01", "Active"),
        (12, 1, 10, "Current", "40000.00", "2020-01-01", "Dormant"),
        (13, 2, 20, "NRI", "10.00", "2020-01-01", "Active"),
    ],
    "transactions": [
        (101, 11, "2024-01-05", "Deposit", "100.00", "Upi", None),
        (102, 11, "2024-01-06", "Interest Credit", "5.00", "Upi", None),
        (103, 12, "2024-01-07", "Withdrawal", "30.00", "Atm", None),
        (104, 12, "2024-02-07", "Fee Debit", "1.00", "Atm", None),
        (105, 13, "2024-02-08", "Transfer Out", "2.00", "Pos", None),
    ],
    "loans": [
        (201, 1, 10, "Home Loan", "500.00", "8.00", 12, "2020-01-01", "Active"),
        (202, 1, 10, "Home Loan", "700.00", "9.00", 12, "2020-01-01", "Active"),
        (203, 2, 20, "Auto Loan", "50.00", "9.00", 12, "2020-01-01", "Defaulted"),
    ],
    "cards": [
        (301, 1, 11, "Debit", "2020-01-01", "2026-10-01", "0.00", "Active"),
        (302, 2, 13, "Credit - Gold", "2020-01-01", "2026-10-01", "10.00", "Active"),
    ],
    "card_transactions": [
        (401, 301, "2024-01-09", "Fuel", "7.00", 1),
        (402, 301, "2024-03-09", "Fuel", "9.00", 0),
        (403, 302, "2024-02-09", "Fuel", "11.00", 1),
    ],
    "loan_payments": [(501, 201, "2024-01-01", "10.00", "8.00", "2.00", 1), (502, 203, "2024-01-01", "10.00", "7.50", "2.50", 0)],
}


@pytest.fixture(scope="module")
def bank(spark):
    def table(name):
        return curated_frame(spark, name, ROWS.get(name, [tuple(VALID[name].split(","))])).coalesce(1)

    return Bank(table)


def test_card_only_months_vanish_unless_asked_for(bank):
    def months(frame):
        return sorted(((r["customer_id"], r["month_year"]) for r in frame.collect()), key=repr)

    plain = [(1, "2024-01"), (1, "2024-02"), (2, "2024-02"), (3, None)]
    assert months(marts.monthly_customer_summary(bank)) == plain
    assert months(marts.monthly_customer_summary_full(bank)) == sorted([*plain, (1, "2024-03")], key=repr)


def test_monthly_customer_summary(bank):
    rows = {(r["customer_id"], r["month_year"]): r for r in marts.monthly_customer_summary(bank).collect()}
    january = rows[(1, "2024-01")]
    assert (january["bank_transactions_count"], january["net_cashflow"]) == (3, 75)
    assert (january["total_card_spend"], january["card_fraud_count"], january["outstanding_loan_balance"]) == (7, 1, 1200)
    assert rows[(2, "2024-02")]["outstanding_loan_balance"] == 0
    assert rows[(3, None)]["bank_transactions_count"] == 0


def test_monthly_branch_summary(bank):
    rows = {(r["branch_id"], r["month_year"]): tuple(r)[2:] for r in marts.monthly_branch_summary(bank).collect()}
    assert rows[(10, "2024-01")] == (1, 2, 3, 135, 100, 30)
    assert rows[(10, "2024-02")] == (1, 1, 1, 1, 0, 0)


def test_customer_360(bank):
    rows = {r["customer_id"]: r for r in marts.customer_360(bank).collect()}
    assert [rows[i]["customer_segment"] for i in (1, 2, 3)] == [marts.PREMIUM, marts.STANDARD, marts.SUBPRIME]
    assert (rows[1]["total_accounts"], rows[1]["lifetime_transactions"], rows[1]["active_loan_amount"]) == (2, 4, 1200)
    assert (rows[3]["total_accounts"], rows[3]["total_deposit_balance"], rows[3]["total_cards"]) == (0, 0, 0)


def test_equal_balances_collapse_only_in_the_parity_query(bank):
    assert [tuple(r) for r in analytics.branch_deposits_vs_loans(bank).collect()] == [(10, 40000, 1200), (20, 10, 50)]
    assert [tuple(r) for r in analytics.branch_deposits_vs_loans_exact(bank).collect()] == [(10, 80000, 1200), (20, 10, 50)]


def test_cohorts_depend_on_the_given_day(bank):
    def bob(as_of):
        rows = analytics.age_cohort_channel(bank, as_of).collect()
        return [r["age_cohort"] for r in rows if r["channel"] == "Pos"]

    assert bob(date(2030, 2, 28)) == ["Gen Z (< 30)"]
    assert bob(date(2030, 3, 1)) == ["Millennials (30-49)"]


def test_single_answers(bank):
    (borrower,) = analytics.multi_loan_customers(bank).collect()
    assert (borrower["customer_id"], borrower["active_loan_count"], borrower["total_borrowed"]) == (1, 2, 1200)
    assert tuple(analytics.bank_kpis(bank).first()) == (3, 3, 80010, 2, 1200, 2, 5, 3)
    assert tuple(analytics.dashboard_kpis(bank).first())[-1] == 2
    assert [tuple(r) for r in analytics.cards_expiring(bank).select("card_id").collect()] == [(301,), (302,)]
    fraud = analytics.fraud_by_merchant(bank).first()
    assert (fraud["fraudulent_txns"], float(fraud["fraud_rate_pct"]), fraud["total_fraud_loss"]) == (2, 66.667, 18)
    shares = {r["loan_status"]: float(r["pct_of_portfolio"]) for r in analytics.loan_status_share(bank).collect()}
    assert shares == {"Active": 66.67, "Defaulted": 33.33}


def test_pages(bank):
    assert [r["customer_id"] for r in reads.list_customers(bank, city="pune").collect()] == [1, 2]
    assert [r["customer_id"] for r in reads.list_customers(bank, limit=1, offset=1).collect()] == [2]
    assert [r["transaction_id"] for r in reads.list_transactions(bank, limit=2).collect()] == [105, 104]
    assert [r["loan_id"] for r in reads.list_loans(bank, customer_id=1, status="ACTIVE").collect()] == [201, 202]
    assert [r["card_id"] for r in reads.list_cards(bank, card_type="credit - gold").collect()] == [302]
    assert [r["account_id"] for r in reads.list_accounts(bank, account_type="nri").collect()] == [13]
    everything = [tuple(r) for r in reads.list_transactions(bank).select("txn_date", "transaction_id").collect()]
    for at, last in enumerate(everything):
        behind = reads.list_transactions(bank, after=last).select("txn_date", "transaction_id").collect()
        assert [tuple(r) for r in behind] == everything[at + 1 :]
    assert [r["customer_id"] for r in reads.list_customers(bank, city="pune", after=(1,)).collect()] == [2]
    for bad in ({"limit": 0}, {"limit": 201}, {"offset": -1}, {"after": (1, 2)}):
        with pytest.raises(ValueError):
            reads.list_customers(bank, **bad)
    with pytest.raises(ValueError):
        reads.list_accounts(bank, customer_id=0)


def test_segment_search_takes_wildcards_literally(bank):
    assert [r["customer_id"] for r in reads.list_customer_360(bank, segment="low RISK").collect()] == [1]
    assert reads.list_customer_360(bank, segment="%").count() == 0
    assert reads.list_customer_360(bank, segment="l_w").count() == 0


def test_customer_detail(bank):
    detail = reads.customer_detail(bank, 1)
    assert {name: frame.count() for name, frame in detail.items()} == {
        "customers": 1, "customer_360": 1, "accounts": 2, "loans": 2, "cards": 1,
    }
    assert reads.customer_detail_rows(bank, 99).count() == 0
    rows = reads.customer_detail_rows(bank, 1)
    assert rows.count() == 7 and set(rows.columns) == {"section"}.union(*[frame.columns for frame in detail.values()])
    with pytest.raises(ValueError):
        reads.customer_detail(bank, 0)


def test_views_and_stored_marts(spark, bank, tmp_path):
    bank.register_views()
    assert spark.sql("SELECT count(*) FROM customer_360 JOIN accounts USING (customer_id)").first()[0] == 3
    marts.build_mart(bank, "monthly_branch_summary", str(tmp_path / "m2"))
    assert spark.read.parquet(str(tmp_path / "m2")).count() == 3


@pytest.mark.parametrize("directions", [(up, up), (down, up)])
def test_deep_pages_equal_pages_by_sorting(spark, monkeypatch, directions):
    monkeypatch.setattr(reads, "DEEP", 20)
    monkeypatch.setattr(reads, "CUTS", 8)
    rows = [(i % 7 if i % 3 else 3, i * 37 % 2003) for i in range(2000)]  # a third of all rows share a first value
    frame = spark.createDataFrame(rows, "a int, b long").repartition(4)
    order = dict(zip(("a", "b"), directions))
    want = sorted(rows, key=lambda r: (r[0] * (1 if directions[0] is up else -1), r[1] * (1 if directions[1] is up else -1)))
    for offset in (300, 1501, 2500):
        start, skipped = reads._start_of(frame, order, offset)
        assert offset > 2000 or 0 <= offset - skipped <= 20
        got = [tuple(r) for r in reads.page(frame, order, 10, offset).collect()]
        assert got == want[offset : offset + 10]


def test_a_deep_page_keeps_few_rows_a_task(spark):
    frame = spark.range(3_000_000).select((F.col("id") * 7919 % 3_000_000).alias("id"), F.lit("x").alias("v"))
    page = reads.page(frame, {"id": up}, 5, 1_000_000)
    assert [r["id"] for r in page.collect()] == list(range(1_000_000, 1_000_005))
    keyed = reads.page(frame, {"id": up}, 5, after=(999_999,))
    assert page.collect() == keyed.collect()
    kept = [int(n) for n in re.findall(r"(?:limit=|Limit )(\d+)", page._jdf.queryExecution().executedPlan().toString())]
    assert kept and max(kept) <= reads.DEEP + 5
