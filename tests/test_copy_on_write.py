"""Merges and rollups touch what changed and nothing else."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from vaultline.operators.merge import latest_per_key
from vaultline.operators.tables import TABLES
from vaultline.plans import marts
from vaultline.plans.bank import Bank
from vaultline.plans.rollups import MonthlyFacts, Rollups
from vaultline.sources.buckets import Overtaken
from vaultline.sources.merged import ROWS, MergedTable
from tests.helpers import VALID, curated_frame

SCHEMA = "k long, v string, at int"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def hide(folder, hidden):
    """Take a folder away for a while; what gives it back."""
    folder.rename(hidden)
    return lambda: hidden.rename(folder)


def test_a_merge_reads_and_writes_touched_ranges(spark, tmp_path):
    start = spark.range(1000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("at"))
    start = start.unionByName(spark.createDataFrame([(None, "no key", 1), (-5, "below", 1)], SCHEMA))
    table = MergedTable(spark, str(tmp_path / "t"), start.schema, "k", ["at"], span=10)
    assert table.merge(start) == 1 and table.rows().count() == 1002
    before = table.store.record()["stored"][ROWS]
    assert len(before) == 102
    changes = spark.createDataFrame([(3, "new", 2), (4, "late", 0), (5, "new", 2), (5, "newest", 3), (995, "new", 2), (2000, "added", 1)], SCHEMA)
    touched = {"0", "99", "200"}
    back = [
        hide(tmp_path / f"t/data/rows/write={write}/bucket={bucket}", tmp_path / f"hidden-{bucket}")
        for bucket, write in before.items() if bucket not in touched
    ]  # 99 of 102 ranges are not there while the merge runs
    assert table.merge(changes) == 2
    for give_back in back:
        give_back()
    after = table.store.record()["stored"][ROWS]
    assert {b for b in after if after[b] != before.get(b)} == touched
    written = [p for p in (tmp_path / "t/data/rows").glob("write=*/bucket=*/*.parquet") if f"write={after['0']}" in str(p)]
    assert 3 <= len(written) <= 6
    assert rows_of(table.rows()) == rows_of(latest_per_key(start, changes, "k", ["at"]))
    assert rows_of(table.rows(1)) == rows_of(start)
    assert table.merge(changes.limit(0)) == 2
    table.store.expire(kept=1)
    assert rows_of(table.rows()) == rows_of(latest_per_key(start, changes, "k", ["at"]))
    assert sum(1 for _ in (tmp_path / "t/data/rows").glob("write=*/bucket=*")) == len(after)


def test_of_two_merges_one_starts_again(spark, tmp_path, monkeypatch):
    start = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    table = MergedTable(spark, str(tmp_path / "t"), start.schema, "k", ["at"])
    real, other = table.store.replace, []

    def overtaken(*arguments):
        real(*arguments)
        if not other:
            other.append("begun")
            table.merge(spark.createDataFrame([(2, "b", 1)], SCHEMA))

    monkeypatch.setattr(table.store, "replace", overtaken)
    with pytest.raises(Overtaken):
        table.merge(start)
    assert rows_of(table.rows()) == [(2, "b", 1)]
    assert len(list((tmp_path / "t/data/rows").iterdir())) == 1
    table.merge(start)
    assert rows_of(table.rows()) == [(1, "a", 1), (2, "b", 1)]


def test_a_refresh_rolls_up_changed_months_only(spark, tmp_path):
    def transactions(rows):
        return curated_frame(spark, "transactions", [(i, 10000, day, kind, amount, "Branch", None) for i, day, kind, amount in rows])

    cards = curated_frame(spark, "card_transactions", [(1, 3000, date(2024, 1, 9), "Fuel", "5.00", 1), (2, 3000, date(2024, 3, 9), "Fuel", "7.00", 0)])
    facts = MonthlyFacts(spark, str(tmp_path / "facts"))
    rollups = Rollups(spark, str(tmp_path / "rollups"), facts)
    others = {name: curated_frame(spark, name, [tuple(VALID[name].split(","))]) for name in TABLES}
    with pytest.raises(FileNotFoundError, match="refresh"):
        rollups.bank(others.__getitem__)
    first = [(1, date(2024, 1, 5), "Deposit", "10.00"), (2, date(2024, 2, 5), "Withdrawal", "4.00"), (3, date(2024, 2, 6), "Deposit", "1.00")]
    facts.replace_months("transactions", transactions(first))
    facts.replace_months("card_transactions", cards)
    months = ["2024-01", "2024-02"]
    assert rollups.refresh() == {"account_month": months, "card_month": ["2024-01", "2024-03"]} and rollups.refresh() == {}
    stored = facts.store.record()["stored"]["transactions"]
    changed = [(2, date(2024, 2, 5), "Withdrawal", "40.00"), (4, date(2024, 2, 9), "Deposit", "2.00")]
    assert facts.replace_months("transactions", transactions(changed)) == ["2024-02"]
    give_back = hide(tmp_path / f"facts/data/transactions/write={stored['2024-01']}", tmp_path / "hidden")
    assert rollups.refresh() == {"account_month": ["2024-02"]}  # January's files are not even there
    give_back()
    full = {**others, "transactions": transactions([first[0], *changed]), "card_transactions": cards}
    for mart in (marts.monthly_customer_summary, marts.monthly_customer_summary_full, marts.monthly_branch_summary, marts.customer_360):
        assert rows_of(mart(rollups.bank(others.__getitem__))) == rows_of(mart(Bank(full.__getitem__)))
    assert rows_of(facts.rows("transactions")) == rows_of(full["transactions"])
