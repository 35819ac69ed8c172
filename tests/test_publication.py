"""All tables become current together or not at all."""

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest

from vaultline.operators import audit
from vaultline.operators.merge import latest_per_key
from vaultline.operators.tables import TABLES
from vaultline.sources import publication
from tests.helpers import VALID, curated_frame


def tables(spark, **changes):
    rows = {name: [tuple(VALID[name].split(","))] for name in TABLES}
    rows.update(changes)
    return {name: curated_frame(spark, name, r) for name, r in rows.items()}


def test_publish_refuse_and_keep(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    assert publication.current_version(spark, root) is None
    first = publication.publish(spark, root, tables(spark))
    assert publication.current_version(spark, root) == first
    orphan = [(99999, 99999999, 10, "Savings", "1000.00", "2022-01-01", "Active")]
    with pytest.raises(publication.PublicationRefused, match="accounts.customer_id"):
        publication.publish(spark, root, tables(spark, accounts=orphan))
    assert publication.current_version(spark, root) == first
    assert publication.published(spark, root, "accounts").first()["account_id"] == 10000
    incomplete = tables(spark)
    del incomplete["cards"]
    with pytest.raises(FileNotFoundError, match="cards"):
        publication.publish(spark, root, incomplete)
    row = publication.versions(spark, root).first()
    assert row["version"] == first and row["tables"]["accounts"] == 1


def test_constraint_audit_finds_rounded_away_values(spark):
    wrong = tables(
        spark,
        transactions=[(1, 10000, "2026-01-01", "Deposit", "0.00", "Branch", None), (2, 10000, "2026-01-01", "Deposit", None, "Atm", None)],
        loans=[(1, 1000, 10, "Home Loan", "1.00", "1.00", 0, "2024-01-01", "Active")],
        branches=[(10, "x" * 151, "c", "s", None, "i")],
    )
    found = {tuple(r)[:3]: r["violations"] for r in audit.constraint_audit(wrong).collect() if r["violations"]}
    assert found == {
        ("transactions", "amount", "check"): 1,
        ("transactions", "amount", "not_null"): 1,
        ("loans", "term_months", "check"): 1,
        ("branches", "branch_name", "max_length"): 1,
    }


def test_key_audits(spark):
    wrong = tables(
        spark,
        employees=[(1, "a", 10, "Teller", None, "1.00"), (1, "b", 11, "Teller", None, "1.00"), (None, "c", None, "Teller", None, "1.00")],
    )
    keys = {r["table_name"]: (r["duplicate_keys"], r["missing_keys"]) for r in audit.pk_audit(wrong).collect()}
    assert keys["employees"] == (1, 1) and keys["branches"] == (0, 0)
    orphans = {(r["table_name"], r["fk_column"]): r["orphan_count"] for r in audit.fk_audit(wrong).collect()}
    assert len(orphans) == 11 and orphans[("employees", "branch_id")] == 1 and sum(orphans.values()) == 1


def test_only_given_months_are_replaced(spark, tmp_path):
    path = str(tmp_path / "by-month")
    schema = "id long, d date"
    publication.publish_by_month(spark.createDataFrame([(1, date(2024, 1, 5)), (2, date(2024, 2, 5))], schema), "d", path)
    publication.publish_by_month(spark.createDataFrame([(3, date(2024, 2, 6))], schema), "d", path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_latest_row_per_key(spark):
    schema = "k long, v string, at int, n int"
    current = spark.createDataFrame([(1, "old", 1, 0), (2, "kept", 9, 0)], schema)
    changes = spark.createDataFrame([(1, "new", 2, 1), (1, "newest", 2, 2), (2, "late", 3, 1), (3, "added", 1, 1)], schema)
    got = {r["k"]: r["v"] for r in latest_per_key(current, changes, "k", ["at", "n"]).collect()}
    assert got == {1: "newest", 2: "kept", 3: "added"}


def test_overlapping_publishers_and_all_findings(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "shared")
    publication.publish(spark, root, tables(spark))
    real = publication.findings
    second = []

    def overtaken(frames):
        if not second:
            second.append(None)
            second[0] = publication.publish(spark, root, tables(spark))
        return real(frames)

    monkeypatch.setattr(publication, "findings", overtaken)
    with pytest.raises(publication.PublicationRefused, match="number 1"):
        publication.publish(spark, root, tables(spark))
    assert publication.current_version(spark, root) == second[0]


def folders(root):
    return {path.name for path in (root / "versions").iterdir()}


def test_of_two_publishers_past_their_audits_one_is_refused(spark, tmp_path, monkeypatch):
    root, real, both = tmp_path / "shared", publication._staged, threading.Barrier(2)

    def staged(*arguments):
        counts = real(*arguments)
        both.wait(120)  # each has seen that nothing is published
        return counts

    monkeypatch.setattr(publication, "_staged", staged)
    frames = tables(spark)

    def attempt(_):
        try:
            return publication.publish(spark, str(root), frames)
        except publication.PublicationRefused as error:
            return error

    with ThreadPoolExecutor(2) as pool:
        results = list(pool.map(attempt, range(2)))
    done = [x for x in results if isinstance(x, str)]
    assert len(done) == 1 and "another version followed number 0" in str(next(x for x in results if x != done[0]))
    assert publication.current_version(spark, str(root)) == done[0]
    assert folders(root) == {done[0]}
    row = publication.versions(spark, str(root)).collect()
    assert [(r["number"], r["base"], r["version"]) for r in row] == [(1, 0, done[0])]


def test_refused_and_retired_versions_are_removed(spark, tmp_path):
    root, small = tmp_path / "shared", ("branches",)
    kept = [publication.publish(spark, str(root), tables(spark), small) for _ in range(3)]
    with pytest.raises(publication.PublicationRefused):
        publication.publish(spark, str(root), tables(spark, branches=[(None, "n", "c", "s", None, "i")]), small)
    assert folders(root) == set(kept)
    reading = publication.published(spark, str(root), "branches", kept[1])
    assert publication.retire(spark, str(root), kept=2) == kept[:1]
    assert folders(root) == set(kept[1:]) and reading.count() == 1
    (root / "versions" / "killed").mkdir()
    assert publication.sweep(spark, str(root)) == []
    assert publication.sweep(spark, str(root), older_than=-1) == ["killed"]
    assert publication.current_version(spark, str(root)) == kept[2]
