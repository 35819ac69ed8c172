"""Whole runs: files in, store, lake and logs out."""

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest

from vaultline.operators import curation, reports
from vaultline.operators.tables import TABLES, with_parents
from vaultline.sources import commits, files, jdbc
from vaultline.sources import store as stores
from vaultline.sources.commits import CommitLog
from vaultline.sources.store import Store, WriteConflict, curate_all, curate_table, require_parents
from vaultline.sources.summary import RunSummary, append_to_log, read_log
from tests.helpers import VALID, parents_of, raw_frame, valid_row


def write_csv(folder, name, lines):
    path = folder / f"{name}.csv"
    path.write_text("\n".join([",".join(TABLES[name].columns), *lines]) + "\n")


@pytest.fixture
def raw_folder(tmp_path):
    folder = tmp_path / "bronze" / "raw"
    folder.mkdir(parents=True)
    for name in TABLES:
        write_csv(folder, name, [VALID[name]])
    return folder


def test_a_full_run_from_csv(spark, tmp_path, raw_folder):
    # A rejected customer takes its account, card and card transaction along.
    write_csv(raw_folder, "customers", [VALID["customers"], "1001,X,Male,1990-01-01,C,S,1,bad,E,1.0,2022-01-01,750"])
    write_csv(raw_folder, "accounts", [VALID["accounts"], "10001,1001,10,Savings,1.00,2022-01-15,Active"])
    write_csv(raw_folder, "cards", [VALID["cards"], "3001,1000,10001,Debit,2023-01-01,2028-01-01,1.00,Active",
                                    "3002,1000,777,Debit,2023-01-01,2028-01-01,1.00,Active"])
    write_csv(raw_folder, "card_transactions", [VALID["card_transactions"], "7001,3001,2026-01-02,Groceries,45.00,0"])
    store, log = Store(spark, str(tmp_path / "store")), str(tmp_path / "log")
    summaries = curate_all(store, files.raw_folder_reader(spark, str(raw_folder)),
                           log=lambda s: append_to_log(spark, log, s))
    assert list(summaries) == list(TABLES)
    assert all(s.total_records == s.curated_records + s.bad_records for s in summaries.values())
    bad = {n: s.bad_records for n, s in summaries.items() if s.bad_records}
    assert bad == {"customers": 1, "accounts": 1, "cards": 2, "card_transactions": 1}
    for name in TABLES:
        assert store.curated(name).count() == 1
        assert store.curated(name).schema == TABLES[name].schema
    reason = store.quarantine("card_transactions").first()["rejection_reason"]
    assert reason == "Card ID 3001 not found in Curated Cards"
    entry = read_log(spark, log).first()
    assert (entry["status"], entry["total_records"], entry["bad_records"]) == ("SUCCESS", 15, 5)
    assert set(entry["rejection_reasons"]) == set(TABLES) and entry["rejection_reasons"]["branches"] == {}
    assert entry["rejection_reasons"]["card_transactions"] == {"Card ID 3001 not found in Curated Cards": 1}

    rows = {name: store.rows(name) for name in TABLES}
    cascade = {r["table_name"]: tuple(r)[1:] for r in reports.cascade_report(rows).collect()}
    assert cascade["accounts"] == (1, 0, 0) and cascade["cards"] == (1, 0, 1) and cascade["card_transactions"] == (1, 0, 0)
    report = {r["table_name"]: r for r in reports.quality_report(rows).collect()}
    assert report["TOTAL"]["total_records"] == 15 and report["cards"]["main_stage"] == "Referential Integrity"
    assert report["branches"]["pass_rate_pct"] == 100.0 and report["branches"]["top_rule"] is None


def test_missing_input_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no.csv"):
        files.read_raw(spark, str(tmp_path / "no.csv"))
    with pytest.raises(FileNotFoundError, match="customers"):
        require_parents(TABLES["accounts"], {})


def test_cells_that_mean_no_value(spark, tmp_path, raw_folder):
    write_csv(raw_folder, "branches", ['30,"NA","a, ""b""",null,2022-01-01,x'])
    row = files.read_raw(spark, str(raw_folder / "branches.csv")).first()
    assert (row["branch_name"], row["city"], row["state"]) == (None, 'a, "b"', None)


def test_a_failed_run_is_logged(spark, tmp_path, raw_folder):
    (raw_folder / "customers.csv").unlink()
    logged = []
    with pytest.raises(FileNotFoundError):
        curate_all(Store(spark, str(tmp_path / "s")), files.raw_folder_reader(spark, str(raw_folder)),
                   ("branches", "customers"), log=logged.append)
    assert [(s.status, s.total_records) for s in logged] == [("FAILED", 1)]


def test_empty_table_and_rerun(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    table = TABLES["branches"]
    first = curate_table(store, table, raw_frame(spark, "branches", [valid_row("branches", ifsc_code=None)]), {})
    assert (first.curated_records, first.bad_records) == (0, 1)
    assert store.curated("branches").count() == 0 and store.curated("branches").schema == table.schema
    # A second run without rows leaves nothing of the first behind.
    second = curate_table(store, table, raw_frame(spark, "branches", []), {})
    assert (second.total_records, second.record()["success_rate_pct"]) == (0, 0.0)
    assert store.quarantine("branches").count() == 0


def test_result_does_not_depend_on_partitions(spark, tmp_path):
    rows = [valid_row("accounts", account_id=str(i % 40), customer_id=str(999 + i % 3)) for i in range(60)]
    results = []
    for parts in (1, 5):
        store = Store(spark, str(tmp_path / f"store{parts}"))
        raw = raw_frame(spark, "accounts", rows).repartition(parts)
        curate_table(store, TABLES["accounts"], raw, parents_of(spark, "accounts"), datetime(2026, 1, 1))
        results.append((sorted(map(tuple, store.curated("accounts").collect()), key=repr),
                        sorted(map(tuple, store.quarantine("accounts").collect()), key=repr)))
    assert results[0] == results[1]


def test_lake_skips_missing_and_writes_zones(spark, tmp_path, raw_folder):
    (raw_folder / "employees.csv").unlink()
    write_csv(raw_folder, "transactions", [VALID["transactions"], "50001,10000,2026-01-01,Deposit,-1,Mobile App,Salary"])
    summaries = files.curate_lake(spark, str(tmp_path))
    assert list(summaries) == ["branches", "customers", "accounts", "transactions"]
    good, bad = files.read_lake(spark, str(tmp_path), "transactions")
    assert (good.count(), bad.count()) == (1, 1)
    assert not (tmp_path / "quarantine" / "branches").exists()
    assert files.read_lake(spark, str(tmp_path), "branches")[1].count() == 0
    # Without accounts every transaction is an orphan; the old quarantine is replaced.
    (raw_folder / "accounts.csv").unlink()
    files.curate_lake(spark, str(tmp_path))
    good, bad = files.read_lake(spark, str(tmp_path), "transactions")
    assert (good.count(), bad.count()) == (0, 2)


def test_order_of_tables():
    assert with_parents(["card_transactions"]) == ["customers", "accounts", "cards", "card_transactions"]


def test_summary_rates():
    at = datetime(2026, 1, 1)
    record = RunSummary("x", at, at, 3, 2, 1).record()
    assert (record["success_rate_pct"], record["failure_rate_pct"], record["duration_seconds"]) == (66.67, 33.33, 0.0)


def test_jdbc_options():
    options = jdbc.jdbc_options("jdbc:postgresql://h/db", "accounts", "u", "p", "account_id", (1, 1000), 8)
    assert options["partitionColumn"] == "account_id" and options["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:postgresql://h/db", "accounts", "u", "")
    with pytest.raises(ValueError, match="bounds"):
        jdbc.jdbc_options("jdbc:postgresql://h/db", "accounts", "u", "p", "account_id", partitions=8)
    assert "numPartitions" not in jdbc.jdbc_options("jdbc:postgresql://h/db", "accounts", "u", "p")


def branches(spark, *ids):
    rows = [valid_row("branches", branch_id=str(i), ifsc_code=None if i < 0 else "HRB00731") for i in ids]
    return curation.validated(raw_frame(spark, "branches", rows), TABLES["branches"], {})


def ids(reading):
    return sorted(r["branch_id"] for r in reading.curated("branches").collect())


def test_a_write_that_dies_before_its_record_changes_nothing(spark, tmp_path, monkeypatch):
    store, table = Store(spark, str(tmp_path / "store")), TABLES["branches"]
    assert store.write(table, branches(spark, 1, 2, -1)) == (2, 1)

    def die(*_):
        raise SystemExit("killed")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", die)
        patch.setattr(commits, "remove", lambda *_: None)  # a killed process cleans up nothing
        with pytest.raises(SystemExit):
            store.write(table, branches(spark, 7))
    assert ids(store) == [1, 2] and store.snapshots("branches") == [1]
    assert store.sweep("branches") == []  # it may still be running
    assert len(store.sweep("branches", older_than=-1)) == 1
    assert ids(store) == [1, 2] and store.write(table, branches(spark, 8)) == (1, 0) and ids(store) == [8]
    with monkeypatch.context() as patch:
        patch.setattr(stores, "write_partitioned", die)
        with pytest.raises(SystemExit):
            store.write(table, branches(spark, 9))
    assert ids(store) == [8] and len(list((tmp_path / "store" / "branches" / "data").iterdir())) == 2


def test_readers_keep_their_snapshot_and_old_ones_go(spark, tmp_path):
    store, table = Store(spark, str(tmp_path / "store"), kept=2), TABLES["branches"]
    with pytest.raises(FileNotFoundError, match="branches"):
        store.rows("branches")
    store.write(table, branches(spark, 1))
    pinned, opened = store.pinned(), store.curated("branches")
    store.write(table, branches(spark, 2, -3))
    assert ids(pinned) == [1] and opened.count() == 1 and ids(store) == [2]
    assert (store.snapshot("branches").good, store.snapshot("branches").bad, store.snapshot("branches", 1).good) == (1, 1, 1)
    with pytest.raises(FileNotFoundError):
        pinned.curated("loans")
    for i in (4, 5, 6):
        store.write(table, branches(spark, i))
    assert store.snapshots("branches") == [4, 5] and ids(store) == [6]
    data = {path.name for path in (tmp_path / "store" / "branches" / "data").iterdir()}
    assert data == {store.snapshot("branches", n).folder.rsplit("/", 1)[1] for n in (4, 5)}


def test_of_two_writers_one_is_refused(spark, tmp_path, monkeypatch):
    store, table, real = Store(spark, str(tmp_path / "store")), TABLES["branches"], stores.write_partitioned
    inner = []

    def overtaken(rows, path, *columns):
        real(rows, path, *columns)
        if not inner:
            inner.append("begun")
            store.write(table, branches(spark, 2, 3))

    monkeypatch.setattr(stores, "write_partitioned", overtaken)
    with pytest.raises(WriteConflict, match="branches"):
        store.write(table, branches(spark, 1))
    assert ids(store) == [2, 3] and len(list((tmp_path / "store" / "branches" / "data").iterdir())) == 1


@pytest.mark.parametrize("renamed", [False, True])
def test_a_record_is_made_by_one_writer(spark, tmp_path, renamed):
    path = f"{tmp_path}/log/000000000001.json"

    def attempt(i):
        if not renamed:
            return commits.create_once(spark, path, f"writer {i}")
        place, _ = commits._located(spark, path)
        return commits._renamed(spark, place, place.getParent(), f".draft-{i}", f"writer {i}")

    if renamed:  # the local file system has no rename of one step: one after the other
        made = [attempt(i) for i in range(3)]
    else:
        with ThreadPoolExecutor(8) as pool:
            made = list(pool.map(attempt, range(8)))
    assert sum(made) == 1 and commits.read_text(spark, path) == f"writer {made.index(True)}"
    assert [name for name in commits.names(spark, f"{tmp_path}/log") if not name.endswith(".crc")] == ["000000000001.json"]
    assert CommitLog(spark, f"{tmp_path}/log").last() == 1


LINES = (
    b"branch_id,branch_name,city,state,opened_date,ifsc_code\n"
    b"1,Plain,Kochi,KL,2020-01-01,HRB00001\n"
    b'2,"a, ""b"" c",Kochi,KL,2020-01-01,HRB00002\r\n'
    b"3,Short,Kochi\n"
    b"4,Long,Kochi,KL,2020-01-01,HRB00004,x,y\n"
    b'5,"never closed,Kochi,KL,2020-01-01,HRB00005\n'
    b'6,"closed" early,Kochi,KL,2020-01-01,HRB00006\n'
    b"7,caf\xe9,Kochi,KL,2020-01-01,HRB00007\n"
    b'8,in "the" middle,Kochi,KL,2020-01-01,HRB00008\n'
    b"\n"
    b"branch_id,branch_name,city,state,opened_date,ifsc_code\n"
    b"9,caf\xc3\xa9 \x01,NA,,2020-01-01,HRB00009"
)


def test_lines_that_are_no_rows_are_kept_apart(spark, tmp_path):
    (tmp_path / "branches.csv").mkdir()
    (tmp_path / "branches.csv" / "a.csv").write_bytes(LINES)
    (tmp_path / "branches.csv" / "b.csv").write_bytes(LINES[: LINES.index(b"2,")])
    got = files.ingest(spark, str(tmp_path / "branches.csv"), str(tmp_path / "stored"))
    rows = sorted(map(tuple, got.rows.collect()))
    at, end = "2020-01-01", "HRB0000"
    assert rows == sorted([
        ("1", "Plain", "Kochi", "KL", at, end + "1"), ("1", "Plain", "Kochi", "KL", at, end + "1"),
        ("2", 'a, "b" c', "Kochi", "KL", at, end + "2"), ("3", "Short", "Kochi", None, None, None),
        ("8", 'in "the" middle', "Kochi", "KL", at, end + "8"), tuple(TABLES["branches"].columns),
        ("9", "café \x01", None, None, at, end + "9"),
    ], key=lambda r: r)
    damaged = sorted((r["damage"], r["fields"], r["line"], r["file"].endswith("a.csv")) for r in got.damaged.collect())
    assert [d[0] for d in damaged] == ["Not UTF-8", "Too many fields", "Unbalanced quotes", "Unbalanced quotes"]
    assert damaged[0][2].startswith("7,caf\ufffd,Kochi") and damaged[1][1:3] == (8, "4,Long,Kochi,KL,2020-01-01,HRB00004,x,y")
    assert all(d[3] for d in damaged)
    assert (got.delivered, got.short, got.damage) == (7, 1, {"Not UTF-8": 1, "Too many fields": 1, "Unbalanced quotes": 2})
    assert got.lines == 11


def test_files_of_other_headers_and_none(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no.csv"):
        files.ingest(spark, str(tmp_path / "no.csv"), str(tmp_path / "stored"))
    folder = tmp_path / "two.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    (folder / "b.csv").write_text("y,x\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.ingest(spark, str(folder), str(tmp_path / "stored"))


def test_a_run_over_ingested_files_equals_a_run_over_sound_ones(spark, tmp_path, raw_folder):
    with open(raw_folder / "customers.csv", "a") as file:
        file.write("one,two\n" + VALID["customers"].replace("1000", "1001", 1) + ",surplus\n")
    plain, deliveries = Store(spark, str(tmp_path / "ingested")), {}
    summaries = curate_all(plain, files.ingesting_reader(spark, str(raw_folder), str(tmp_path / "bronze2"), deliveries))
    assert set(deliveries) == set(TABLES) and deliveries["customers"].damage == {"Too many fields": 1}
    assert (summaries["customers"].total_records, summaries["customers"].bad_records) == (2, 1)
    assert all(plain.curated(name).count() == 1 for name in TABLES)
    assert all(d.lines == d.delivered for name, d in deliveries.items() if name != "customers")
