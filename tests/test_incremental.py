"""Batch by batch gives what one run over all batches gives."""

import pytest
from pyspark.sql import functions as F

from vaultline.operators.tables import TABLES
from vaultline.sources.buckets import Overtaken
from vaultline.sources.commits import CommitLog
from vaultline.sources.incremental import IncrementalStore
from vaultline.sources.store import Store, curate_all
from vaultline.starbank import registry
from tests.helpers import raw_frame, valid_row

NAMES = ("branches", "customers", "accounts", "cards")
#: Three batches: an account waits for its customer, keys come again, a parent is rejected late.
BATCHES = [
    {
        "branches": [valid_row("branches")],
        "customers": [valid_row("customers"), valid_row("customers", customer_id="1003")],
        "accounts": [valid_row("accounts"), valid_row("accounts", account_id="10001", customer_id="1001"),
                     valid_row("accounts", account_id="10003", customer_id="1003"), valid_row("accounts", account_id="A7")],
        "cards": [valid_row("cards"), valid_row("cards", card_id="3001", customer_id="1001", account_id="10001"),
                  valid_row("cards", card_id="3003", customer_id="1003", account_id="10003"), valid_row("cards", card_id=None)],
    },
    {
        "customers": [valid_row("customers", customer_id=" 1001 "), valid_row("customers", customer_id="9000000")],
        "accounts": [valid_row("accounts", account_id="A7", balance="-1"), valid_row("accounts", account_id="77777", customer_id="9000000")],
        "cards": [valid_row("cards", card_id="")],
    },
    {
        "customers": [valid_row("customers", customer_id="1003.0"), valid_row("customers", customer_id="1004", email="none")],
        "accounts": [valid_row("accounts", account_id="10000", customer_id="1001")],
    },
]


def frames(spark, batch):
    return {name: raw_frame(spark, name, rows) for name, rows in batch.items()}


def state(reading):
    good = {name: sorted(map(str, reading.curated(name).collect())) for name in NAMES}
    bad = {name: sorted(map(str, reading.quarantine(name).drop("processed_at").collect())) for name in NAMES}
    return good, bad


def whole(spark, tmp_path, many):
    """One run over the first batches."""
    rows = {name: [row for batch in BATCHES[:many] for row in batch.get(name, [])] for name in NAMES}
    store = Store(spark, str(tmp_path / f"whole{many}"))
    curate_all(store, lambda name: raw_frame(spark, name, rows[name]), NAMES)
    return state(store)


def test_batches_in_sequence_equal_one_run(spark, tmp_path):
    store = IncrementalStore(spark, str(tmp_path / "store"), buckets=8, span=1)
    for number, batch in enumerate(BATCHES, 1):
        applied = store.apply(number, frames(spark, batch))
        assert not applied.skipped and set(applied.touched) >= set(batch)
        if number > 1:
            got = state(store)
            assert got == whole(spark, tmp_path, number)
    good = {name: len(rows) for name, rows in got[0].items()}
    # 1003 came again, so its account and card go; 10000 came again, so its card goes; 1001 came late
    assert good == {"branches": 1, "customers": 3, "accounts": 2, "cards": 1}
    assert store.apply(3, frames(spark, BATCHES[0])).skipped and state(store) == got


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    store = IncrementalStore(spark, str(tmp_path / "store"), buckets=16, span=1)
    rows = [valid_row("branches", branch_id=str(i)) for i in range(64)]
    store.apply(1, {"branches": raw_frame(spark, "branches", rows)})
    before = store.store.record()["stored"]["branches"]
    key = 64
    touched = spark.range(1).select(store._bucket_of_key(F.lit(key))).first()[0]
    others = [b for b in before if int(b) != touched]
    hidden = tmp_path / "hidden"
    hidden.mkdir()
    for bucket in others:  # what is not touched may not even be there
        (tmp_path / f"store/data/branches/write={before[bucket]}/bucket={bucket}").rename(hidden / bucket)
    applied = store.apply(2, {"branches": raw_frame(spark, "branches", [valid_row("branches", branch_id=str(key))])})
    assert applied.touched == {"branches": [touched]}
    after = store.store.record()["stored"]["branches"]
    assert {b for b in after if after[b] != before.get(b)} == {str(touched)}
    for bucket in others:
        (hidden / bucket).rename(tmp_path / f"store/data/branches/write={before[bucket]}/bucket={bucket}")
    assert store.curated("branches").count() == 65


def test_a_batch_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    store = IncrementalStore(spark, str(tmp_path / "store"), buckets=4)
    one = {"branches": raw_frame(spark, "branches", [valid_row("branches")])}
    store.apply(1, one)
    before, folder = store.store.record(), tmp_path / "store/data/branches"

    def die(*_):
        raise SystemExit("killed")

    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", die)
        with pytest.raises(SystemExit):
            store.apply(2, one)
    assert store.store.record() == before and len(list(folder.iterdir())) == 1 and store.curated("branches").count() == 1
    with monkeypatch.context() as patch:
        patch.setattr(CommitLog, "commit", lambda *_: None)
        with pytest.raises(Overtaken, match="another change"):
            store.apply(2, one)
    store.apply(2, one)  # the same branch again: both are duplicates now
    assert (store.curated("branches").count(), store.quarantine("branches").count()) == (0, 2)
    store.expire(kept=1)
    assert len(list(folder.iterdir())) == 1 and store.quarantine("branches").count() == 2
    assert set(TABLES) > set(store.store.record()["stored"])


class Counted:
    """A store that keeps what it is given, all of it good."""

    def __init__(self, *_, **__):
        self.batches = []

    def apply(self, number, raw):
        self.batches.append({name: frame.collect() for name, frame in raw.items()})
        self.raw = raw

    def curated(self, name):
        rows = [row for batch in self.batches for row in batch[name]]
        return self.raw[name].sparkSession.createDataFrame(rows, self.raw[name].schema)

    def quarantine(self, name):
        return self.raw[name].limit(0).selectExpr("'' AS rejection_reason", "'' AS validation_stage")


def test_raw_rows_are_dealt_into_batches_once(spark, tmp_path, monkeypatch):
    read, raw = [], {name: raw_frame(spark, name, [valid_row(name, **{TABLES[name].key: str(i)}) for i in range(20)]) for name in TABLES}
    monkeypatch.setattr(registry, "IncrementalStore", Counted)
    monkeypatch.setattr(registry, "raw_table", lambda _, folder, name: read.append(name) or raw[name])
    found = registry.three_batches(spark, str(tmp_path)).collect()
    assert sorted(read) == sorted(TABLES)
    assert {r["table_name"]: r["n"] for r in found} == dict.fromkeys(TABLES, 20)
