"""Flags, routes, windows, late events and replays."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vaultline.sources.commits import CommitLog
from vaultline.streaming import events as E

AT = datetime(2024, 1, 1, 12, 0, 0)
SAMPLE = [
    (101, 1001, 250.0, "UPI", "Transfer Out", AT),
    (102, 1002, 14500.0, "Online Banking", "Transfer Out", AT),
    (103, 1003, 45.2, "POS", "Withdrawal", AT),
    (104, 1004, -10.0, "ATM", "Fee Debit", AT),
    (105, 1005, 950.0, "Mobile App", "Deposit", AT),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, E.EVENT_SCHEMA)


def test_flags(spark):
    flagged = E.flag_events(frame(spark, SAMPLE))
    reasons = {r["transaction_id"]: r["risk_reason"] for r in flagged.collect()}
    assert reasons == {101: E.NORMAL, 102: E.HIGH, 103: E.NORMAL, 104: E.INVALID, 105: E.NORMAL}
    assert tuple(E.stream_summary(flagged).first()) == (5, 3, 2)
    edge = E.flag_events(frame(spark, [(1, 1, 10000.0, "x", "y", AT), (2, 1, None, "x", "y", AT), (3, 1, 9999.99, "x", "y", AT)]))
    assert [r["risk_reason"] for r in edge.orderBy("transaction_id").collect()] == [E.HIGH, E.INVALID, E.NORMAL]


@pytest.fixture
def source(spark, tmp_path):
    """A folder that files are added to one after the other."""
    folder = tmp_path / "events"
    folder.mkdir()

    def add(rows):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(folder))

    add.path = str(folder)
    return add


def test_routes(spark, tmp_path, source):
    source(SAMPLE)
    flagged = E.flag_events(E.read_stream(spark, source.path, E.EVENT_SCHEMA))
    path = str(tmp_path / "routed")
    for _ in range(2):  # a second run finds nothing new
        E.route_events(flagged, path, str(tmp_path / "check")).awaitTermination()
    routes = E.read_routes(spark, path, flagged.schema)
    assert sorted(r["transaction_id"] for r in routes.where("is_flagged").collect()) == [102, 104]
    assert tuple(E.stream_summary(routes).first()) == (5, 3, 2)


def minute(n, second=0):
    return datetime(2024, 1, 1, 12 + n // 60, n % 60) + timedelta(seconds=second)


@pytest.mark.parametrize("fold_every", [100, 2, 1])
def test_windows_as_stream_equal_windows_as_batch(spark, tmp_path, source, fold_every):
    rows = [(i, i % 3, 1.5 * i, "UPI" if i % 2 else "ATM", "t", minute(i % 17, i % 60)) for i in range(60)]
    for part in (rows[:20], rows[20:40], rows[40:]):
        source(part)
    stream = E.read_stream(spark, source.path, E.EVENT_SCHEMA, files_per_trigger=1)
    windows = E.sliding(stream, late="1 hour")
    path = str(tmp_path / "windows")
    keys = ["window_start", "window_end", "channel"]
    E.update_sink(windows, path, str(tmp_path / "check"), keys, fold_every).awaitTermination()
    got = E.read_updates(spark, path, windows.schema, keys).orderBy(*keys).collect()
    want = E.sliding(spark.read.parquet(source.path)).orderBy(*keys).collect()
    assert got == want and len(want) > 30
    # three files, and a micro-batch without events behind them
    log = CommitLog(spark, f"{path}/log")
    assert log.last() == 4 and len(log.read(4)["batches"]) == {100: 4, 2: 2, 1: 1}[fold_every]
    if fold_every == 1:  # numbers from another checkpoint would be taken for replays
        with pytest.raises(Exception, match="holds results of the checkpoint"):
            E.update_sink(windows, path, str(tmp_path / "other"), keys).awaitTermination()


def test_a_reader_sees_whole_micro_batches_only(spark, tmp_path, source, monkeypatch):
    """The state before, while a fold is half written; the state after, once it is recorded; old folders go."""
    path, check, keys = str(tmp_path / "windows"), str(tmp_path / "check"), ["window_start", "window_end", "channel"]
    seen, real = [], CommitLog.commit

    def run(fail=False):
        windows = E.tumbling(E.read_stream(spark, source.path, E.EVENT_SCHEMA), late="1 hour")

        def recorded(log, base, record):
            if log.folder.startswith(path):
                seen.append((base, E.read_updates(spark, path, windows.schema, keys).groupBy().sum("events").first()[0]))
                if fail:
                    raise RuntimeError("killed")
            return real(log, base, record)

        with monkeypatch.context() as patch:
            patch.setattr(CommitLog, "commit", recorded)
            query = E.update_sink(windows, path, check, keys, fold_every=2, kept=2)
            try:
                query.awaitTermination()
            except Exception:  # noqa: BLE001
                assert fail
        return E.read_updates(spark, path, windows.schema, keys).groupBy().sum("events").first()[0]

    source([(1, 1, 1.0, "UPI", "t", minute(1)), (2, 1, 1.0, "ATM", "t", minute(2))])
    assert run() == 2
    for n in range(3, 6):
        source([(n, 1, 1.0, "UPI", "t", minute(n))])
        if n == 4:  # dies with its folder written and no record: the state before stays
            assert run(fail=True) == n - 1
        assert run() == n
    before = [total for _, total in seen]
    assert before == sorted(before, key=lambda x: x or 0) and None in before and 2 in before
    folders = {int(p.name.partition("=")[2]) for p in (tmp_path / "windows" / "data").glob("batch=*")}
    log = CommitLog(spark, f"{path}/log")
    assert len(log.numbers()) == 2 and {b for n in log.numbers() for b in log.read(n)["batches"]} == folders


def test_bursts_by_gaps(spark, tmp_path, source):
    rows = [(i, 1, 10.0, "UPI", "t", minute(0, 50 * i)) for i in range(8)]  # 0:00 to 5:50, longer than one gap
    rows += [(20, 1, 1.0, "UPI", "t", minute(12)), (21, 2, 5.0, "UPI", "t", minute(0)), (22, 2, 5.0, "UPI", "t", minute(4, 59)),
             (23, 3, 1.0, "UPI", "t", minute(0)), (24, 3, 1.0, "UPI", "t", minute(5, 1))]
    want = {(1, 8, 80), (2, 2, 10)}
    got = E.bursts(frame(spark, rows), 2)
    assert {(r["account_id"], r["events"], int(r["amount"])) for r in got.collect()} == want
    path, check = str(tmp_path / "bursts"), str(tmp_path / "check")

    def stream():
        found = E.bursts(E.read_stream(spark, source.path, E.EVENT_SCHEMA), 2)
        E.append_sink(found, path, check).awaitTermination()
        return sorted((r["account_id"], r["events"], int(r["amount"])) for r in spark.read.schema(found.schema).parquet(path).collect())

    source(rows[:4] + rows[9:10])
    assert stream() == []
    source(rows[4:9] + rows[10:])
    source([(99, 9, 1.0, "UPI", "t", minute(59))])
    assert stream() == sorted(want)
    source([(100, 1, 10.0, "UPI", "t", minute(6))])  # too late
    assert stream() == sorted(want)


def test_late_events_do_not_change_a_closed_window(spark, tmp_path, source):
    path, check = str(tmp_path / "closed"), str(tmp_path / "check")

    def run():
        stream = E.read_stream(spark, source.path, E.EVENT_SCHEMA)
        E.append_sink(E.tumbling(stream), path, check).awaitTermination()
        rows = spark.read.parquet(path).orderBy("window_start").collect()
        return [(r["window_start"].minute, r["events"]) for r in rows]

    source([(1, 1, 1.0, "UPI", "t", minute(1)), (2, 1, 1.0, "UPI", "t", minute(2)), (3, 1, 1.0, "UPI", "t", minute(40))])
    assert run() == [(0, 2)]
    source([(4, 1, 1.0, "UPI", "t", minute(3)), (5, 1, 1.0, "UPI", "t", minute(31)), (6, 1, 1.0, "UPI", "t", minute(59))])
    assert run() == [(0, 2), (30, 1), (40, 1)]


def test_velocity_alerts(spark):
    rows = [(i, 1, 10.0, "UPI", "t", minute(0, 10 * i)) for i in range(4)] + [(9, 2, 500.0, "UPI", "t", minute(0))]
    alerts = E.velocity_alerts(frame(spark, rows), min_events=4, min_amount=500.0)
    assert {r["account_id"] for r in alerts.collect()} == {1, 2}
    assert {r["account_id"] for r in E.velocity_alerts(frame(spark, rows), min_events=4).collect()} == {1}


def test_replays_are_dropped(spark, tmp_path, source):
    path, check = str(tmp_path / "once"), str(tmp_path / "check")
    for _ in range(2):
        source(SAMPLE)
        stream = E.drop_replays(E.read_stream(spark, source.path, E.EVENT_SCHEMA))
        E.append_sink(stream, path, check).awaitTermination()
    ids = [r["transaction_id"] for r in spark.read.parquet(path).orderBy(F.col("transaction_id")).collect()]
    assert ids == [101, 102, 103, 104, 105]
