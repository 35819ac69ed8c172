"""The curated store: per table immutable snapshots, each partitioned into good and bad rows.

``<table>/data/<id>`` holds the rows of one write and is never changed; ``<table>/log`` is a commit
log whose last record names the folder that is current. A write that fails or is killed before its
record leaves the snapshot before it current, and a reader keeps the folder it opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.operators import curation, reports
from vaultline.operators.keys import KeySet, unique_key_set
from vaultline.operators.tables import TABLES, Table
from vaultline.sources import commits
from vaultline.sources.commits import CommitLog
from vaultline.sources.scratch import write_partitioned
from vaultline.sources.summary import RunSummary


#: So many snapshots of a table are kept, the current one among them.
KEPT_SNAPSHOTS = 3


class WriteConflict(RuntimeError):
    """Another writer replaced the table since this write began."""


@dataclass(frozen=True)
class Snapshot:
    """One state of a table: its number, the folder of its rows, and how many are good and bad."""

    table: str
    number: int
    folder: str
    good: int
    bad: int


class Reading:
    """Curated and quarantined rows by table; where a table's rows are is for subclasses to say."""

    spark: SparkSession

    def snapshot(self, name: str) -> Snapshot:
        raise NotImplementedError

    def rows(self, name: str) -> DataFrame:
        return self.spark.read.schema(curation.stored_schema(TABLES[name])).parquet(self.snapshot(name).folder)

    def curated(self, name: str) -> DataFrame:
        return curation.good_rows(self.rows(name), TABLES[name])

    def quarantine(self, name: str) -> DataFrame:
        return curation.bad_rows(self.rows(name), TABLES[name])

    def parent_keys(self, name: str) -> KeySet:
        """The curated ids of a table: its key column alone is read."""
        return unique_key_set(self.curated(name), TABLES[name].key)


class Store(Reading):
    """Curated and quarantined tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, kept: int = KEPT_SNAPSHOTS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.kept = max(1, kept)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def log(self, name: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.path(name)}/log")

    def _data(self, name: str, folder: str) -> str:
        return f"{self.path(name)}/data/{folder}"

    def snapshot(self, name: str, number: int | None = None) -> Snapshot:
        """The current snapshot of a table, or one of those before it that are kept."""
        log = self.log(name)
        number = number or log.last()
        if not number:
            raise FileNotFoundError(f"no {name} below {self.root}")
        record = log.read(number)
        return Snapshot(name, number, self._data(name, record["folder"]), record["good"], record["bad"])

    def snapshots(self, name: str) -> list[int]:
        """The numbers of the snapshots that are kept, the current one last."""
        return self.log(name).numbers()

    def pinned(self, tables: Iterable[str] = tuple(TABLES)) -> PinnedStore:
        """What is current now, for reading; later writes don't show in it."""
        present = [name for name in tables if self.log(name).last()]
        return PinnedStore(self.spark, {name: self.snapshot(name) for name in present})

    def write(self, table: Table, rows: DataFrame) -> tuple[int, int]:
        """Store validated rows as the new snapshot; how many are good and how many bad, from the file footers.

        Raises ``WriteConflict`` if another write was recorded since this one began; its own rows are
        removed then, as they are after any failure that can still be acted on.
        """
        log = self.log(table.name)
        base, folder = log.last(), uuid.uuid4().hex
        path = self._data(table.name, folder)
        try:
            write_partitioned(rows, path, curation.IS_BAD)
            written = self.spark.read.schema(curation.stored_schema(table)).parquet(path)
            counts = dict(written.groupBy(curation.IS_BAD).count().collect())
            good, bad = counts.get(False, 0), counts.get(True, 0)
            if log.commit(base, {"folder": folder, "good": good, "bad": bad}) is None:
                raise WriteConflict(f"{table.name} was written by another run after snapshot {base}")
        except BaseException:
            commits.remove(self.spark, path)
            raise
        self.expire(table.name)
        return good, bad

    def expire(self, name: str) -> None:
        """Remove all but the last ``kept`` snapshots: first what names them, then their rows."""
        log = self.log(name)
        for number in log.numbers()[: -self.kept]:
            folder = log.read(number)["folder"]
            log.forget(number)
            commits.remove(self.spark, self._data(name, folder))

    def sweep(self, name: str, older_than: float = 24 * 3600) -> list[str]:
        """Remove folders that no snapshot names, left by writes that were killed; which ones.

        Folders changed within the last ``older_than`` seconds may belong to a running write and stay.
        """
        log = self.log(name)
        named = {log.read(number)["folder"] for number in log.numbers()}
        return commits.sweep(self.spark, f"{self.path(name)}/data", named, older_than)


class PinnedStore(Reading):
    """Tables as they were when this was made."""

    def __init__(self, spark: SparkSession, snapshots: Mapping[str, Snapshot]):
        self.spark, self._snapshots = spark, dict(snapshots)

    def snapshot(self, name: str) -> Snapshot:
        if name not in self._snapshots:
            raise FileNotFoundError(f"{name} was not there")
        return self._snapshots[name]


def require_parents(table: Table, stored: Mapping[str, object]) -> None:
    """Stop before any work when a curated parent is absent."""
    absent = [p.table for p in table.validated_parents if p.table not in stored]
    if absent:
        raise FileNotFoundError(f"curated {' and '.join(absent)} needed before {table.name}")


def curate_table(
    store: Store,
    table: Table,
    raw: DataFrame,
    parents: Mapping[str, KeySet],
    run_at: datetime | None = None,
) -> RunSummary:
    """Validate, standardise and store one table."""
    require_parents(table, parents)
    started = run_at or curation.run_time()
    good, bad = store.write(table, curation.validated(raw, table, dict(parents), started))
    return RunSummary(f"process_{table.name}", started, curation.run_time(), good + bad, good, bad)


def waves(tables: Iterable[str]) -> Iterator[list[str]]:
    """The tables in groups; the parents of a table are in groups before its own."""
    left = [name for name in TABLES if name in set(tables)]
    while left:
        wave = [name for name in left if not any(p.table in left for p in TABLES[name].validated_parents)]
        yield wave
        left = [name for name in left if name not in wave]


def curate_all(
    store: Store,
    read: Callable[[str], DataFrame | None],
    tables=tuple(TABLES),
    skip_missing: bool = False,
    log: Callable[[RunSummary], None] | None = None,
    at_once: int = 4,
) -> dict[str, RunSummary]:
    """Curate the tables, parents before children, so that a rejected parent rejects its children.

    ``read`` gives the raw rows of a table. With ``skip_missing`` it may give None: the table is
    skipped and its children find no parent. Tables that do not depend on one another run side by
    side, ``at_once`` at a time. A failure stops the run, once the tables beside it are through, after
    a FAILED summary of what was done is logged. The logged summary holds the three most frequent
    reasons of each table.
    """
    started, done, status = curation.run_time(), {}, "FAILED"
    keys: dict[str, KeySet] = {}
    wanted = {p.table for t in TABLES.values() for p in t.validated_parents}

    def one(name: str) -> None:
        raw, table = read(name), TABLES[name]
        if raw is None:
            if not skip_missing:
                raise FileNotFoundError(f"raw {name} not found")
            keys[name] = _no_keys(store.spark)
            return
        parents = {p.table: keys[p.table] for p in table.validated_parents if p.table in keys}
        done[name] = curate_table(store, table, raw, parents)
        if name in wanted:
            keys[name] = store.parent_keys(name)

    in_thread = inheritable_thread_target(store.spark)
    try:
        with ThreadPoolExecutor(at_once) as pool:
            for wave in waves(tables):
                running = [pool.submit(in_thread(one), name) for name in wave]
                wait(running)
                for table in running:
                    table.result()
        status = "SUCCESS"
    finally:
        summaries = {name: done[name] for name in TABLES if name in done}
        if log is not None:
            ended, reasons = curation.run_time(), _reasons(store, summaries)
            log(RunSummary.total("all tables", started, ended, summaries.values(), status, reasons))
    return summaries


def _reasons(store: Store, done: Iterable[str]) -> dict[str, dict[str, int]]:
    """Per table its most frequent reasons and how many rows each rejected; three a table reach the driver."""
    found: dict[str, dict[str, int]] = {name: {} for name in done}
    if found:
        for row in reports.top_reasons({name: store.rows(name) for name in found}).collect():
            found[row["table_name"]][row["rejection_reason"]] = row["n"]
    return found


def _no_keys(spark: SparkSession) -> KeySet:
    return KeySet(spark.range(0).select(F.col("id").alias("key")), 0)
