"""Every operator as a query over the star-schema tables of a folder."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.functions import columns as C
from vaultline.functions.redaction import mask_personal, redact
from vaultline.operators import audit, curation, reports
from vaultline.operators.keys import KeySet, duplicate_keys, unique_key_set
from vaultline.operators.merge import latest_per_key
from vaultline.operators.tables import LAKE_TABLES, TABLES, with_parents
from vaultline.plans import analytics, marts, reads
from vaultline.plans.bank import Bank
from vaultline.plans.rollups import FACTS, MonthlyFacts, Rollups
from vaultline.sources import files, publication
from vaultline.sources.incremental import IncrementalStore
from vaultline.sources.merged import MergedTable
from vaultline.sources.scratch import keep, new_folder
from vaultline.sources.store import Store, curate_all, curate_table, require_parents
from vaultline.sources.summary import append_to_log, read_log, summaries_frame
from vaultline.starbank.raw import base_table, raw_table
from vaultline.streaming import events as E

# Parameters of the queries, chosen so that each returns rows on the given tables.
AS_OF = date(2025, 6, 30)
EXPIRY = (date(2000, 1, 1), date(2000, 12, 31))
HIGH_VALUE = 200.0
VELOCITY_EVENTS = 2
DETAIL_CUSTOMER = 7
LIST_CITY = "nation_3"
DEEP_OFFSET = 20_000


class StarBank:
    """The bank of one folder, curated once per session and then read from the store."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.store = Store(spark, new_folder(spark, "bank"))
        self.bank = Bank(self.curated, keep)
        self._keys: dict[str, KeySet] = {}
        self._done: set[str] = set()
        self._lock = threading.RLock()

    def raw(self, name: str) -> DataFrame:
        return raw_table(self.spark, self.folder, name)

    def keys(self, name: str) -> dict[str, KeySet]:
        """The key sets of the parents of a table."""
        with self._lock:
            for parent in TABLES[name].validated_parents:
                if parent.table not in self._keys:
                    self.ensure(parent.table)
                    self._keys[parent.table] = self.store.parent_keys(parent.table)
            return {p.table: self._keys[p.table] for p in TABLES[name].validated_parents}

    def ensure(self, name: str) -> None:
        with self._lock:
            for table in with_parents([name]):
                if table not in self._done:
                    curate_table(self.store, TABLES[table], self.raw(table), self.keys(table))
                    self._done.add(table)

    def curated(self, name: str) -> DataFrame:
        self.ensure(name)
        return self.store.curated(name)

    def rows(self, name: str) -> DataFrame:
        self.ensure(name)
        return self.store.rows(name)

    def all_rows(self) -> dict[str, DataFrame]:
        return {name: self.rows(name) for name in TABLES}


_banks: dict[tuple[str, str], StarBank] = {}
_banks_lock = threading.Lock()


def star_bank(spark: SparkSession, folder: str) -> StarBank:
    with _banks_lock:
        key = (spark.sparkContext.applicationId, folder.rstrip("/"))
        if key not in _banks:
            _banks[key] = StarBank(spark, folder.rstrip("/"))
        return _banks[key]


def _doubles(frame: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for comparison with another engine."""
    return frame.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


def _on_bank(query: Callable[..., DataFrame], **arguments) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _doubles(query(star_bank(spark, folder).bank, **arguments))


def _validate(name: str):
    """The quarantine of one table, from a fresh validation of its whole raw table."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        bank, table = star_bank(spark, folder), TABLES[name]
        _, bad = curation.validate(bank.raw(name), table, bank.keys(name))
        return bad.drop("processed_at")

    return run


def _standardise(name: str):
    """The curated rows of one table, from a fresh validation of its whole raw table."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        bank, table = star_bank(spark, folder), TABLES[name]
        good, _ = curation.validate(bank.raw(name), table, bank.keys(name))
        return _doubles(good)

    return run


def _next_page(read: Callable[..., DataFrame], order: tuple[str, ...], first: int, **arguments):
    """The page behind the first ``first`` rows, found by the key of the last of them."""

    def run(bank) -> DataFrame:
        *_, last = read(bank, **{**arguments, "limit": first}).select(*order).collect()
        return read(bank, **arguments, after=tuple(last))

    return _on_bank(run)


SUMMARY_COLUMNS = (
    "pipeline_name", "status", "total_records", "curated_records", "bad_records", "success_rate_pct", "failure_rate_pct",
)


def _curate(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        bank = star_bank(spark, folder)
        store = Store(spark, new_folder(spark, "curate"))
        summary = curate_table(store, TABLES[name], bank.raw(name), bank.keys(name))
        return summaries_frame(spark, [summary]).select(*SUMMARY_COLUMNS)

    return run


def curate_everything(spark: SparkSession, folder: str) -> DataFrame:
    """All ten tables from raw to stored, parents first, whatever was curated before."""
    store = Store(spark, new_folder(spark, "curate"))
    summaries = curate_all(store, lambda name: raw_table(spark, folder, name))
    return summaries_frame(spark, summaries.values()).select(*SUMMARY_COLUMNS)


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log of a run over all tables, appended once and read back: one row per table and frequent reason."""
    path = new_folder(spark, "log")
    store = Store(spark, new_folder(spark, "curate"))
    curate_all(store, lambda name: raw_table(spark, folder, name), log=lambda s: append_to_log(spark, path, s))
    tables = read_log(spark, path).select(*SUMMARY_COLUMNS, F.explode("rejection_reasons").alias("table_name", "reasons"))
    return tables.select(*SUMMARY_COLUMNS, "table_name", F.explode("reasons").alias("rejection_reason", "n"))


def _csv_copy(spark: SparkSession, folder: str, names) -> str:
    """The raw tables as CSV folders, as a bank would deliver them."""
    root = new_folder(spark, "lake-root")
    for name in names:
        writer = raw_table(spark, folder, name).write.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.csv(f"{root}/bronze/raw/{name}.csv")
    return root


def _read_raw(name: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        root = _csv_copy(spark, folder, [name])
        read = files.read_raw(spark, f"{root}/bronze/raw/{name}.csv")
        return read.select(*[C.strip(F.col(c)).alias(c) for c in read.columns])

    return run


def _faulty_lines(raw: DataFrame) -> DataFrame:
    """Customers as lines of text; the phone number decides which lines are faulty, and how."""
    cell = {c: F.coalesce(F.col(c), F.lit("")) for c in raw.columns}
    fault = F.col("phone").cast("long") % 37
    quoted = F.concat(F.lit('"a, ""b"" '), cell["name"], F.lit('"'))
    name = F.when(fault == 3, F.concat(F.lit('"'), cell["name"])).when(fault == 5, quoted).otherwise(cell["name"])
    name = F.when(fault == 4, F.concat(F.unhex(F.lit("FF")).cast("string"), name)).otherwise(name)
    whole = F.concat_ws(",", *[name if c == "name" else cell[c] for c in raw.columns])
    short = F.concat_ws(",", *[cell[c] for c in raw.columns[:8]])
    return raw.select(F.when(fault == 1, F.concat(whole, F.lit(",extra,more"))).when(fault == 2, short).otherwise(whole).alias("line"))


def _deliver_lines(lines: DataFrame, header: str, path: str) -> None:
    """Write lines byte for byte, a header before those of each file."""
    text = F.decode(F.col("line").cast("binary"), "ISO-8859-1").alias(header)
    options = {"header": True, "sep": "\x01", "quote": "", "encoding": "ISO-8859-1",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    lines.select(text).write.options(**options).csv(path)


def damaged_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Customers delivered as text with faulty lines and ingested: every line, as cells or as damaged text."""
    raw, root = raw_table(spark, folder, "customers"), new_folder(spark, "delivered")
    _deliver_lines(_faulty_lines(raw), ",".join(raw.columns), f"{root}/customers.csv")
    delivery = files.ingest(spark, f"{root}/customers.csv", f"{root}/ingested")
    none = lambda name: F.lit(None).cast("string").alias(name)
    sound = delivery.rows.select(
        none("damage"), F.lit(None).cast("int").alias("fields"), none("line"), *[C.strip(F.col(c)).alias(c) for c in raw.columns]
    )
    return sound.unionByName(delivery.damaged.select("damage", "fields", "line", *[none(c) for c in raw.columns]))


def _curate_delivered(spark: SparkSession, folder: str) -> DataFrame:
    """Customers from such lines, curated: lines by what became of them."""
    raw, root = raw_table(spark, folder, "customers"), new_folder(spark, "delivered")
    _deliver_lines(_faulty_lines(raw), ",".join(raw.columns), f"{root}/customers.csv")
    store, deliveries = Store(spark, f"{root}/store"), {}
    curate_all(store, files.ingesting_reader(spark, root, f"{root}/ingested", deliveries), ("customers",))
    state = store.snapshot("customers")
    counts = {"curated": state.good, "quarantine": state.bad, **deliveries["customers"].damage}
    return spark.createDataFrame([(k, n) for k, n in counts.items()], "outcome string, n long")


def lake_curation(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files through the lake job; rows per table and zone."""
    root = _csv_copy(spark, folder, LAKE_TABLES)
    files.curate_lake(spark, root)
    zones = {}
    for name in LAKE_TABLES:
        good, bad = files.read_lake(spark, root, name)
        zones[f"silver/{name}"], zones[f"quarantine/{name}"] = good, bad
    return audit.table_counts(zones)


def lake_without_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The lake job where the files of accounts are missing: they are skipped, and no transaction finds its account."""
    delivered = [name for name in LAKE_TABLES if name != "accounts"]
    root = _csv_copy(spark, folder, delivered)
    files.curate_lake(spark, root)
    zones = {}
    for name in delivered:
        zones[f"silver/{name}"], zones[f"quarantine/{name}"] = files.read_lake(spark, root, name)
    return audit.table_counts(zones)


def nothing_curated(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions of a bank without accounts: the curated output has its columns and no rows."""
    store = Store(spark, new_folder(spark, "curate"))
    no_accounts = unique_key_set(star_bank(spark, folder).curated("accounts").limit(0), "account_id")
    curate_table(store, TABLES["transactions"], raw_table(spark, folder, "transactions"), {"accounts": no_accounts})
    bad = store.quarantine("transactions").select(F.lit("quarantine").alias("zone"), *TABLES["transactions"].schema.names)
    good = store.curated("transactions").select(F.lit("curated").alias("zone"), *TABLES["transactions"].schema.names)
    shown = [F.col(c).cast("string") for c in good.columns]
    rows = good.select(*shown).unionByName(bad.select(*shown))
    return rows.groupBy("zone").agg(F.count("*").alias("n"), F.count("transaction_id").alias("with_id"))


def three_batches(spark: SparkSession, folder: str) -> DataFrame:
    """All raw tables dealt once into three batches, which are applied one after the other: rows by table and verdict."""
    store = IncrementalStore(spark, new_folder(spark, "incremental"), buckets=8)
    raw = {name: raw_table(spark, folder, name) for name in TABLES}
    dealt = {
        name: keep(frame.withColumn("batch", F.crc32(F.concat_ws("|", *frame.columns)) % 3), "dealt", "batch")
        for name, frame in raw.items()
    }
    for batch in range(3):
        store.apply(batch + 1, {name: rows.where(F.col("batch") == batch).drop("batch") for name, rows in dealt.items()})
    found = []
    for name in TABLES:
        none = F.lit(None).cast("string")
        good = store.curated(name).agg(F.count("*").alias("n")).select(
            F.lit(name).alias("table_name"), none.alias("rejection_reason"), none.alias("validation_stage"), "n"
        )
        bad = store.quarantine(name).groupBy("rejection_reason", "validation_stage").agg(F.count("*").alias("n"))
        found += [good, bad.select(F.lit(name).alias("table_name"), "rejection_reason", "validation_stage", "n")]
    return reports._union(found)


def built_marts(spark: SparkSession, folder: str) -> DataFrame:
    """Every mart written to its folder, twice, and read back; rows per mart."""
    bank, root = star_bank(spark, folder).bank, new_folder(spark, "marts")
    for name in marts.PUBLIC_MARTS:
        marts.build_mart(bank, name, f"{root}/{name}")
    marts.build_mart(bank, "customer_360", f"{root}/customer_360")
    return audit.table_counts({name: spark.read.parquet(f"{root}/{name}") for name in marts.PUBLIC_MARTS})


def refused_without_parents(spark: SparkSession, folder: str) -> DataFrame:
    """For each table and parent: what curation says where the parent is absent, and how many of its keys are there otherwise."""
    bank, found = star_bank(spark, folder), []
    for name, table in TABLES.items():
        parents = bank.keys(name)
        require_parents(table, parents)
        for parent, keys in parents.items():
            present = {other: known for other, known in parents.items() if other != parent}
            store = Store(spark, new_folder(spark, "curate"))
            try:
                curate_table(store, table, bank.raw(name), present)
                said = None
            except FileNotFoundError as error:
                said = str(error)
            found.append((name, parent, said, keys.rows, bool(store.snapshots(name))))
    return spark.createDataFrame(found, "table_name string, parent string, refusal string, parent_keys long, written boolean")


def curated_and_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Both outputs of cards, the table with most rules, written as plain folders and read back."""
    bank = star_bank(spark, folder)
    bank.ensure("cards")
    good, bad = new_folder(spark, "good"), new_folder(spark, "bad")
    files.write_curated_and_quarantine(bank.store, "cards", good, bad)
    table = TABLES["cards"]
    curated = spark.read.schema(table.schema).parquet(good)
    quarantined = spark.read.schema(curation.quarantine_schema(table)).parquet(bad)
    return audit.table_counts({"curated": curated, "quarantine": quarantined})


def staged_publish(spark: SparkSession, folder: str) -> DataFrame:
    bank = star_bank(spark, folder).bank
    root = new_folder(spark, "warehouse")
    version = publication.publish(spark, root, bank.tables())
    return audit.table_counts({name: publication.published(spark, root, name, version) for name in TABLES})


def _raw_standardised(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All raw rows in curated types, nothing rejected: what a load without validation would hold."""
    return {
        name: curation.standardise(curation.parsed(raw_table(spark, folder, name), table), table)
        for name, table in TABLES.items()
    }


def fk_audit_raw(spark: SparkSession, folder: str) -> DataFrame:
    return audit.fk_audit(_raw_standardised(spark, folder), star_bank(spark, folder).bank.tables())


def all_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The repeated keys of every raw table."""
    found = []
    for name, table in TABLES.items():
        frame = curation.parsed(raw_table(spark, folder, name), table)
        keys = duplicate_keys(frame, f"key_{table.key}", f"text_{table.key}")
        found.append(keys.select(F.lit(name).alias("table_name"), "key", "key_text", "copies"))
    return reports._union(found)


def _report(report):
    return lambda spark, folder: _doubles(report(star_bank(spark, folder).all_rows()))


def quarantine_counts(rows: dict[str, DataFrame]) -> DataFrame:
    return reports.all_quarantine(rows).groupBy("table_name", "validation_stage").agg(F.count("*").alias("n"))


def _with_secrets(text: Column, secret: Column) -> Column:
    """A text carrying credentials in the forms that a log would."""
    return F.concat(
        text, F.lit("\npassword: pw"), secret, F.lit(", Token="), secret, F.lit("; API-key:  k-"), secret,
        F.lit(" secret=s3cr3t&aws_secret_access_key=AK"), secret, F.lit(" postgresql://svc:p"), secret,
        F.lit("@db/bank POSTGRES://u:q"), secret, F.lit("@h"),
    )


def redacted_documents(spark: SparkSession, folder: str) -> DataFrame:
    text = _with_secrets(F.col("text"), F.col("doc_id").cast("string"))
    return base_table(spark, folder, "documents").select("doc_id", redact(text).alias("redacted"))


def redacted_conversations(spark: SparkSession, folder: str) -> DataFrame:
    text = _with_secrets(F.col("text"), F.col("conv_id").cast("string"))
    return base_table(spark, folder, "conversations").select("conv_id", "turn", redact(text).alias("redacted"))


def masked_customers(bank) -> DataFrame:
    return mask_personal(bank["customers"])


def _balances(bank) -> tuple[DataFrame, DataFrame]:
    """Accounts, and their transactions as changes of them."""
    current = bank["accounts"].select(
        "account_id", F.col("open_date").alias("changed_on"), F.lit(0).cast("bigint").alias("change_id"),
        F.col("balance").cast("decimal(15,2)").alias("amount"),
    )
    changes = bank["transactions"].select(
        "account_id", F.col("txn_date").alias("changed_on"), F.col("transaction_id").alias("change_id"), "amount"
    )
    return current, changes


def latest_balances(bank) -> DataFrame:
    """Accounts merged with their transactions: the latest movement of each account."""
    return latest_per_key(*_balances(bank), "account_id", ["changed_on", "change_id"])


def merged_balances(spark: SparkSession, folder: str) -> DataFrame:
    """The same merge range by range: accounts, then their transactions in two merges, one of few accounts."""
    bank = star_bank(spark, folder).bank
    current, changes = _balances(bank)
    table = MergedTable(spark, new_folder(spark, "merged"), current.schema, "account_id", ["changed_on", "change_id"], span=2000)
    few = F.col("account_id") < 2000
    for rows in (current, changes.where(~few), changes.where(few)):
        table.merge(rows)
    return _doubles(table.rows())


def _additive(mart: Callable[[Bank], DataFrame]):
    """A mart from rollups by month that were refreshed after half of the rows of some months came late."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        bank = star_bank(spark, folder)
        facts = MonthlyFacts(spark, new_folder(spark, "facts"))
        rollups = Rollups(spark, new_folder(spark, "rollups"), facts)
        late = F.col("txn_date") >= F.lit(date(2000, 1, 1))
        for name in FACTS:
            rows = bank.curated(name)
            facts.replace_months(name, rows.where(~late | (F.col(TABLES[name].key) % 2 == 0)))
        rollups.refresh()
        for name in FACTS:
            facts.replace_months(name, bank.curated(name).where(late))
        rollups.refresh()
        return _doubles(mart(rollups.bank(bank.curated)))

    return run


def closed_bursts(spark: SparkSession, folder: str) -> DataFrame:
    """Bursts of each account in the event stream, those that the watermark has closed."""
    found, path = E.bursts(_event_stream(spark, folder), VELOCITY_EVENTS), new_folder(spark, "bursts")
    E.append_sink(found, path, new_folder(spark, "stream")).awaitTermination()
    return _doubles(spark.read.schema(found.schema).parquet(path))


def partitioned_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions by month, then the months from 2000 on published again; rows per month."""
    transactions = star_bank(spark, folder).bank["transactions"]
    path = new_folder(spark, "by-month")
    publication.publish_by_month(transactions, "txn_date", path)
    publication.publish_by_month(transactions.where(F.col("txn_date") >= F.lit(date(2000, 1, 1))), "txn_date", path)
    return spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n")).select(
        F.col("month").cast("string").alias("month"), "n"
    )


def _as_events(frame: DataFrame) -> DataFrame:
    return frame.select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("channel"),
        F.lit("event").alias("type"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = base_table(spark, folder, "events").schema
    # A glob, because the table may be one file or a folder of files.
    return _as_events(E.read_stream(spark, f"{folder.rstrip('/')}/[e]vents.parquet", schema))


FLAG_COLUMNS = ("transaction_id", "account_id", "amount", "channel", "is_flagged", "risk_reason")


def flagged_events(spark: SparkSession, folder: str) -> DataFrame:
    return E.flag_events(_as_events(base_table(spark, folder, "events")), HIGH_VALUE).select(*FLAG_COLUMNS)


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream, flagged and routed to its sink, then read back."""
    path, flagged = new_folder(spark, "routed"), E.flag_events(_event_stream(spark, folder), HIGH_VALUE)
    E.route_events(flagged, path, new_folder(spark, "stream")).awaitTermination()
    return E.read_routes(spark, path, flagged.schema)


def routed_events(spark: SparkSession, folder: str) -> DataFrame:
    return _routed(spark, folder).where("is_flagged").select(*FLAG_COLUMNS)


def routed_summary(spark: SparkSession, folder: str) -> DataFrame:
    return E.stream_summary(_routed(spark, folder))


def _windows(operator: Callable[[DataFrame], DataFrame], keys: list[str]):
    """Run a windowed operator as a stream to its end and read the current value of each window."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        frame = operator(_event_stream(spark, folder))
        path, by = new_folder(spark, "windows"), ["window_start", "window_end", *keys]
        E.update_sink(frame, path, new_folder(spark, "stream"), by).awaitTermination()
        return _doubles(E.read_updates(spark, path, frame.schema, by))

    return run


def late_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events delivered, then delivered again too late: windows that the watermark closed hold each once."""
    delivered, path, state = (new_folder(spark, name) for name in ("delivered", "closed", "stream"))
    events = _as_events(base_table(spark, folder, "events"))
    for _ in range(2):
        events.write.mode("append").parquet(delivered)
        windows = E.tumbling(E.read_stream(spark, delivered, events.schema))
        E.append_sink(windows, path, state).awaitTermination()
    return _doubles(spark.read.schema(windows.schema).parquet(path))


def replayed_events(spark: SparkSession, folder: str) -> DataFrame:
    """The event stream delivered twice, with replays dropped."""
    stream = E.drop_replays(_event_stream(spark, folder).union(_event_stream(spark, folder)))
    path = new_folder(spark, "replays")
    E.append_sink(stream, path, new_folder(spark, "stream")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path).select("transaction_id", "account_id", "amount", "channel")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for number, name in enumerate(TABLES, 1):
        found[f"c{number}_validate_{name}"] = _validate(name)
        found[f"i{number}_transform_{name}"] = _standardise(name)
        found[f"l{number}_curate_{name}"] = _curate(name)
    found["l11_curate_all"] = curate_everything

    found["a1_read_raw"] = _read_raw("customers")
    found["a1_damaged_lines"] = damaged_lines
    found["a1_curate_damaged"] = _curate_delivered
    for name in ("transactions", "loan_payments", "card_transactions"):
        found["a2_read_large" if name == "transactions" else f"a2_read_large_{name}"] = _read_raw(name)
    found["a3_read_parent_keys"] = _on_bank(lambda bank: bank["accounts"].select("account_id"))
    found["a4_require_parents"] = refused_without_parents
    found["a5_write_curated_and_quarantine"] = curated_and_quarantine
    found["a6_empty_output"] = nothing_curated
    found["a6_three_batches"] = three_batches
    found["a7_skip_missing"] = lake_without_accounts
    found["a9_lake_curation"] = lake_curation
    found["a10_staged_publish"] = staged_publish
    found["a11_fk_audit"] = lambda spark, folder: audit.fk_audit(star_bank(spark, folder).bank.tables())
    found["a11_fk_audit_raw"] = fk_audit_raw
    found["a12_constraint_audit"] = lambda spark, folder: audit.constraint_audit(star_bank(spark, folder).bank.tables())
    found["a12_constraint_audit_raw"] = lambda spark, folder: audit.constraint_audit(_raw_standardised(spark, folder))
    found["a13_pk_audit"] = lambda spark, folder: audit.pk_audit(star_bank(spark, folder).bank.tables())
    found["a13_pk_audit_raw"] = lambda spark, folder: audit.pk_audit(_raw_standardised(spark, folder))
    found["a14_table_counts"] = lambda spark, folder: audit.table_counts(star_bank(spark, folder).bank.tables())
    found["a15_build_mart"] = built_marts
    found["a15_additive_customer_months"] = _additive(marts.monthly_customer_summary)
    found["a15_additive_branch_months"] = _additive(marts.monthly_branch_summary)
    found["a15_additive_customer_360"] = _additive(marts.customer_360)
    found["a17_run_log"] = run_log

    found["e9_duplicate_keys"] = all_duplicates
    found["e11_run_totals"] = _report(reports.run_totals)
    found["h1_all_quarantine"] = _report(quarantine_counts)

    found["m1_monthly_customer_summary"] = _on_bank(marts.monthly_customer_summary)
    found["m1b_monthly_customer_summary_full"] = _on_bank(marts.monthly_customer_summary_full)
    found["m2_monthly_branch_summary"] = _on_bank(marts.monthly_branch_summary)
    found["m3_customer_360"] = _on_bank(marts.customer_360)

    parameters = {
        "q22_cards_expiring": {"first": EXPIRY[0], "last": EXPIRY[1]},
        "q24_age_cohort_channel": {"as_of": AS_OF},
    }
    for name, query in analytics.QUERIES.items():
        found[name] = _on_bank(query, **parameters.get(name, {}))

    found["o1_list_customers"] = _on_bank(reads.list_customers, city=LIST_CITY, limit=20, offset=5)
    found["o2_customer_detail"] = _on_bank(reads.customer_detail_rows, customer_id=DETAIL_CUSTOMER)
    found["o3_list_accounts"] = _on_bank(reads.list_accounts, account_type="fixed deposit", limit=100, offset=10)
    found["o4_list_transactions"] = _on_bank(reads.list_transactions, limit=200, offset=50)
    found["o5_list_loans"] = _on_bank(reads.list_loans, status="ACTIVE")
    found["o6_list_cards"] = _on_bank(reads.list_cards, card_type="credit - gold", limit=150)
    found["o7_list_customer_360"] = _on_bank(reads.list_customer_360, segment="low RISK", limit=60)
    found["o1_list_customers_by_key"] = _next_page(reads.list_customers, ("customer_id",), 5, city=LIST_CITY, limit=20)
    found["o4_list_transactions_by_key"] = _next_page(reads.list_transactions, ("txn_date", "transaction_id"), 50, limit=200)
    found["o7_list_customer_360_by_key"] = _next_page(
        reads.list_customer_360, ("total_deposit_balance", "customer_id"), 10, segment="low RISK", limit=50
    )
    found["o4_list_transactions_deep"] = _on_bank(reads.list_transactions, limit=200, offset=DEEP_OFFSET)
    found["o8_dashboard_kpis"] = _on_bank(reads.dashboard_kpis)
    found["o9_segment_counts"] = _on_bank(reads.segment_counts)

    found["p1_quality_report"] = _report(reports.quality_report)
    found["p2_top_reasons"] = _report(reports.top_reasons)
    found["p3_reason_breakdown"] = _report(reports.reason_breakdown)
    found["p4_cascade_report"] = _report(reports.cascade_report)
    found["p5_redact"] = redacted_documents
    found["p5_redact_conversations"] = redacted_conversations

    found["j1_flag_events"] = flagged_events
    found["j2_route_events"] = routed_events
    found["j3_stream_summary"] = routed_summary
    found["s1_tumbling_5m"] = _windows(E.tumbling, ["channel"])
    found["s2_sliding_5m"] = _windows(E.sliding, ["channel"])
    found["s3_velocity_alert"] = _windows(lambda e: E.velocity_alerts(e, VELOCITY_EVENTS), ["account_id"])
    found["s4_late_data"] = late_events
    found["s5_event_dedup"] = replayed_events
    found["s3_velocity_bursts"] = closed_bursts
    found["s6_incremental_merge"] = _on_bank(latest_balances)
    found["s6_copy_on_write_merge"] = merged_balances
    found["s7_partitioned_publish"] = partitioned_publish
    found["s9_mask_pii"] = _on_bank(masked_customers)
    return found
