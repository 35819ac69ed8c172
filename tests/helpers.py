"""Small raw and curated tables for tests."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators import curation
from vaultline.operators.keys import KeySet
from vaultline.operators.tables import TABLES

# One valid raw row of every table.
VALID = {
    "branches": "10,Harbour Office,Kochi,KL,2019-07-15,HRB00731",
    "employees": "100,Mira Voss,10,Teller,2020-11-03,41875.50",
    "customers": "1000,Tomas Iyer,Male,1984-05-19,Kochi,KL,9123401177,tomas.iyer@example.org,Carpenter,73250.00,2021-03-28,688",
    "accounts": "10000,1000,10,Savings,18420.75,2021-04-02,Active",
    "transactions": "50000,10000,2025-09-14,Deposit,312.40,Mobile App,Salary",
    "loans": "2000,1000,10,Personal Loan,26500.00,9.25,36,2023-06-12,Active",
    "loan_payments": "8000,2000,2023-07-12,844.10,639.75,204.35,0",
    "cards": "3000,1000,10000,Credit - Platinum,2022-10-05,2027-10-05,22000.00,Active",
    "card_transactions": "7000,3000,2025-12-21,Groceries,63.85,0",
    "support_tickets": "9000,1000,Billing,2025-08-09,2025-08-13,Resolved,4",
}


def valid_row(name: str, /, **changes) -> dict:
    row = dict(zip(TABLES[name].columns, VALID[name].split(",")))
    unknown = set(changes) - set(row)
    assert not unknown, unknown
    return {**row, **changes}


def raw_frame(spark, name: str, rows: list[dict]):
    table = TABLES[name]
    return spark.createDataFrame([tuple(r.get(c) for c in table.columns) for r in rows], table.raw_schema)


def key_set(spark, *ids: int) -> KeySet:
    schema = T.StructType([T.StructField("key", T.LongType())])
    return KeySet(spark.createDataFrame([(i,) for i in ids], schema), len(ids))


PARENTS = {"branches": (10,), "customers": (1000,), "accounts": (10000,), "loans": (2000,), "cards": (3000,)}


def parents_of(spark, name: str) -> dict[str, KeySet]:
    return {p.table: key_set(spark, *PARENTS[p.table]) for p in TABLES[name].validated_parents}


def judge(spark, name: str, rows: list[dict], parents=None):
    """For each row, in order: ``None`` if curated, else ``(reason, stage)``; and the curated rows."""
    table = TABLES[name]
    raw = raw_frame(spark, name, rows).coalesce(1)
    frame = curation.validated(raw, table, parents or parents_of(spark, name))
    stored = frame.withColumn("position", F.monotonically_increasing_id()).collect()
    stored = sorted(stored, key=lambda r: r["position"])
    verdicts = [(r["rejection_reason"], r["validation_stage"]) if r["is_bad"] else None for r in stored]
    good = [{c: r[c] for c in table.columns} for r in stored if not r["is_bad"]]
    return verdicts, good


def curated_frame(spark, name: str, rows: list[tuple]):
    """A curated table from tuples in column order; text is cast to the curated types."""
    table = TABLES[name]
    texts = [tuple(None if v is None else str(v) for v in row) for row in rows]
    frame = spark.createDataFrame(texts, table.raw_schema)
    return frame.select(*[F.col(f.name).cast(f.type).alias(f.name) for f in table.fields])
