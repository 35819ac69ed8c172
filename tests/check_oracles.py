"""Run every query beside its SQL on the given folder: ``python tests/check_oracles.py [folder] [name-part ...]``."""

from __future__ import annotations

import datetime
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from vaultline.session import build_session  # noqa: E402

BASES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def canonical(value):
    if isinstance(value, float):
        return round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def connect(folder: str):
    connection = duckdb.connect()
    for base in BASES:
        connection.execute(f"CREATE VIEW {base} AS SELECT * FROM '{folder}/{base}.parquet'")
    return connection


# The type names that Spark and DuckDB use for the same type.
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def compare(spark, connection, folder: str, name: str, query, sql: str) -> str | None:
    """What differs, or None."""
    frame = query(spark, folder)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}; only here {list(set(got) - set(want))[:2]}"
    if got != want:
        return f"values: {[p for p in zip(got, want) if p[0] != p[1]][:2]}"
    types = {d[0]: str(d[1]) for d in result.description}
    off = {c: (t, types[c]) for c, t in frame.dtypes if TYPES.get(t) != types[c]}
    return f"types {off}" if off else None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    parts = sys.argv[2:]
    spark = build_session("oracles", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, sqls, bad = connect(folder), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        if name not in sqls:
            print(f"---- {name}: no SQL, {query(spark, folder).count()} rows", flush=True)
            continue
        started = time.time()
        try:
            fault = compare(spark, connection, folder, name, query, sqls[name])
        except Exception as error:  # noqa: BLE001
            fault = f"{type(error).__name__}: {str(error)[:600]}"
        bad += fault is not None
        print(f"{'ok  ' if fault is None else 'BAD '} {name} {time.time() - started:.1f}s {fault or ''}", flush=True)
    print(f"{bad} of {len(sqls)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
