"""Publication of all tables as one version.

Every table is written to the folder of a new version and audited there. Only then one record of the
commit log makes the version current. A failure at any earlier step leaves the old version
current and untouched, and readers that opened the old version keep it. Of publishers that began
from the same version the first to take the next number wins; the others are refused and what they wrote is removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators.audit import findings
from vaultline.operators.tables import TABLES
from vaultline.sources import commits
from vaultline.sources.commits import CommitLog

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("base", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("tables", T.MapType(T.StringType(), T.LongType())),
    ]
)


class PublicationRefused(ValueError):
    """The new version breaks a key, a foreign key or a column constraint."""


def publish(
    spark: SparkSession, root: str, tables: Mapping[str, DataFrame], expected: tuple[str, ...] = tuple(TABLES)
) -> str:
    """Write and audit all tables, then make them current together. Returns the version.

    All findings of the audit are reported. The version's number is that of the one it began from and one more;
    if another publisher took that number meanwhile, this one is refused. A version
    that is refused, or fails, is removed.
    """
    absent = [name for name in expected if name not in tables]
    if absent:
        raise FileNotFoundError(f"not published, tables missing: {', '.join(absent)}")
    root = root.rstrip("/")
    log = _log(spark, root)
    base, version = log.last(), uuid.uuid4().hex
    try:
        counts = _staged(spark, root, version, tables, expected)
        if log.commit(base, {"version": version, "tables": counts}) is None:
            raise PublicationRefused(f"not published, another version followed number {base}")
    except BaseException:
        commits.remove(spark, f"{root}/versions/{version}")
        raise
    return version


def _staged(
    spark: SparkSession, root: str, version: str, tables: Mapping[str, DataFrame], expected: tuple[str, ...]
) -> dict[str, int]:
    """Write the tables of a version and audit them as they were written; rows per table."""
    for name in expected:
        tables[name].write.mode("errorifexists").parquet(_folder(root, version, name))
    staged = {
        name: spark.read.schema(tables[name].schema).parquet(_folder(root, version, name)) for name in expected
    }
    counts = {name: frame.count() for name, frame in staged.items()}
    for name in expected:
        if counts[name] == 0 and not tables[name].isEmpty():
            raise PublicationRefused(f"staged {name} has no rows though its source has some")
    wrong = findings({n: f for n, f in staged.items() if n in TABLES}).orderBy(F.desc("rows"), "subject")
    problems = [f"{r['audit']} {r['subject']}: {r['rows']} rows" for r in wrong.collect()]
    if problems:
        raise PublicationRefused("not published, " + "; ".join(problems))
    return counts


def _log(spark: SparkSession, root: str) -> CommitLog:
    return CommitLog(spark, f"{root.rstrip('/')}/log")


def _folder(root: str, version: str, name: str) -> str:
    return f"{root}/versions/{version}/{name}"


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Every version that is kept: its number, the one it began from, and its row counts."""
    log = _log(spark, root)
    if not log.last():
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).json(log.folder)


def current_version(spark: SparkSession, root: str) -> str | None:
    log = _log(spark, root)
    number = log.last()
    return log.read(number)["version"] if number else None


def published(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """A table of the current (or a given) version."""
    version = version or current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"nothing published below {root}")
    return spark.read.parquet(_folder(root.rstrip("/"), version, name))


def retire(spark: SparkSession, root: str, kept: int = 3) -> list[str]:
    """Remove all but the last ``kept`` versions, their records first; which ones."""
    root, log, gone = root.rstrip("/"), _log(spark, root), []
    for number in log.numbers()[: -max(1, kept)]:
        version = log.read(number)["version"]
        log.forget(number)
        commits.remove(spark, f"{root}/versions/{version}")
        gone.append(version)
    return gone


def sweep(spark: SparkSession, root: str, older_than: float = 24 * 3600) -> list[str]:
    """Remove versions without a record, left by publishers that were killed; younger ones may be in the making."""
    log = _log(spark, root)
    named = {log.read(number)["version"] for number in log.numbers()}
    return commits.sweep(spark, f"{root.rstrip('/')}/versions", named, older_than)


def publish_by_month(frame: DataFrame, date: str, path: str) -> None:
    """Replace the months that occur in ``frame``, and no other, in a table partitioned by month.

    The rebalance hint sends each month to as many writers as its size needs: a month with a
    third of all rows is split, small months share a writer, and few files result.
    """
    (
        frame.withColumn("month", F.date_format(date, "yyyy-MM"))
        .hint("rebalance", "month")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("month")
        .parquet(path)
    )
