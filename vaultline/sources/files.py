"""Raw tables from CSV files, and the lake layout.

``read_raw`` wants well-formed files and raises otherwise. ``ingest`` takes files as they come: it
writes every line once, into delivered rows and damaged lines, and gives both back as tables.
"""

from __future__ import annotations

import csv
import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators import curation
from vaultline.operators.tables import LAKE_TABLES, TABLES
from vaultline.sources.scratch import new_folder, write_partitioned
from vaultline.sources.store import Store, curate_all
from vaultline.sources.summary import RunSummary

logger = logging.getLogger(__name__)

# Cell texts that mean "no value" in a raw file.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_raw(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV file or folder with a header, every column as text.

    Types are not inferred: a result must not depend on how a file is split. Files of a folder
    share one header; reading raises where a file's header differs in names or order, or where a row
    has more or fewer fields than its header, so nothing is put in a wrong column or dropped.
    ``multi_line`` reads line breaks inside quotes; such files are not split.
    """
    options = {"header": True, "escape": '"', "enforceSchema": False, "mode": "FAILFAST", "multiLine": multi_line}
    try:
        frame = spark.read.options(**options).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input file not found at: {path}") from error
        raise
    return frame.select(*[_value(F.col(f"`{c}`")).alias(c) for c in frame.columns])


def _value(cell: Column) -> Column:
    return F.when(~cell.isin(*MISSING_TEXTS), cell)


# Names of what is stored beside the cells of a delivered line.
DAMAGE, LINE, FILE, FIELDS = "damage", "line", "file", "fields"
IS_DAMAGED = "is_damaged"
ENCODING, QUOTING, SURPLUS = "Not UTF-8", "Unbalanced quotes", "Too many fields"
# What no line holds: the reader that only cuts files into lines is told to look for it.
_NO_SEPARATOR = "\x01\x02\x01"


def _whole_lines(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Every line behind the header of its file as one text column, and the header's names.

    Lines are read byte for byte, so that what is no UTF-8 arrives as it is. Reading raises where a
    file's header differs from its folder's. Empty lines are no rows.
    """
    options = {"header": True, "sep": _NO_SEPARATOR, "quote": "", "encoding": "ISO-8859-1", "enforceSchema": False}
    try:
        frame = spark.read.options(**options).csv(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input file not found at: {path}") from error
        raise
    if not frame.columns:
        raise ValueError(f"{path} has no header")
    header = frame.columns[0].encode("latin-1").decode("utf-8-sig")
    # the names are set once more: a name with dots or quotes in it is no column reference
    lines = frame.select("*", F.col("_metadata.file_path").alias(FILE)).toDF(LINE, FILE)
    return lines, next(csv.reader([header]))


def _without_quotes(text: Column) -> Column:
    """A line whose quoted fields are replaced by one letter, so that all its commas part fields.

    A quote is left at the beginning of a field only where the field doesn't end with one.
    """
    bare = F.regexp_replace(text, r'(?<=^|,)"(?:[^"]|"")*+"(?=,|$)', "q")
    return F.when(F.contains(text, F.lit('"')), bare).otherwise(text)


def delivered(spark: SparkSession, path: str) -> DataFrame:
    """Every line of a CSV file or folder as a row: its cells as text, ``fields``, ``damage``, ``line`` and ``file``.

    A line with fewer fields than the header has no value in the rest. A line that is no UTF-8, has a field
    that begins with a quote and doesn't end with one, or has more fields than the header says so in ``damage``; it has no
    cells, and ``line`` keeps its text, bytes that are no UTF-8 as U+FFFD. Other lines keep none. A line
    break within quotes ends the line, so that it is damaged twice: use ``read_raw(multi_line=True)`` for such files.
    """
    lines, names = _whole_lines(spark, path)
    if {*names} & {DAMAGE, LINE, FILE, FIELDS, IS_DAMAGED}:
        raise ValueError(f"{path} has columns named like those that describe its lines")
    data = F.encode(F.col(LINE), "ISO-8859-1").cast("string")
    rows = lines.select(F.try_validate_utf8(data).alias("_text"), F.make_valid_utf8(data).alias(LINE), FILE)
    rows = rows.withColumn("_bare", _without_quotes(F.col("_text")))
    fields = F.length("_bare") - F.length(F.replace(F.col("_bare"), F.lit(","), F.lit(""))) + 1
    damage = (
        F.when(F.col("_text").isNull(), ENCODING)
        .when(F.regexp_like("_bare", F.lit('(?:^|,)"')), QUOTING)
        .when(fields > len(names), SURPLUS)
    )
    rows = rows.select("_text", LINE, FILE, fields.cast("int").alias(FIELDS), damage.alias(DAMAGE))
    cells = ", ".join(f"c{i} string" for i in range(len(names)))
    sound = F.when(F.col(DAMAGE).isNull(), F.col("_text"))
    rows = rows.withColumn("_cells", F.from_csv(sound, cells, {"escape": '"', "mode": "PERMISSIVE"}))
    return rows.select(
        *[_value(F.col(f"_cells.c{i}")).alias(name) for i, name in enumerate(names)],
        FIELDS,
        DAMAGE,
        F.when(F.col(DAMAGE).isNotNull(), F.col(LINE)).alias(LINE),
        FILE,
    )


@dataclass(frozen=True)
class Delivery:
    """The lines of one raw table as they were stored: rows to be curated, and damaged lines."""

    rows: DataFrame
    damaged: DataFrame
    delivered: int
    short: int
    damage: dict[str, int]

    @property
    def lines(self) -> int:
        return self.delivered + sum(self.damage.values())


def ingest(spark: SparkSession, path: str, target: str) -> Delivery:
    """Write all lines of a CSV file or folder to ``target``, once, parted into sound and damaged ones.

    Nothing raises because of a line, and no line is lost: ``rows`` and ``damaged`` (``file``, ``damage``, ``fields``, ``line``)
    together are all lines but headers and empty ones. The text is parsed this once; whatever reads the rows later,
    a pass over one key column too, reads columns.
    """
    frame = delivered(spark, path)
    write_partitioned(frame.withColumn(IS_DAMAGED, F.col(DAMAGE).isNotNull()), target, IS_DAMAGED)
    stored = spark.read.schema(T.StructType([*frame.schema.fields, T.StructField(IS_DAMAGED, T.BooleanType())])).parquet(target)
    names = [name for name in frame.columns if name not in (DAMAGE, LINE, FILE, FIELDS)]
    rows, damaged = stored.where(~F.col(IS_DAMAGED)), stored.where(IS_DAMAGED)
    many, short = rows.agg(F.count("*"), F.count_if(F.col(FIELDS) < len(names))).first()
    damage = {r[DAMAGE]: r["count"] for r in damaged.groupBy(DAMAGE).count().collect()}
    return Delivery(rows.select(*[f"`{name}`" for name in names]), damaged.select(FILE, DAMAGE, FIELDS, LINE), many, short, damage)


def ingesting_reader(
    spark: SparkSession, folder: str, target: str, deliveries: dict[str, Delivery], skip_missing: bool = False
) -> Callable[[str], DataFrame | None]:
    """A function from table name to the rows of ``folder/<table>.csv``, ingested below ``target``.

    ``deliveries`` gets what was delivered of each table, damaged lines too. For ``curate_all``.
    """

    def read(name: str) -> DataFrame | None:
        try:
            deliveries[name] = ingest(spark, f"{folder.rstrip('/')}/{name}.csv", f"{target.rstrip('/')}/{name}")
        except FileNotFoundError:
            if not skip_missing:
                raise
            logger.warning("%s/%s.csv not found, skipped", folder, name)
            return None
        return deliveries[name].rows

    return read


def read_raw_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return read_raw(spark, path)
    except FileNotFoundError:
        logger.warning("%s not found, skipped", path)
        return None


def raw_folder_reader(spark: SparkSession, folder: str, skip_missing: bool = False):
    """A function from table name to the raw rows of ``folder/<table>.csv``."""
    read = read_raw_if_present if skip_missing else read_raw
    return lambda name: read(spark, f"{folder.rstrip('/')}/{name}.csv")


def write_curated_and_quarantine(store: Store, name: str, curated_path: str, quarantine_path: str) -> None:
    """Copy a stored table to two plain outputs, each overwritten.

    Both are plain scans of one partition of the store; nothing is validated again.
    """
    store.curated(name).write.mode("overwrite").parquet(curated_path)
    store.quarantine(name).write.mode("overwrite").parquet(quarantine_path)


def curate_lake(
    spark: SparkSession, root: str, raw_prefix: str = "bronze/raw", tables: Iterable[str] = LAKE_TABLES
) -> dict[str, RunSummary]:
    """Raw files below ``root/raw_prefix`` to ``root/silver/curated`` and ``root/quarantine``.

    A missing raw file skips its table. A quarantine is written only when rows were rejected; an
    older one is then replaced by the empty result, not left standing.
    """
    root = root.rstrip("/")
    store = Store(spark, new_folder(spark, "lake"))
    read = raw_folder_reader(spark, f"{root}/{raw_prefix}", skip_missing=True)
    summaries = curate_all(store, read, tuple(tables), skip_missing=True)
    for name, summary in summaries.items():
        store.curated(name).write.mode("overwrite").parquet(f"{root}/silver/curated/{name}")
        quarantine = f"{root}/quarantine/{name}"
        if summary.bad_records or _exists(spark, quarantine):
            store.quarantine(name).write.mode("overwrite").parquet(quarantine)
    return summaries


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def read_lake(spark: SparkSession, root: str, name: str) -> tuple[DataFrame, DataFrame]:
    """The curated and the quarantined rows of a lake table."""
    table, root = TABLES[name], root.rstrip("/")
    curated = spark.read.schema(table.schema).parquet(f"{root}/silver/curated/{name}")
    path = f"{root}/quarantine/{name}"
    schema = curation.quarantine_schema(table)
    if _exists(spark, path):
        return curated, spark.read.schema(schema).parquet(path)
    return curated, spark.createDataFrame([], schema)
