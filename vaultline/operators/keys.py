"""Key probes: which keys repeat, and which rows refer to a known key.

Both questions are answered by joining a fact to a set of keys. The set is broadcast only
when its counted size is within a bound, as keys or packed to bits. Beyond it the join is a shuffle join in which
frequent keys and NULLs are taken out first, so that no partition receives a hot key.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.sources.scratch import keep

# A broadcast key costs some 40 bytes in memory besides its text, so a million keys stay near 40 MB.
MAX_BROADCAST_KEYS = 1_000_000
MAX_BROADCAST_KEYS_SETTING = "spark.vaultline.maxBroadcastKeys"
# Keys of any length are text; together they may not be larger than this.
MAX_BROADCAST_TEXT = 64 * 1024 * 1024

# A packed row is as large as a broadcast key and holds those of a span of 64 numbers. Fewer keys than this are not packed:
# that takes a job of its own.
SPAN_BITS = 6
PACK_FROM = 10_000

SALTS = 4096
ROW_ID = "row_id"


@dataclass(frozen=True)
class KeySet:
    """Distinct non-null keys in column ``key``, how many there are, and the bytes of textual ones."""

    frame: DataFrame
    rows: int
    text_bytes: int = 0
    _packed: list = field(default_factory=list, init=False, repr=False, compare=False)
    _lock: threading.Lock = field(default_factory=threading.Lock, init=False, repr=False, compare=False)

    def fits(self) -> bool:
        """Whether the set may be broadcast."""
        return self.rows <= max_broadcast_keys(self.frame.sparkSession) and self.text_bytes <= MAX_BROADCAST_TEXT

    def packed(self) -> DataFrame | None:
        """``(span, bits)``: the keys of each span of 64 numbers as the bits of one; None if these rows too are beyond the bound.

        Whole numbers that lie close together, as ids that were given out in order, take up to 64 times fewer
        rows than keys. Written once, for all that refer to the set.
        """
        bound = max_broadcast_keys(self.frame.sparkSession)
        whole = isinstance(self.frame.schema["key"].dataType, T.LongType)
        if not whole or self.rows < PACK_FROM or self.rows > bound << SPAN_BITS:
            return None
        with self._lock:
            if not self._packed:
                spans = keep(_packed(self.frame), "packed")
                self._packed.append((spans, spans.count()))
        spans, rows = self._packed[0]
        return spans if rows <= bound else None

    def stays(self) -> bool:
        """Whether rows that are looked up in the set stay where they are."""
        return self.fits() or self.packed() is not None


def _packed(keys: DataFrame) -> DataFrame:
    bit = F.expr(f"shiftleft(1L, cast(key & {2**SPAN_BITS - 1} as int))")
    return keys.groupBy(F.shiftright("key", SPAN_BITS).alias("span")).agg(F.bit_or(bit).alias("bits"))


def max_broadcast_keys(spark: SparkSession) -> int:
    return int(spark.conf.get(MAX_BROADCAST_KEYS_SETTING, str(MAX_BROADCAST_KEYS)))


def key_set(frame: DataFrame, column: str) -> KeySet:
    """The distinct keys of a column that is not known to be unique."""
    keys = keep(frame.select(F.col(column).alias("key")).where("key IS NOT NULL").distinct(), "keys")
    return KeySet(keys, keys.count())


def unique_key_set(frame: DataFrame, column: str) -> KeySet:
    """The keys of a column that holds each key once: nothing is shuffled, the count reads file footers."""
    keys = frame.select(F.col(column).alias("key"))
    return KeySet(keys, keys.count())


def mark_members(
    frame: DataFrame,
    column: str,
    keys: KeySet,
    flag: str,
    source: DataFrame | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Add ``flag``: whether the value of ``column`` is one of ``keys``.

    The frame has a column ``row_id`` taken at its scan. ``source`` may name a plainer frame with
    the same column, in which frequent values are looked for, and ``counts`` may hold its values counted.
    """
    if keys.rows == 0:
        return frame.withColumn(flag, F.lit(False))
    if not keys.fits() and (spans := keys.packed()) is not None:
        spans = spans.select(F.col("span").alias("_span"), F.col("bits").alias("_bits"))
        joined = frame.join(F.broadcast(spans), F.shiftright(column, SPAN_BITS) == F.col("_span"), "left")
        bit = F.getbit("_bits", F.col(column).bitwiseAND(F.lit(2**SPAN_BITS - 1)).cast("int"))
        return joined.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop("_span", "_bits")
    members = keys.frame.select(F.col("key").alias("_member"), F.lit(True).alias("_is_member"))
    if keys.fits():
        joined = frame.join(F.broadcast(members), F.col(column) == F.col("_member"), "left")
        return joined.withColumn(flag, F.coalesce("_is_member", F.lit(False))).drop("_member", "_is_member")
    return _mark_by_shuffle(frame, column, members, flag, frequent_values(source or frame, column, counts))


def mark_orphans(
    frame: DataFrame, column: str, parent: KeySet, flag: str, source: DataFrame | None = None
) -> DataFrame:
    """Add ``flag``: whether the value of ``column`` is missing or no key of the parent.

    A parent that fits, packed if need be, is broadcast. Beyond that the exceptions are found first, by keys alone:
    the distinct keys of the child that the parent doesn't have. They are few as a rule, so it is
    they that are sent to the rows, and rows stay where they are.
    The child's keys are counted once, for both the exceptions and the frequent ones among them.
    """
    if parent.rows == 0 or parent.stays():
        return mark_members(frame, column, parent, "_known", source).withColumn(flag, ~F.col("_known")).drop("_known")
    counts = value_counts(source or frame, column)
    keys = counts.where("v IS NOT NULL").select(F.col("v").alias("key"))
    orphans = keep(keys.join(by_shuffle(parent.frame), "key", "left_anti"), "orphans")
    marked = mark_members(frame, column, KeySet(orphans, orphans.count()), "_orphan", source, counts)
    return marked.withColumn(flag, F.col(column).isNull() | F.col("_orphan")).drop("_orphan")


def by_shuffle(keys: DataFrame) -> DataFrame:
    """Keys for a join that shuffles both sides. Left to itself, Spark broadcasts by the size of files, and a few
    megabytes of files may hold millions of keys."""
    return keys.hint("merge")


def value_counts(frame: DataFrame, column: str) -> DataFrame:
    """``(v, n)``: each value of a column and its rows, written once. Values are counted before they are shuffled."""
    return keep(frame.select(F.col(column).alias("v")).groupBy("v").agg(F.count("*").alias("n")), "counts")


def frequent_values(frame: DataFrame, column: str, counts: DataFrame | None = None) -> list:
    """Every value with more rows than an even partition of a shuffle would have.

    There are fewer such values than partitions. ``counts`` are those of the column, if they are known.
    """
    partitions = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = counts or value_counts(frame, column)
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("v").isNotNull() & (F.col("n") * F.lit(partitions) > F.lit(total)))
    return [row.v for row in hot.select("v").collect()]


def _mark_by_shuffle(frame: DataFrame, column: str, members: DataFrame, flag: str, hot: list) -> DataFrame:
    """Hot keys meet a broadcast of fewer members than partitions; their rows, and rows without a
    key, are spread evenly by their row id, even if they are copies of one another.
    The row id comes from the scan, so a task that runs again spreads its rows the same way.
    """
    hot_members = members.where(F.col("_member").isin(hot)).select(
        F.col("_member").alias("_hot"), F.col("_is_member").alias("_is_hot_member")
    )
    # Always 0, but not a literal: the optimizer would turn the join on a literal salt into a
    # filter, and all rows without a probe key would meet in one partition.
    zero = F.pmod(F.hash("_member"), F.lit(1))
    cold_members = members.where(~F.col("_member").isin(hot)).withColumn("_member_salt", zero)

    spread = F.col(column).isNull() | F.col(column).isin(hot)
    salted = (
        frame.join(F.broadcast(hot_members), F.col(column) == F.col("_hot"), "left")
        .withColumn("_probe", F.when(~spread, F.col(column)))
        .withColumn("_salt", F.when(spread, F.pmod(F.col(ROW_ID), F.lit(SALTS)).cast("int")).otherwise(0))
    )
    # Members are distinct, so each partition has few of them and they are hashed: the rows need no sort.
    joined = salted.join(
        cold_members.hint("shuffle_hash"),
        (F.col("_probe") == F.col("_member")) & (F.col("_salt") == F.col("_member_salt")),
        "left",
    )
    helpers = ["_hot", "_is_hot_member", "_probe", "_salt", "_member", "_is_member", "_member_salt"]
    return joined.withColumn(flag, F.coalesce("_is_hot_member", "_is_member", F.lit(False))).drop(*helpers)


@dataclass(frozen=True)
class Duplicates:
    """Keys that occur more than once. Missing keys count as copies of each other."""

    numeric: KeySet
    textual: KeySet
    missing: bool


def duplicate_keys(frame: DataFrame, number: str, text: str) -> DataFrame:
    """``(key, key_text, copies)`` of every key held by two or more rows.

    Only keys are shuffled, never rows, and equal keys are counted before the shuffle. A key
    that is not a number is compared as text.
    """
    as_text = F.when(F.col(number).isNull() & (F.col(text) != ""), F.col(text))
    return (
        frame.select(F.col(number).alias("key"), as_text.alias("key_text"))
        .groupBy("key", "key_text")
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )


def find_duplicates(frame: DataFrame, number: str, text: str) -> Duplicates:
    """The repeated keys as sets of known size. They are written once and read back."""
    found = keep(duplicate_keys(frame, number, text), "duplicates")
    sizes = found.agg(
        F.count("key").alias("numeric"),
        F.count("key_text").alias("textual"),
        F.count_if(F.col("key").isNull() & F.col("key_text").isNull()).alias("missing"),
        F.coalesce(F.sum(F.octet_length("key_text")), F.lit(0)).alias("text_bytes"),
    ).first()
    return Duplicates(
        KeySet(found.where("key IS NOT NULL").select("key"), sizes["numeric"]),
        KeySet(found.where("key_text IS NOT NULL").select(F.col("key_text").alias("key")), sizes["textual"], sizes["text_bytes"]),
        sizes["missing"] > 0,
    )
