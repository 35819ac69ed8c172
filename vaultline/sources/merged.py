"""A table that holds the latest row of each key, merged range by range.

Rows lie in ranges of their key. A merge reads and rewrites the ranges that its changes fall into; the new
files and the untouched old ones together become the next version, which readers see as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators.merge import latest_per_key
from vaultline.sources.buckets import BUCKET, Buckets, distinct_buckets
from vaultline.sources.scratch import keep

ROWS = "rows"
#: The range of rows without a key.
NO_KEY = -(2**62)


class MergedTable:
    """The rows below one root folder; ``key`` is a column of whole numbers, ``order`` tells the latest row of a key.

    ``span`` keys make a range; it stays as it is for a root. It is chosen so that a range has the size of a file or a few.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, order: list[str], span: int = 1_000_000):
        self.spark, self.store, self.schema = spark, Buckets(spark, root), schema
        self.key, self.order, self.span = key, order, span

    def _range(self) -> Column:
        key = F.col(self.key).cast("long")
        return F.coalesce((key - F.pmod(key, F.lit(self.span))) / self.span, F.lit(NO_KEY)).cast("long")

    def _ranged(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names).withColumn(BUCKET, self._range())

    def merge(self, changes: DataFrame) -> int:
        """Merge rows into the table; the number of the version that holds them.

        Raises ``Overtaken`` if another merge was recorded meanwhile: it has to be merged into that one.
        """
        change = self.store.begin()
        staged = keep(self._ranged(changes), "changes")
        touched = distinct_buckets(staged)
        if not touched:
            return change.base
        try:
            old = self.store.read(change.stored, ROWS, self.schema, touched, T.LongType()).drop(BUCKET)
            merged = latest_per_key(old, staged.drop(BUCKET), self.key, self.order)
            self.store.replace(change, ROWS, self._ranged(merged), touched)
            return self.store.commit(change)
        except BaseException:
            self.store.discard(change)
            raise

    def rows(self, version: int | None = None) -> DataFrame:
        """All rows of the current version, or of one that is kept."""
        stored = self.store.record(version)["stored"]
        return self.store.read(stored, ROWS, self.schema, kind=T.LongType()).select(*self.schema.names)
