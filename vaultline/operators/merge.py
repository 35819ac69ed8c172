"""Incremental merge: the latest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(current: DataFrame, changes: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` values of each key, over both inputs.

    ``order`` has to tell the rows of a key apart; of equal ones any may stay.

    ``max_by`` keeps one row per key on the map side already, so a key with very many changes
    reaches the shuffle as one row per task, not as a window partition of all its changes. A struct is no fixed-size
    value, so this aggregate sorts each task's rows by key; ``MergedTable`` gives it the touched ranges only.
    """
    rows = current.unionByName(changes)
    rest = [c for c in rows.columns if c != key]
    latest = F.max_by(F.struct(*rest), F.struct(*order)).alias("row")
    return rows.groupBy(key).agg(latest).select(key, *[F.col(f"row.{c}").alias(c) for c in rest]).select(*rows.columns)
