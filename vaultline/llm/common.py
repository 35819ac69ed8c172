"""What several operators share: folds, words, bounded batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a missing id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def texts(documents: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` as long, ``text`` (null: empty) and the given columns; all else is left behind."""
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *more,
    )


def words_of(text: bytes) -> list[bytes]:
    """The words of ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case."""
    return text.lower().split()


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 8 << 20
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Each Arrow batch cut into runs of about ``most`` bytes of text, so that memory stays bounded.

    A run holds one text at least; with it come its texts as UTF-8 bytes.
    """
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        start, size, held = 0, 0, []
        for row, value in enumerate(values):
            text = value.as_py() or b""
            if held and size + len(text) > most:
                yield batch.slice(start, row - start), held
                start, size, held = row, 0, []
            held.append(text)
            size += len(text)
        if held:
            yield batch.slice(start), held


def join_spread(rows: DataFrame, groups: DataFrame, keys: list[str], many: str, total: int) -> DataFrame:
    """The rows whose key is in ``groups``, with its columns but ``many``.

    ``groups`` is a written table of one row a key; ``many`` says how many of the ``total`` rows have it. Keys with
    more rows than an even partition are fewer than partitions: they are broadcast and their rows stay
    where they are; all others meet in a shuffle.
    """
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.col(many) * F.lit(partitions) > F.lit(total)
    few, rest = groups.where(hot).drop(many), groups.where(~hot).drop(many)
    at_hot = rows.join(F.broadcast(few), keys)
    others = rows.join(F.broadcast(few.select(*keys)), keys, "left_anti")
    return at_hot.unionByName(others.join(rest, keys))
