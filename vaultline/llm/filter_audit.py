"""How filters interact: what each removes, in every order they could be applied in.

Five filters give a document a mask, one bit for each filter that it fails. What becomes of a
document at each step of each of the 120 orders depends on its mask alone, so a mask is mapped to big
integers with one field for each of the 600 steps: in one a field says whether the document is removed
there, in one whether it fails there but is gone already, in one whether it is left. Documents are
counted by part and mask first; a part's integers, each times its count, are then summed. A field is wide enough
for the count of all the part's documents, so that no sum reaches into the next field, and unpacking
gives all steps of all orders at once.

Copies are found without a join of rows: rows are counted by text digest, id, part and marks; a digest's
smallest id is found from these counts, and its copies are the counts less those of that id. A
text that a third of all documents have is one row of each task before it is shuffled by its digest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import slices
from vaultline.sources.scratch import keep

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
STEPS = len(ORDERS) * len(FILTERS)

#: Limits of the filters: least words, least percent of distinct words, most percent of capitals, marks.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
MARKS = re.compile(rb"[#$%&*|]")
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NO_CAPITALS = bytes.maketrans(b"", b"")


def own_mask(text: bytes, chars: int) -> int:
    """The bits of the four filters that a text fails by itself, A to D."""
    words = text.split()
    few = len(words) < LEAST_WORDS
    same = 100 * len(set(words)) < LEAST_DISTINCT * len(words)
    capitals = len(text) - len(text.translate(_NO_CAPITALS, _CAPITALS))
    return few | same << 1 | (100 * capitals > MOST_CAPITALS * chars) << 2 | (MARKS.search(text) is not None) << 3


def judged(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``part``, ``digest`` of the whole text and ``mask`` (A to D) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, held in slices(batches):
            chars = pc.utf8_length(batch.column(2)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([hashlib.blake2b(text, digest_size=16).digest() for text in held], pa.binary()),
                    pa.array([own_mask(text, n) for text, n in zip(held, chars)], pa.int32()),
                ],
                ["doc_id", "part", "digest", "mask"],
            )

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, mask int")


def mask_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``mask`` (A to E) and how many documents have both: ``n``, ``good`` and ``toxic`` ones.

    A document is a copy (E) if a smaller ``doc_id`` has its text. Rows without an id are no copies and make
    none; rows that repeat an id and its text are copies only of a smaller id. Null texts are empty, a null ``lang`` is the part ''.
    A document is good or toxic if any row of labels for its id says 1. No documents give no rows.
    """
    each = keep(judged(documents).groupBy("digest", "part", "mask", "doc_id").agg(F.count("*").alias("n")), "judged")
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic")
        .where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)")
        .groupBy("doc_id")
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
             F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    )
    no = F.lit(False)
    with_id = each.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").withColumns(
        {"good": F.coalesce("good", no), "toxic": F.coalesce("toxic", no)}
    )
    rows = with_id.unionByName(each.where("doc_id IS NULL").withColumns({"good": no, "toxic": no}))
    # of each digest and kind of row: all rows, those without an id, and the smallest id with its rows
    kinds = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min("doc_id").alias("least"),
        F.min_by("n", "doc_id").alias("n_least"),
    )
    kinds = keep(kinds, "kinds")
    first = kinds.groupBy("digest").agg(F.min("least").alias("first"))
    kept = F.col("unnamed") + F.when(F.col("least") == F.col("first"), F.col("n_least")).otherwise(0)
    split = kinds.join(first, "digest").withColumn("kept", kept).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct("mask", F.col("kept").alias("n")),
                F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("kept")).alias("n")),
            )
        ).alias("x"),
    )
    return (
        split.groupBy("part", F.col("x.mask").alias("mask"))
        .agg(
            F.sum("x.n").alias("n"),
            F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic"),
        )
    )


class Packed:
    """For each mask the big integers of its outcomes, with fields of ``width`` bits: step ``s`` of order
    ``o`` is field ``5 * o + s``."""

    def __init__(self, width: int):
        self.width = width
        self.removed, self.redundant, self.left = [0] * 32, [0] * 32, [0] * 32
        for mask in range(32):
            for o, order in enumerate(ORDERS):
                gone = False
                for s, name in enumerate(order):
                    one = 1 << (width * (len(FILTERS) * o + s))
                    if mask >> FILTERS.index(name) & 1:
                        (self.redundant if gone else self.removed)[mask] += one
                        gone = True
                    if not gone:
                        self.left[mask] += one

    def unpack(self, total: int) -> list[int]:
        """The fields of a sum."""
        data, size = total.to_bytes(STEPS * self.width // 8, "little"), self.width // 8
        return [int.from_bytes(data[at : at + size], "little") for at in range(0, len(data), size)]


_AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _audited(counts: pa.Table) -> pa.Table:
    """All steps of all orders for one part, from its counts by mask (32 rows at most)."""
    rows = counts.to_pylist()
    everything = sum(row["n"] for row in rows)
    packed = Packed((everything.bit_length() + 7) // 8 * 8 or 8)
    totals = dict.fromkeys(("kept", "removed", "redundant", "good_lost", "toxic_lost"), 0)
    alone = dict.fromkeys(FILTERS, 0)
    for row in rows:
        mask = row["mask"]
        totals["kept"] += row["n"] * packed.left[mask]
        totals["removed"] += row["n"] * packed.removed[mask]
        totals["redundant"] += row["n"] * packed.redundant[mask]
        totals["good_lost"] += row["good"] * packed.removed[mask]
        totals["toxic_lost"] += row["toxic"] * packed.removed[mask]
        if mask.bit_count() == 1:
            alone[FILTERS[mask.bit_length() - 1]] += row["n"]
    fields = {name: packed.unpack(total) for name, total in totals.items()}
    steps = [(order, s, name) for order in ORDERS for s, name in enumerate(order, 1)]
    shapley = dict.fromkeys(FILTERS, 0)
    for (_, _, name), removed in zip(steps, fields["removed"]):
        shapley[name] += removed
    return pa.table(
        {
            "part": pa.array([rows[0]["part"]] * STEPS, pa.string()),
            "filter_order": pa.array([order for order, _, _ in steps], pa.string()),
            "step": pa.array([s for _, s, _ in steps], pa.int32()),
            "kept": pa.array(fields["kept"], pa.int64()),
            "removed": pa.array(fields["removed"], pa.int64()),
            "redundant": pa.array(fields["redundant"], pa.int64()),
            "unique_fails": pa.array([alone[name] for _, _, name in steps], pa.int64()),
            "good_lost": pa.array(fields["good_lost"], pa.int64()),
            "toxic_lost": pa.array(fields["toxic_lost"], pa.int64()),
            "shapley": pa.array([shapley[name] for _, _, name in steps], pa.int64()),
        }
    )


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows a part: ``part``, ``filter_order``, ``step`` and the counts after and at that step.

    ``kept`` documents are left after the step, ``removed`` are removed by it, ``redundant`` fail its filter but were
    removed before, ``unique_fails`` fail its filter and no other; ``good_lost`` and ``toxic_lost`` are
    removed ones that labels call good or toxic; ``shapley`` sums what its filter removes over all orders.
    See ``mask_counts`` for nulls, copies and labels. No documents give no rows.
    """
    counts = mask_counts(documents, labels)
    return counts.groupBy("part").applyInArrow(_audited, _AUDIT)
