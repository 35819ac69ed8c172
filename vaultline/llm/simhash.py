"""Near-duplicate documents by 64-bit SimHash and an inverted index on byte positions.

Two fingerprints that differ in at most two bits share at least six of their eight positional
bytes. The index posts each fingerprint under its bytes at four positions at a time: of the
four neighbouring pairs of positions at most two can differ, so similar fingerprints meet under
one of six keys at least. Pairs that meet are tallied over all eight positions, those with fewer
than six shared bytes are dropped, and the rest is verified bit by bit.

A key that more than ``MOST_POSTINGS`` fingerprints share would give too many pairs. Its members
are linked exactly by another way: two fingerprints are within two bits if and only if some value
is within one bit of both, so each member is posted under its 65 values within one bit and all
that meet are tied to the smallest of them. The work is 65 rows a member, however large the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import slices, texts, words_of
from vaultline.llm.components import components
from vaultline.sources.scratch import keep

SHINGLE = 3
SEED = 42
MOST_BITS = 2
BYTES = 8
#: Each differing bit spoils one byte at most.
LEAST_SHARED = BYTES - MOST_BITS
MOST_POSTINGS = 64
#: Masks of four byte positions: two of the four neighbouring pairs.
_MASKS = [
    sum(0xFFFF << (16 * pair) for pair in pairs) for pairs in combinations(range(BYTES // 2), 2)
]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: bytes) -> int:
    """SimHash of the 3-word shingles, repeats included; no words: zero."""
    words = words_of(text)
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return digest(joined, SEED)
    ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends)]
    hashes = np.fromiter(
        (digest(joined[start:end], SEED) for start, end in zip(starts, ends[SHINGLE - 1 :])),
        dtype=np.uint64,
        count=len(words) - SHINGLE + 1,
    )
    tally = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65_535):
        part = hashes[start : start + 65_535].astype("<u8").view(np.uint8).reshape(-1, BYTES)
        tally += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * tally > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, held in slices(batches):
        values = pa.array([_signed(fingerprint(text)) for text in held], pa.int64())
        columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*columns, values], [*names, "fingerprint"])


def fingerprints(documents: DataFrame, *more: Column) -> DataFrame:
    """``doc_id``, the given columns and ``fingerprint`` (a long of 64 bits) of each document."""
    rows = texts(documents, *more)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(_fingerprints, f"{kept}, fingerprint long")


def _shared_bytes(left: str, right: str) -> Column:
    differing = F.col(left).bitwiseXOR(F.col(right))
    same = [F.when(differing.bitwiseAND(F.lit(_signed(0xFF << (8 * at)))) == 0, 1).otherwise(0) for at in range(BYTES)]
    return sum(same[1:], same[0])


def links(distinct: DataFrame, most_postings: int = MOST_POSTINGS) -> DataFrame:
    """``(a, b)`` of fingerprints whose closure joins all within two bits of one another.

    ``distinct`` has each fingerprint once. Every pair under a key of at most ``most_postings``
    members is listed itself; members of larger keys are tied to the smallest fingerprint that
    meets them, which is within two bits of each.
    """
    keys = F.array(
        *[
            F.struct(F.lit(at).alias("positions"), F.col("fingerprint").bitwiseAND(F.lit(_signed(mask))).alias("bytes"))
            for at, mask in enumerate(_MASKS)
        ]
    )
    postings = distinct.select("fingerprint", F.explode(keys).alias("key")).select("key.positions", "key.bytes", "fingerprint")
    sizes = postings.groupBy("positions", "bytes").agg(F.count("*").alias("members")).where("members > 1")
    shared = keep(postings.join(sizes, ["positions", "bytes"]), "postings")

    small = shared.where(F.col("members") <= most_postings).drop("members")
    left = small.withColumnRenamed("fingerprint", "a")
    right = small.withColumnRenamed("fingerprint", "b")
    pairs = (
        left.join(right, ["positions", "bytes"])
        .where(F.col("a") < F.col("b"))
        .where(_shared_bytes("a", "b") >= LEAST_SHARED)
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS)
        .select("a", "b")
    )

    crowded = shared.where(F.col("members") > most_postings).select("fingerprint").distinct()
    flips = F.array(F.col("fingerprint"), *[F.col("fingerprint").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(64)])
    near = crowded.select("fingerprint", F.explode(flips).alias("value"))
    centres = near.groupBy("value").agg(F.min("fingerprint").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    ties = near.join(centres, "value").select("a", F.col("fingerprint").alias("b")).where("a < b")
    return pairs.unionByName(ties).distinct()


def near_duplicates(documents: DataFrame, *more: Column) -> DataFrame:
    """``doc_id``, the given columns, ``fingerprint`` long and ``component_id`` of each document.

    ``component_id`` is the smallest ``doc_id`` that can be reached over links. Null and empty
    texts have fingerprint zero and are linked like any other. Exact copies, however many, count
    once from the second step on. A missing ``doc_id`` keeps its row and never names a group that
    has another. Repeated rows stay repeated; no rows give no rows.
    """
    marked = keep(fingerprints(documents, *more), "fingerprints")
    distinct = keep(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(distinct.select("fingerprint")))
    grouped = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    named = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    by_print = grouped.join(named, "root").select("fingerprint", "component_id")
    return marked.join(by_print, "fingerprint", "left").select(
        *[name for name in marked.columns if name != "fingerprint"], "fingerprint", "component_id"
    )


def first_of_groups(documents: DataFrame) -> DataFrame:
    """The documents without near copies: of each group the row with the smallest ``doc_id`` stays.

    Among rows with that same id the first as read stays, so repeated rows go too. All columns
    are kept as they are.
    """
    place = "__place"
    # written, so that a place means the same row in both reads, whatever the frame is made of
    placed = keep(documents.withColumn(place, F.monotonically_increasing_id()), "placed")
    found = near_duplicates(placed, F.col(place))
    # A group whose ids are all missing is known by its fingerprints' smallest place alone.
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("print "), F.col("fingerprint").cast("string")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", place))
    chosen = found.groupBy(group.alias("grp")).agg(first.alias("first")).select(F.col(f"first.{place}").alias(place))
    # the places are small and unique: they are hashed, and the documents pass by unsorted
    return placed.join(chosen.hint("shuffle_hash"), place, "left_semi").drop(place)
