"""Documents packed into training windows by non-negative least squares.

A document's tokens are cut into whole windows and a rest. Rests are counted by length, a table
of as many rows as a window has tokens. Shallow combinations of two or three lengths that fill a
window exactly are enumerated; non-negative least squares gives how often each is to be repeated
so that together they use up the counts; repeats are rounded down. What is left is packed
greedily: the longest first, then the longest that still fit, and where none fits a rest is cut.

All of this is decided on lengths, not on documents. A document finds its place by its rank
among the rests of its length, which comes from counts of buckets and a window within one bucket;
a length that a third of all documents have is dealt over all buckets, repeated rows too.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import slices, texts
from vaultline.sources.scratch import keep

WINDOW = 2048
#: A rest may be cut at multiples of so many tokens.
GRAIN = 128
#: The last id of each document.
END = 1
#: Every pair of lengths is a combination; so is every triple with one of this many most frequent lengths.
FREQUENT = 24
ROUNDS = 400
#: A fixed value: how byte-level merges of this family split a text beforehand.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts with so long a run of one white-space character take the slower way.
LONG_RUN = 10_000

_TOKENIZED = "doc_id long, doc_tokens long, whole array<long>, rest int, rest_crc long, heads array<long>, tails array<long>"


def encoder_of(tokenizer: str, special: bool = False) -> Callable[[str], list[int]]:
    """Ids of a text by a tokenizers file of byte-level merges.

    Added tokens that stand in a text get their own ids, special ones only if ``special`` (as the
    library does unless ``encode_special_tokens`` is set); no token is put around a text.

    The file's tokens in order of merging are exactly the ranks that tiktoken merges by, with the
    same pre-tokenizer and several times as fast. Texts that it refuses go to the tokenizers library.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(tokenizer, encoding="utf-8") as file:
        content = json.load(file)
    model = content["model"]
    added = {t["content"]: t for t in content.get("added_tokens") or [] if t["content"] and (special or not t["special"])}
    # a token that takes white space with it, or has to be found in a normalised text, is left to the library
    plainly = not content.get("normalizer") and not any(
        t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added.values()
    )
    longest_first = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True))) or r"(?!)")
    # the fixed writing of bytes as characters: printable ones are themselves, the rest follow from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters.update({chr(256 + at): b for at, b in enumerate(b for b in range(256) if b not in set(plain))})
    merged = {tuple(m.split(" ")) if isinstance(m, str) else tuple(m): at for at, m in enumerate(model["merges"])}
    ranks = {}
    for token, at in model["vocab"].items():
        if all(c in letters for c in token) and at < 256 + len(merged):
            ranks[bytes(letters[c] for c in token)] = at
    in_order = all(model["vocab"].get(left + right) == 256 + at for (left, right), at in merged.items())
    if not in_order or len(ranks) != 256 + len(merged):
        raise ValueError(f"{tokenizer} does not number its tokens in order of merging")
    fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    slow: list = []

    def encode(text: str) -> list[int]:
        if " " * LONG_RUN not in text and "\n" * LONG_RUN not in text:
            try:
                return fast.encode_ordinary(text)
            except BaseException as fault:  # a fault of the native library is no ordinary exception
                if isinstance(fault, KeyboardInterrupt | SystemExit | MemoryError):
                    raise
        return by_library(text)

    def by_library(text: str) -> list[int]:
        if not slow:
            backend = Tokenizer.from_file(tokenizer)
            backend.encode_special_tokens = not special
            slow.append(backend)
        return slow[0].encode(text, add_special_tokens=False).ids

    def encode_around(text: str) -> list[int]:
        if not plainly and longest_first.search(text):
            return by_library(text)
        ids, at = [], 0
        for found in longest_first.finditer(text):
            ids += encode(text[at : found.start()])
            ids.append(added[found[0]]["id"])
            at = found.end()
        return ids + encode(text[at:]) if at else encode(text)

    return encode_around if added else encode


def tokenize(
    documents: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, special: bool = False
) -> DataFrame:
    """Lengths and checksums of each document's windows and rest, and of the rest's possible pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_of(tokenizer, special)
        last = np.array([end], dtype="<u4").tobytes()
        for batch, held in slices(batches):
            rows = []
            for text in held:
                ids = memoryview(array("I", encode(text.decode())).tobytes() + last)
                tokens = len(ids) // 4
                whole = tokens // window
                crcs = [zlib.crc32(ids[4 * window * k : 4 * window * (k + 1)]) for k in range(whole)]
                rest = ids[4 * window * whole :]
                cuts = range(4 * GRAIN, len(rest), 4 * GRAIN)
                heads = [zlib.crc32(rest[:cut]) for cut in cuts]
                tails = [zlib.crc32(rest[cut:]) for cut in cuts]
                rows.append((tokens, crcs, tokens % window, zlib.crc32(rest), heads, tails))
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                ["doc_id", "doc_tokens", "whole", "rest", "rest_crc", "heads", "tails"],
            )

    return texts(documents).mapInArrow(run, _TOKENIZED)


def combinations_of(counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Pairs and triples of occurring lengths that fill a window; unused places hold zero."""
    there = np.flatnonzero(counts)
    there = there[there > 0]
    found = [np.stack([there, window - there, np.zeros_like(there)], axis=1)]
    for common in there[np.argsort(-counts[there], kind="stable")[:FREQUENT]]:
        second = there
        third = window - common - second
        found.append(np.stack([np.full_like(second, common), second, third], axis=1)[third > 0])
    rows = np.concatenate(found)
    rows = rows[(rows >= 0).all(axis=1)]
    rows = rows[((rows == 0) | (counts[rows] > 0)).all(axis=1)]
    return np.unique(np.sort(rows, axis=1)[:, ::-1], axis=0)


def repeats(counts: np.ndarray, rows: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares: how often to use each combination, by multiplicative steps.

    Minimises the squared difference between the lengths used and ``counts``; each step keeps
    signs and never raises the error.
    """
    size = len(counts)
    weight = (rows > 0).astype(float)
    wanted = counts.astype(float)
    wanted[0] = 0
    to = (wanted[rows] * weight).sum(axis=1)
    x = np.full(len(rows), wanted.sum() / max(1, weight.sum()))
    for _ in range(rounds):
        used = np.bincount(rows.ravel(), weights=(x[:, None] * weight).ravel(), minlength=size)
        have = (used[rows] * weight).sum(axis=1)
        x = x * to / np.maximum(have, 1e-12)
    return x


@dataclass
class Plan:
    """Where each rest goes: rests of ``length`` with ranks ``first`` to ``first + many - 1`` put their
    tokens ``start`` to ``stop`` at ``offset`` of sequences ``sequence``, ``sequence + 1``, ..."""

    rows: list[tuple[int, int, int, int, int, int, int]]
    sequences: int

    def place(self) -> dict[tuple[int, bool], tuple[list[int], list[tuple]]]:
        """By length and whether it is a head: first ranks and rows, in order of rank."""
        found: dict = {}
        for row in sorted(self.rows, key=lambda r: (r[0], r[1] > 0, r[3])):
            ranks, rows = found.setdefault((row[0], row[1] == 0), ([], []))
            ranks.append(row[3])
            rows.append(row)
        return found


def plan_of(counts: np.ndarray, window: int = WINDOW, grain: int = GRAIN) -> Plan:
    """The plan for ``counts[length]`` rests of each length below ``window``.

    Its size depends on the lengths that occur, not on how many documents have them.
    """
    left = counts.astype(np.int64).copy()
    left[0] = 0
    taken = np.zeros(len(counts), dtype=np.int64)
    rows, sequences = [], 0
    if left.sum():
        combos = combinations_of(left, window)
        times = repeats(left, combos) if len(combos) else np.zeros(0)
        for at in np.argsort(-times, kind="stable"):
            lengths = combos[at][combos[at] > 0]
            need = {int(n): int((lengths == n).sum()) for n in lengths}
            many = min([math.floor(times[at] + 1e-9), *(int(left[n]) // k for n, k in need.items())])
            if many < 1:
                continue
            offset = 0
            for n in map(int, lengths):
                rows.append((n, 0, n, int(taken[n]), many, sequences, offset))
                taken[n] += many
                left[n] -= many
                offset += n
            sequences += many

    parts: dict[int, list[list[int]]] = {}  # rests' tails by their length: [length of the rest, start, first, many]
    while True:
        used: list[list] = []  # [supply, start, stop]; a supply is a length or a tail's list
        uses: dict = {}
        space = window

        def have(length: int) -> object:
            """A supply of this length with something left, tails first."""
            for part in parts.get(length, ()):
                if part[3] > uses.get(id(part), 0):
                    return part
            return length if left[length] > uses.get(length, 0) else None

        lengths = sorted({*map(int, np.flatnonzero(left)), *(n for n, p in parts.items() if p)}, reverse=True)
        if not lengths:
            break
        for n in lengths:
            while n <= space and (supply := have(n)) is not None:
                tail = isinstance(supply, list)
                uses[id(supply) if tail else supply] = uses.get(id(supply) if tail else supply, 0) + 1
                used.append([supply, supply[1] if tail else 0, supply[0] if tail else n])
                space -= n
        cut = space // grain * grain
        if cut:
            for n in lengths:
                if n > cut and left[n] > uses.get(n, 0):
                    uses[n] = uses.get(n, 0) + 1
                    used.append([n, 0, cut])
                    break
            else:
                cut = 0
        many = min((s[3] if isinstance(s, list) else int(left[s])) // uses[id(s) if isinstance(s, list) else s] for s, _, _ in used)
        offset = 0
        new = []
        for supply, start, stop in used:
            if isinstance(supply, list):
                rows.append((supply[0], start, stop, supply[2], many, sequences, offset))
                supply[2] += many
                supply[3] -= many
            else:
                rows.append((supply, start, stop, int(taken[supply]), many, sequences, offset))
                if stop < supply:
                    new.append([supply, stop, int(taken[supply]), many])
                taken[supply] += many
                left[supply] -= many
            offset += stop - start
        for part in new:
            parts.setdefault(part[0] - part[1], []).append(part)
        parts = {n: kept for n, p in parts.items() if (kept := [x for x in p if x[3]])}
        sequences += many
    return Plan(rows, sequences)


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(
    documents: DataFrame, tokenizer: str, window: int = WINDOW, end: int = END, special: bool = False
) -> DataFrame:
    """One row for each piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    Each id of each document (its last is ``end``) is in exactly one piece, and a sequence has at
    most ``window`` ids without gaps. Null and empty texts are one id. Repeated rows are packed
    each; a missing ``doc_id`` stays missing; no rows give none. ``special`` is that of ``encoder_of``.
    """
    spark = documents.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # the position is written with the row, so that all that read the table see the same one
    tokens = tokenize(documents, tokenizer, window, end, special).withColumn("position", F.monotonically_increasing_id())
    done = keep(tokens, "tokens").withColumn("bucket", F.pmod(F.xxhash64("position"), F.lit(buckets)))
    done = done.withColumn("windows", F.size("whole").cast("long"))
    counts = keep(done.groupBy("rest", "bucket").agg(F.count("*").alias("many"), F.sum("windows").alias("windows")), "counts")

    table = np.zeros(window, dtype=np.int64)
    windows = np.zeros(window, dtype=np.int64)
    for row in counts.groupBy("rest").agg(F.sum("many").alias("many"), F.sum("windows").alias("windows")).collect():
        table[row.rest], windows[row.rest] = row.many, row.windows  # a row for each length
    plan = plan_of(table, window)
    whole_from = plan.sequences + np.concatenate([[0], np.cumsum(windows)[:-1]])

    before = Window.partitionBy("rest").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "rest",
        "bucket",
        F.coalesce(F.sum("many").over(before), F.lit(0)).alias("rank_from"),
        F.coalesce(F.sum("windows").over(before), F.lit(0)).alias("window_from"),
    )
    within = Window.partitionBy("rest", "bucket").orderBy("position")
    ranked = (
        done.withColumn("rank", F.row_number().over(within) - 1)
        .withColumn(
            "windows_before",
            F.coalesce(F.sum("windows").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
        .join(starts, ["rest", "bucket"])
        .select(
            "doc_id",
            "doc_tokens",
            "whole",
            "rest",
            "rest_crc",
            "heads",
            "tails",
            (F.col("rank") + F.col("rank_from")).alias("rank"),
            (F.col("windows_before") + F.col("window_from")).alias("first_window"),
        )
    )
    place = plan.place()
    base = whole_from.tolist()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                doc, tokens, rest = row["doc_id"], row["doc_tokens"], row["rest"]
                first = base[rest] + row["first_window"]
                for k, crc in enumerate(row["whole"]):
                    out.append((doc, k * window, window, crc, tokens, first + k, 0))
                if not rest:
                    continue
                done_to = tokens - rest
                ranks, rows = place[rest, True]
                _, _, stop, low, _, sequence, offset = rows[bisect_right(ranks, row["rank"]) - 1]
                crc = row["rest_crc"] if stop == rest else row["heads"][stop // GRAIN - 1]
                out.append((doc, done_to, stop, crc, tokens, sequence + row["rank"] - low, offset))
                if stop < rest:
                    ranks, rows = place[rest, False]
                    _, start, _, low, _, sequence, offset = rows[bisect_right(ranks, row["rank"]) - 1]
                    crc = row["tails"][start // GRAIN - 1]
                    out.append((doc, done_to + start, rest - start, crc, tokens, sequence + row["rank"] - low, offset))
            names = [part.split()[0] for part in _PIECES.split(", ")]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)

    return ranked.mapInArrow(pieces, _PIECES)
