"""Tokens of two tokenizers aligned by the byte offsets they end at.

Both encode the same bytes. The ends of the tokenizer that has fewer tokens drive a galloping search
through the ends of the other: from the last place found in steps of 1, 2, 4, ... until one is not
smaller, then by halves. Ends that both have cut the tokens into groups, and the difference of two
neighbouring places is the range of tokens that one token overlaps, so that all links of a document
follow from one pass.

How many documents hold a pair of ids linked is counted over all documents. A block of documents
brings each of its pairs once, with the number of its documents, and a document refers to pairs by
their places in its block's list; so what is shuffled are the lists and short numbers, and a pair
that stands in every document is one row of each block.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vaultline.llm.common import slices, texts
from vaultline.llm.packing import encoder_of
from vaultline.llm.sentencepiece_tokens import BYTE, MARK, Model
from vaultline.sources.scratch import keep

#: About how much text the documents of a block have.
BLOCK_BYTES = 12 << 20
#: Room for the blocks of one task in a block's number.
_BLOCKS_OF_TASK = 1 << 33


def gallop(short: list[int], long: list[int]) -> list[int]:
    """For each end in ``short`` the place of the first in ``long`` that is not smaller.

    Both rise strictly, and the last end of ``long`` is not smaller than that of ``short``.
    """
    found: list[int] = []
    add, at, size = found.append, 0, len(long)
    for end in short:
        if long[at] < end:
            at += 1  # an end that is not smaller follows, so this place is there
            if long[at] < end:
                low, step = at + 1, 2
                at += step
                while at < size and long[at] < end:
                    low = at + 1
                    step += step
                    at += step
                at = bisect_left(long, end, low, min(at, size))
        add(at)
    return found


@cache
def _written(ids: int, last: str) -> np.ndarray:
    """Each id as text, first with a comma behind it, then with what ends a group's list."""
    return np.array([f"{at}{sign}" for at in range(ids) for sign in (",", last)], dtype=object)


class Alignment:
    """The tokens of one text by both tokenizers, their groups and their links."""

    def __init__(self, ids_a: np.ndarray, ids_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray):
        self.ids_a, self.ids_b = ids_a, ids_b
        swapped = len(ends_b) < len(ends_a)
        short, long = (ends_b, ends_a) if swapped else (ends_a, ends_b)
        if not len(short):
            self.sizes_a = self.sizes_b = self.at_a = self.at_b = np.zeros(0, dtype=np.int64)
            return
        place = np.array(gallop(short.tolist(), long.tolist()), dtype=np.int64)
        common = long[place] == short
        first = np.zeros(len(short), dtype=np.int64)
        first[1:] = place[:-1] + common[:-1]
        many = place - first + 1
        before = np.cumsum(many) - many
        at_short = np.repeat(np.arange(len(short)), many)
        at_long = np.arange(int(many.sum())) + np.repeat(first - before, many)
        in_short = np.flatnonzero(common) + 1
        in_long = place[common] + 1
        self.at_a, self.at_b = (at_long, at_short) if swapped else (at_short, at_long)
        ends = (in_long, in_short) if swapped else (in_short, in_long)
        self.sizes_a, self.sizes_b = (np.diff(x, prepend=0) for x in ends)

    def codes(self, size_b: int) -> np.ndarray:
        """The id pair of each link as one number, ``a * size_b + b``."""
        return self.ids_a[self.at_a].astype(np.int64) * size_b + self.ids_b[self.at_b]

    def text(self) -> str:
        """The ids of all groups: ``a1,a2|b1;a3|b2,b3``."""
        if not len(self.sizes_a):
            return ""
        said = np.empty(len(self.ids_a) + len(self.ids_b), dtype=object)
        stops_a, stops_b = np.cumsum(self.sizes_a), np.cumsum(self.sizes_b)
        for ids, sizes, stops, before, last in (
            (self.ids_a, self.sizes_a, stops_a, stops_b - self.sizes_b, "|"),
            (self.ids_b, self.sizes_b, stops_b, stops_a, ";"),
        ):
            ends = np.zeros(len(ids), dtype=np.int64)
            ends[stops - 1] = 1
            room = 1 << (int(ids.max()) + 1).bit_length()
            said[np.arange(len(ids)) + np.repeat(before, sizes)] = _written(room, last)[2 * ids + ends]
        return "".join(said.tolist())[:-1]


class Aligner:
    """Both tokenizers: byte-level merges of a tokenizers file (A), and a sentencepiece model (B).

    A encodes the text with a space before it, B the text, to which it adds that space itself.
    """

    def __init__(self, file_a: str, file_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.encode_a = encoder_of(file_a)
        self.library = sentencepiece.SentencePieceProcessor(model_file=file_b)
        with open(file_b, "rb") as file:
            pieces = Model.parse(file.read()).pieces
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode() for piece, _, kind in pieces
        ]
        # the fixed writing of bytes as characters: printable ones are themselves, the rest follow from 256 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        letters = {chr(b): b for b in plain} | {chr(256 + at): b for at, b in enumerate(b for b in range(256) if b not in plain)}
        vocabulary = Tokenizer.from_file(file_a).get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            self.bytes_a[at] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.length_a = np.array([len(x) for x in self.bytes_a], dtype=np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype=np.int64)

    def __call__(self, held: list[str]) -> Iterator[Alignment]:
        none = np.zeros(0, dtype=np.int64)
        for text, b in zip(held, self.library.encode(held, num_threads=1)):
            a = self.encode_a(" " + text) if text else []
            said = b"" if not text else b" " + text.encode()
            whole_a, whole_b = (b"".join(map(of.__getitem__, ids)) for of, ids in ((self.bytes_a, a), (self.bytes_b, b)))
            if not text or whole_a != said or whole_b != said:
                yield Alignment(none, none, none, none)
                continue
            ids_a, ids_b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
            yield Alignment(ids_a, ids_b, np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b]))


def size_of(file_b: str) -> int:
    """How many ids a sentencepiece model has."""
    with open(file_b, "rb") as file:
        return len(Model.parse(file.read()).pieces)


_ALIGNED = "doc_id long, ids_a array<int>, ids_b array<int>, sizes_a array<int>, sizes_b array<int>"


def align(documents: DataFrame, file_a: str, file_b: str) -> DataFrame:
    """``doc_id``, ``ids_a``, ``ids_b``, and the tokens of each group: ``sizes_a``, ``sizes_b``.

    Strings of special tokens are plain text. Null and empty texts, and texts that one of the
    tokenizers does not give back byte for byte, have no tokens and no groups. Rows are kept as they
    are, repeated ones and those without an id too; no rows give none. All other columns stay behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(file_a, file_b)
        for batch, held in slices(batches):
            found = list(aligner([text.decode() for text in held]))
            kind = pa.list_(pa.int32())
            columns = [pa.array([getattr(x, name) for x in found], kind) for name in ("ids_a", "ids_b", "sizes_a", "sizes_b")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "ids_a", "ids_b", "sizes_a", "sizes_b"])

    return texts(documents).mapInArrow(run, _ALIGNED)


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, their lowest bytes first: what is mostly small compresses well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_COUNTED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, described string, "
    "pairs binary, times binary, codes array<long>, held array<int>"
)
_SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, described string"


def link_scores(
    documents: DataFrame, file_a: str, file_b: str, describe: Callable[[Alignment], str] | None = None
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``described``.

    A link is a pair of token occurrences whose byte ranges overlap. The count of an id pair is
    the number of documents that hold it linked, over all documents; a row that is repeated counts
    as often as it stands there. ``n_best`` counts the links whose pair's count is the greatest of its
    A id, ties included; ``count_sum`` sums counts over links. ``described`` is what ``describe`` says of a
    document's alignment. Documents without tokens (see ``align``) have zeros and what ``describe`` says of
    nothing. Rows without an id are kept; no rows give none.
    """
    size_b = size_of(file_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(file_a, file_b)
        block = TaskContext.get().partitionId() * _BLOCKS_OF_TASK
        for batch, held in slices(batches, most=BLOCK_BYTES):
            rows, pairs, times = [], [], []
            for x in aligner([text.decode() for text in held]):
                found, many = np.unique(x.codes(size_b), return_counts=True)
                said = describe(x) if describe else None
                rows.append((len(x.ids_a), len(x.ids_b), len(x.sizes_a), len(x.at_a), said))
                pairs.append(found)
                times.append(_planes(many))
            codes, documents_of = np.unique(np.concatenate(pairs), return_counts=True)
            places = [_planes(np.diff(np.searchsorted(codes, found), prepend=0)) for found in pairs]
            figures = list(zip(*rows))
            more = len(rows) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * more, pa.int64()),
                    pa.concat_arrays([batch.column(0), pa.nulls(1, pa.int64())]),
                    *[pa.array([*column, None], pa.int64()) for column in figures[:4]],
                    pa.array([*figures[4], None], pa.string()),
                    pa.array([*places, None], pa.binary()),
                    pa.array([*times, None], pa.binary()),
                    pa.array([None] * len(rows) + [codes], pa.list_(pa.int64())),
                    pa.array([None] * len(rows) + [documents_of.astype(np.int32)], pa.list_(pa.int32())),
                ],
                ["block", "doc_id", *_FIGURES, "described", "pairs", "times", "codes", "held"],
            )
            block += 1

    done = keep(texts(documents).mapInArrow(run, _COUNTED), "aligned")
    listed = done.where("codes IS NOT NULL").select("block", F.posexplode(F.arrays_zip("codes", "held")).alias("place", "pair"))
    listed = listed.select("block", "place", F.col("pair.codes").alias("code"), F.col("pair.held").cast("long").alias("held"))
    of_a = Window.partitionBy("id_a")
    counts = (
        listed.groupBy("code")
        .agg(F.sum("held").alias("many"))
        .withColumn("id_a", F.expr(f"code div {size_b}"))
        .withColumn("best", F.col("many") == F.max("many").over(of_a))  # an A id has as many pairs as B has ids, at most
    )
    known = listed.join(counts.select("code", "many", "best"), "code").select(F.col("block").alias("of_block"), "place", "many", "best")
    rows = done.where("codes IS NULL").select("block", "doc_id", *_FIGURES, "described", "pairs", "times")

    def score(held: pa.Table, pairs: pa.Table) -> pa.Table:
        place = pairs.column("place").to_numpy()
        many = np.zeros(len(place), dtype=np.int64)
        best = np.zeros(len(place), dtype=np.int64)
        many[place] = pairs.column("many").to_numpy()
        best[place] = pairs.column("best").to_numpy()
        n_best, count_sum = [], []
        for at, times in zip(held.column("pairs").to_pylist(), held.column("times").to_pylist()):
            at, times = np.cumsum(_from_planes(at)), _from_planes(times)
            n_best.append(int(best[at] @ times))
            count_sum.append(int(many[at] @ times))
        kept = held.select(["doc_id", *_FIGURES])
        for name, values in (("n_best", n_best), ("count_sum", count_sum)):
            kept = kept.append_column(name, pa.array(values, pa.int64()))
        return kept.append_column("described", held.column("described"))

    return rows.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(score, _SCORED)
