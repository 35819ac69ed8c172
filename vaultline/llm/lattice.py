"""Log-probability of whole documents over all segmentations into subwords.

A document is a sequence of words and an end. A word (with a mark before it) is a path through
the lattice of the vocabulary's pieces; its probability is the sum over all paths of the product
of piece probabilities, by a forward recursion in log space. No piece reaches over the mark, so a
document's probability is the product of its words' and of the end's, exactly as if the recursion
ran over the whole text.

The pieces are those of an existing vocabulary. A unigram model's scores are log-probabilities and are
taken as they are; a model of merges has ranks for scores, which are taken as log-probabilities by Zipf's law.
From there ``ROUNDS`` rounds of expected counts over all training words (forward and backward) fit them to the corpus.

Words are counted over the whole corpus. Every distinct word runs through the recursion once.
Frequent words, a table of bounded size, go to the tasks that read texts; the rest of a
document's words meets the word table in a join on the word.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import fold, slices, texts, words_of
from vaultline.llm.sentencepiece_tokens import BYTE, NORMAL, UNIGRAM, USER, Model
from vaultline.sources.scratch import keep

MARK = "▁"
#: Words that a counting task holds before it hands on what it has.
MOST_HELD = 500_000
#: At most so many frequent words are sent to every task, longer ones than so many bytes by a digest.
FREQUENT_WORDS = 200_000
LONGEST_FREQUENT = 48
#: The weight of the vocabulary's own scores against the corpus, in pieces.
PRIOR_WEIGHT = 1_000.0
ROUNDS = 2
#: Up to so many words of one length go through the recursion one by one, so that a word of
#: any length needs no more than its own table of arcs.
FEW = 16
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_pieces(model_file: str) -> tuple[list[str], np.ndarray | None]:
    """The ordinary pieces in the file's order, and a unigram model's log-probabilities of them, None for other models.

    A byte's piece is ``<0xNN>``. Byte pieces and those a user defined have no probability in the file; they get
    that of the library for what is unknown, the least score less ten.
    """
    with open(model_file, "rb") as file:
        model = Model.parse(file.read())
    own = [(piece, score, kind) for piece, score, kind in model.pieces if kind in (NORMAL, USER, BYTE)]
    pieces = [piece for piece, _, _ in own]
    if model.kind != UNIGRAM:
        return pieces, None
    least = min((score for _, score, kind in own if kind == NORMAL), default=0.0) - 10.0
    return pieces, np.array([score if kind == NORMAL else least for _, score, kind in own])


def with_end(pieces: list[str], given: np.ndarray | None) -> tuple[list[str], np.ndarray]:
    """The pieces that a lattice has, with log-probabilities that sum to one with the end's, which comes last.

    The end weighs as much as the likeliest piece. Without given ones, rank gives the weights.
    """
    kept = [at for at, piece in enumerate(pieces) if MARK not in piece[1:]]
    weights = 1.0 / (np.arange(len(kept)) + 3.0) if given is None else np.exp(given[kept])
    weights = np.append(weights, weights.max())
    return [pieces[at] for at in kept], np.log(weights / weights.sum())


class Lattice:
    """Pieces with log-probabilities (natural), for many words at a time."""

    def __init__(self, pieces: list[str], scores: np.ndarray | None = None):
        if scores is None:
            pieces, scores = with_end(pieces, None)
        self.pieces, self.scores = pieces, scores
        place = {p: i for i, p in enumerate(pieces)}
        self.bytes = np.array([place.get(f"<0x{b:02X}>", -1) for b in range(256)])
        own = [(p, i) for i, p in enumerate(pieces) if not (p.startswith("<0x") and len(p) == 6)]
        keys = np.array([self._hash(p) for p, _ in own], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys, self.ids = keys[order], np.array([i for _, i in own])[order]
        self.single = {p for p, _ in own if len(p) == 1}
        self.longest = max((len(p) for p, _ in own), default=1)

    @staticmethod
    def _hash(piece: str) -> int:
        total, base = 0, int(_BASE)
        for char in piece:
            total = (total * base + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
        return total

    def _arcs(self, codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``(from, to, piece ids, log scores)`` of words of one length; no piece is -1."""
        n, size = codes.shape
        unknown = self._unknown(codes)
        prefix = np.zeros((size + 1, n), dtype=np.uint64)
        powers = np.ones(self.longest + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for at in range(self.longest):
                powers[at + 1] = powers[at] * _BASE
            for at in range(size):
                prefix[at + 1] = prefix[at] * _BASE + codes[:, at].astype(np.uint64) + np.uint64(1)
            for stop in range(1, size + 1):
                for start in range(max(0, stop - self.longest), stop):
                    key = prefix[stop] - prefix[start] * powers[stop - start]
                    found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                    ids = np.where(self.keys[found] == key, self.ids[found], -1)
                    scores = np.where(ids >= 0, self.scores[ids], -np.inf)
                    if stop - start == 1:
                        scores = np.where(ids >= 0, scores, unknown[:, start])
                    yield start, stop, ids, scores

    def _unknown(self, codes: np.ndarray) -> np.ndarray:
        """For each character the score of its bytes, used where it is no piece itself."""
        distinct, back = np.unique(codes, return_inverse=True)
        floor = self.scores.min()
        worth = []
        for code in distinct:
            ids = self.bytes[list(chr(code).encode("utf-8", "surrogatepass"))]
            worth.append(sum(self.scores[i] if i >= 0 else floor for i in ids))
        return np.array(worth)[back].reshape(codes.shape)

    def _groups(self, words: list[bytes], most: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and characters of words of one length, about ``most`` characters at a time."""
        by_length: dict[int, tuple[list[int], list[str]]] = {}
        for place, word in enumerate(words):
            text = MARK + word.decode("utf-8", "replace")
            places, held = by_length.setdefault(len(text), ([], []))
            places.append(place)
            held.append(text)
            if len(held) * len(text) >= most:
                del by_length[len(text)]
                yield self._codes(places, held)
        for places, held in by_length.values():
            yield self._codes(places, held)

    @staticmethod
    def _codes(places: list[int], held: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.frombuffer("".join(held).encode("utf-32-le"), dtype="<u4").reshape(len(held), -1)
        return np.array(places), codes

    def _table(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids (none: -1) and log scores of one word's arcs, by where they start and by length from 1."""
        size = len(code)
        ids = np.full((size, self.longest), -1, dtype=np.int32)
        scores = np.full((size, self.longest), -np.inf)
        key = np.zeros(size + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for length in range(1, min(self.longest, size) + 1):
                key = key[:-1] * _BASE + code[length - 1 :].astype(np.uint64) + np.uint64(1)
                found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[found] == key
                ids[: len(key), length - 1] = np.where(hit, self.ids[found], -1)
                scores[: len(key), length - 1] = np.where(hit, self.scores[self.ids[found]], -np.inf)
        scores[:, 0] = np.where(ids[:, 0] >= 0, scores[:, 0], self._unknown(code[None])[0])
        return ids, scores

    @staticmethod
    def _chain(ending: np.ndarray) -> np.ndarray:
        """Log sums over all paths from the start to each place; ``ending`` has scores by end and length."""
        size, longest = ending.shape
        turned = ending[:, ::-1]
        out = np.full(size + longest, -np.inf)
        out[longest - 1] = 0
        for at in range(size):
            through = out[at : at + longest] + turned[at]
            most = through.max()
            out[at + longest] = most + math.log(np.exp(through - most).sum())
        return out[longest - 1 :]

    def _forward_one(self, scores: np.ndarray) -> np.ndarray:
        ending = np.full_like(scores, -np.inf)
        for at in range(min(self.longest, len(scores))):
            ending[at:, at] = scores[: len(scores) - at, at]
        return self._chain(ending)

    def _expected_one(self, code: np.ndarray, weight: float, total: np.ndarray) -> None:
        """Adds one word's expected uses, by where arcs start: backward sums are those of the word turned round."""
        ids, scores = self._table(code)
        size = len(code)
        forward, backward = self._forward_one(scores), self._chain(scores[::-1])[::-1]
        for at in range(min(self.longest, size)):
            used = np.flatnonzero(ids[:, at] >= 0)
            share = np.exp(forward[used] + scores[used, at] + backward[used + at + 1] - forward[size]) * weight
            np.add.at(total, ids[used, at], share)

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, the sum over all its segmentations."""
        out = np.zeros(len(words))
        for places, codes in self._groups(words):
            if len(codes) <= FEW:
                out[places] = [self._forward_one(self._table(code)[1])[-1] for code in codes]
                continue
            forward = np.full((codes.shape[1] + 1, len(codes)), -np.inf)
            forward[0] = 0
            for start, stop, _, scores in self._arcs(codes):
                forward[stop] = np.logaddexp(forward[stop], forward[start] + scores)
            out[places] = forward[-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in all segmentations of the words, times their counts."""
        total = np.zeros(len(self.pieces))
        for places, codes in self._groups(words, 100_000):
            if len(codes) <= FEW:
                for place, code in zip(places, codes):
                    self._expected_one(code, counts[place], total)
                continue
            arcs = list(self._arcs(codes))
            size = codes.shape[1]
            forward = np.full((size + 1, len(codes)), -np.inf)
            backward = np.full((size + 1, len(codes)), -np.inf)
            forward[0] = backward[size] = 0
            for start, stop, _, scores in arcs:
                forward[stop] = np.logaddexp(forward[stop], forward[start] + scores)
            for start, stop, _, scores in sorted(arcs, key=lambda arc: -arc[1]):
                backward[start] = np.logaddexp(backward[start], backward[stop] + scores)
            weight = counts[places]
            for start, stop, ids, scores in arcs:
                used = ids >= 0
                if used.any():
                    share = np.exp(forward[start] + scores + backward[stop] - forward[size]) * weight
                    total += np.bincount(ids[used], weights=share[used], minlength=len(total))
        return total


def word_counts(documents: DataFrame, trained: str) -> DataFrame:
    """``word`` binary, ``trained`` and ``others``: how often each word occurs where ``trained`` holds and elsewhere."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (Counter(), Counter())

        def out() -> Iterator[pa.RecordBatch]:
            for side in (0, 1):
                words = list(held[side])
                times = pa.array(list(held[side].values()), pa.int64())
                none = pa.array(np.zeros(len(words), dtype=np.int64))
                for at in range(0, len(words), 50_000):
                    part = slice(at, at + 50_000)
                    pair = (times[part], none[part]) if side else (none[part], times[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(words[part], pa.binary()), *pair], ["word", "trained", "others"]
                    )
                held[side].clear()

        for batch, texts_ in slices(batches):
            sides = batch.column(batch.schema.get_field_index("trained")).to_pylist()
            for text, side in zip(texts_, sides):
                held[side].update(words_of(text))
                if len(held[0]) + len(held[1]) > MOST_HELD:
                    yield from out()
        yield from out()

    counted = documents.select("text", F.col(trained).alias("trained")).mapInArrow(
        count, "word binary, trained long, others long"
    )
    return counted.groupBy("word").agg(F.sum("trained").alias("trained"), F.sum("others").alias("others"))


def _expectation(words: DataFrame, lattice: Lattice) -> np.ndarray:
    """Expected uses of each piece over all training words."""

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(lattice.pieces))
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                total += lattice.expected(part.column(0).to_pylist(), part.column(1).to_numpy().astype(float))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

    rows = (
        words.where("trained > 0")
        .select("word", "trained")
        .mapInArrow(expect, "piece long, uses double")
        .groupBy("piece")
        .agg(F.sum("uses").alias("uses"))
        .collect()  # a row for each piece of the vocabulary at most
    )
    uses = np.zeros(len(lattice.pieces))
    for row in rows:
        uses[row.piece] = row.uses
    return uses


def fit(
    words: DataFrame, pieces: list[str], ends: int, rounds: int = ROUNDS, given: np.ndarray | None = None
) -> Lattice:
    """The lattice after ``rounds`` of expected counts over all training words, each an update of all pieces.

    It starts from the given log-probabilities, or from ranks.
    """
    pieces, start = with_end(pieces, given)
    lattice = prior = Lattice(pieces, start)
    for _ in range(rounds):
        uses = np.append(_expectation(words, lattice), ends) + PRIOR_WEIGHT * np.exp(prior.scores)
        lattice = Lattice(pieces, np.log(uses / uses.sum()))
    return lattice


def _key(word: bytes) -> bytes:
    """What stands for a long word: a byte that begins no word, and its MD5."""
    return b"\xff" + hashlib.md5(word).digest()


def _frequent_from(words: DataFrame, most: int) -> int:
    """The smallest count from which on there are at most ``most`` words."""
    sizes = words.groupBy((F.col("trained") + F.col("others")).alias("n")).count()
    total = 0
    # the ``most`` largest counts and one more at most come here, one row for each
    for row in sizes.orderBy(F.desc("n")).limit(most + 1).collect():
        total += row["count"]
        if total > most:
            return row.n + 1
    return 1


_STATS = "n_tokens long, n_known long, base double, score double"


def score(documents: DataFrame, model_file: str, held_out: int = 1, folds: int = 5) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of each document.

    Words and pieces are learned from documents whose fold (crc32 of the id as text) is not
    ``held_out``. ``base_score`` is the add-half unigram log10 probability, ``score`` that of the
    lattice. Null and empty texts are an end alone. A missing id counts as empty text for its fold.
    Repeated rows count and come out as often as they occur. If there is nothing to learn from,
    the counts are zero and the vocabulary's own scores stand.
    """
    rows = texts(documents, (fold(F.col("doc_id"), folds) != held_out).cast("int").alias("trained"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    counts = keep(word_counts(rows, "trained"), "words")
    pieces, given = read_pieces(model_file)
    sums = counts.agg(F.sum("trained"), F.sum(F.when(F.col("trained") > 0, 1))).first()
    ends = rows.where("trained = 1").count()
    total, distinct = (sums[0] or 0) + ends, (sums[1] or 0) + (1 if ends else 0)
    lattice = fit(counts, pieces, ends, given=given)

    def words_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                logs = lattice.log_probability(part.column(0).to_pylist()) / np.log(10)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(logs)], ["word", "trained", "others", "logp"]
                )

    scored = keep(
        counts.select("word", "trained", "others").mapInArrow(
            words_scores, "word binary, trained long, others long, logp double"
        ),
        "scored",
    )
    least = _frequent_from(scored, FREQUENT_WORDS)
    often = F.col("trained") + F.col("others") >= least
    below = np.log10(total + 0.5 * (distinct + 1))
    digest = F.concat(F.unhex(F.lit("FF")), F.unhex(F.md5("word")))
    key = F.when(F.length("word") <= LONGEST_FREQUENT, F.col("word")).otherwise(digest)
    table = scored.where(often).select(key, "trained", "logp").toArrow()  # FREQUENT_WORDS at most
    sent = documents.sparkSession.sparkContext.broadcast(
        (table.column(0).to_pylist(), table.column(1).to_numpy(), table.column(2).to_numpy())
    )
    end_base, end_score = float(np.log10(ends + 0.5) - below), float(lattice.scores[-1] / np.log(10))
    end_known = 1 if ends else 0

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen, logp = sent.value
        place = {word: at for at, word in enumerate(words)}
        base = np.append(np.log10(seen + 0.5) - below, 0.0)
        logp = np.append(logp, 0.0)
        known = np.append(seen > 0, False)
        for batch, held in slices(batches):
            out = []
            for text in held:
                tokens = words_of(text)
                none = len(words)
                at = np.fromiter(
                    (place.get(x if len(x) <= LONGEST_FREQUENT else _key(x), none) for x in tokens), dtype=np.int64, count=len(tokens)
                )
                rest = Counter(tokens[i] for i in np.flatnonzero(at == none))
                out.append(
                    (
                        len(tokens) + 1,
                        int(known[at].sum()) + end_known,
                        float(base[at].sum()) + end_base,
                        float(logp[at].sum()) + end_score,
                        [{"word": x, "n": n} for x, n in rest.items()],
                    )
                )
            columns = list(zip(*out))
            pair = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pair)
            keys = [batch.column(batch.schema.get_field_index(name)) for name in ("row", "doc_id", "trained")]
            yield pa.RecordBatch.from_arrays(
                [*keys, *[pa.array(list(c), k) for c, k in zip(columns, kinds)]],
                ["row", "doc_id", "trained", "n_tokens", "n_known", "base", "score", "rest"],
            )

    partly = keep(
        rows.mapInArrow(frequent, f"row long, doc_id long, trained int, {_STATS}, rest array<struct<word:binary,n:long>>"),
        "partly",
    )
    rare = (
        partly.select("row", F.explode("rest").alias("x"))
        .select("row", "x.word", "x.n")
        .join(scored.where(~often).select("word", "trained", "logp"), "word")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("trained") > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * (F.log10(F.col("trained") + 0.5) - F.lit(float(below)))).alias("more_base"),
            F.sum(F.col("n") * F.col("logp")).alias("more_score"),
        )
    )
    none = lambda name, zero: F.coalesce(F.col(name), F.lit(zero))
    return (
        partly.drop("rest")
        .join(rare, "row", "left")
        .select(
            "doc_id",
            (F.col("trained") == 0).alias("held_out"),
            "n_tokens",
            (F.col("n_known") + none("more_known", 0)).alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("base") + none("more_base", 0.0)).alias("base_score"),
            (F.col("score") + none("more_score", 0.0)).alias("score"),
        )
    )
