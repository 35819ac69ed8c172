"""Document quality by attention over passages.

A document is a bag of passages and only the bag has a label. Every passage is encoded: hashed
word and character frequencies through a learned layer. Gated attention gives each passage a
weight, the weights of a document sum to one, and the weighted mean of its passages is scored.
All layers are learned together from documents' labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import fold, slices, texts
from vaultline.llm.ngram_quality import labelled_sample, repeated_words
from vaultline.llm.ngrams import Texts

#: At most so many labelled rows are used to fit.
SAMPLE_ROWS = 4_000
PASSAGE_WORDS = 96
#: Of good quality from this score on.
GOOD_FROM = 0.3
WORD_BUCKETS, CHARACTER_BUCKETS = 128, 256
#: Shares of a passage: words in windows that the text repeats, capitals, symbols, line breaks.
SHARES = 4
INPUTS = WORD_BUCKETS + CHARACTER_BUCKETS + SHARES
HIDDEN, GATES = 24, 12
_EPOCHS, _BATCH, _RATE, _DECAY = 25, 64, 0.01, 1e-5
_SLICE = 1 << 20
_SCALE = 3.0
_SYMBOL = np.isin(np.arange(256), [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)])


def passages(texts_: Texts) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each passage, and the text it is of. A text without words is one empty passage."""
    counts = texts_.word_counts()
    many = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(many)])
    within = np.arange(len(texts_.word_text)) - np.concatenate([[0], np.cumsum(counts)])[texts_.word_text]
    of_word = first[texts_.word_text] + within // PASSAGE_WORDS
    total = int(first[-1])

    hashes = texts_.word_hashes()
    words = (hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
    grams = (texts_.character_hashes(3) % np.uint32(CHARACTER_BUCKETS)).astype(np.int64)
    # a byte belongs to the passage of the last word that began at or before it
    begun = np.zeros(len(texts_.buffer), dtype=np.int64)
    begun[texts_.word_starts] = 1
    last = np.cumsum(begun) - 1
    used = (last >= 0) & ~texts_.space
    left = np.bincount(of_word * WORD_BUCKETS + words, minlength=total * WORD_BUCKETS).reshape(total, -1)
    right = np.bincount(
        of_word[last[used]] * CHARACTER_BUCKETS + grams[used], minlength=total * CHARACTER_BUCKETS
    ).reshape(total, -1)
    share = [np.sqrt(x / np.maximum(1, x.sum(axis=1, keepdims=True))) * _SCALE for x in (left, right)]
    passage, known = of_word[last[last >= 0]], texts_.buffer[last >= 0]
    size = np.maximum(1, np.bincount(passage, minlength=total))
    tell = lambda marks: np.bincount(passage[marks], minlength=total) / size
    again = np.bincount(of_word[repeated_words(texts_, hashes)], minlength=total) / np.maximum(1, left.sum(axis=1))
    share.append(
        np.stack([again, tell((known >= 65) & (known <= 90)), tell(_SYMBOL[known]), tell(known == 10)], axis=1) * _SCALE
    )
    return np.concatenate(share, axis=1).astype(np.float32), np.repeat(np.arange(len(counts)), many)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Network:
    """Encoder, gated attention and scorer; ``parts`` are the arrays that are learned."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.parts = [
            draw(INPUTS, HIDDEN),
            np.zeros(HIDDEN, np.float32),
            draw(HIDDEN, GATES),
            draw(HIDDEN, GATES),
            draw(GATES, 1)[:, 0],
            draw(HIDDEN, 1)[:, 0],
            np.zeros(1, np.float32),
        ]

    def forward(self, x: np.ndarray, place: np.ndarray) -> tuple:
        """Probability of each document; ``place`` is the document of each passage, in order."""
        encode, shift, value, gate, weigh, out, bias = self.parts
        first = np.flatnonzero(np.diff(place, prepend=-1))
        h = np.tanh(x @ encode + shift)
        a, b = np.tanh(h @ value), _logistic(h @ gate)
        raw = (a * b) @ weigh
        raw = np.exp(raw - np.maximum.reduceat(raw, first)[place])
        attention = raw / np.add.reduceat(raw, first)[place]
        bag = np.add.reduceat(attention[:, None] * h, first, axis=0)
        return _logistic(bag @ out + bias[0]), (first, h, a, b, attention, bag)

    def slopes(self, x: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """The slope of the mean log loss for each of ``parts``."""
        _, _, value, gate, weigh, out, _ = self.parts
        p, (first, h, a, b, attention, bag) = self.forward(x, place)
        wrong = ((p - wanted) / len(p)).astype(np.float32)
        to_bag = wrong[:, None] * out
        to_attention = (h * to_bag[place]).sum(axis=1)
        mean = np.add.reduceat(attention * to_attention, first)
        to_raw = attention * (to_attention - mean[place])
        to_a = to_raw[:, None] * weigh * b * (1 - a * a)
        to_b = to_raw[:, None] * weigh * a * b * (1 - b)
        to_h = (attention[:, None] * to_bag[place] + to_a @ value.T + to_b @ gate.T) * (1 - h * h)
        return [
            x.T @ to_h,
            to_h.sum(axis=0),
            h.T @ to_a,
            h.T @ to_b,
            (a * b).T @ to_raw,
            bag.T @ wrong,
            np.array([wrong.sum()]),
        ]


def fit(held: list[bytes], quality: np.ndarray) -> Network:
    """Adam on batches of documents; without rows of both kinds the scorer gives their share (or 1)."""
    network = Network()
    if not len(held) or quality.min() == quality.max():
        network.parts[5] = np.zeros(HIDDEN, np.float32)
        network.parts[6] = np.array([8.0 if not len(held) or quality.min() == 1 else -8.0], np.float32)
        return network
    bags = []
    for start in range(0, len(held), 32):
        x, place = passages(Texts.of(held[start : start + 32]))
        bags += np.split(x, np.flatnonzero(np.diff(place)) + 1)
    rng = np.random.default_rng(5)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parts]
    step = 0
    for epoch in range(_EPOCHS):
        rate = _RATE * (1 - epoch / _EPOCHS)
        order = rng.permutation(len(bags))
        for start in range(0, len(order), _BATCH):
            chosen = order[start : start + _BATCH]
            place = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
            found = network.slopes(np.concatenate([bags[i] for i in chosen]), place, quality[chosen])
            step += 1
            for at, slope in enumerate(found):
                mean, square = moments[at]
                slope = slope + _DECAY * network.parts[at]
                mean += 0.1 * (slope - mean)
                square += 0.001 * (slope * slope - square)
                network.parts[at] = network.parts[at] - (
                    rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
    return network


def train(documents: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS, held_out: int = 0, folds: int = 5) -> Network:
    """The network of at most ``most`` labelled rows outside the held-out fold, fitted in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(*[column.to_pylist() for column in batch.columns])
        rows = sorted(rows)[:most]
        network = fit([text.encode() for _, text, _ in rows], np.array([q for _, _, q in rows], dtype=np.float32))
        blobs = [part.astype("<f4").tobytes() for part in network.parts]
        yield pa.RecordBatch.from_arrays([pa.array([blobs], pa.list_(pa.binary()))], ["parts"])

    sample = labelled_sample(documents, labels, most, fold(F.col("doc_id"), folds) != held_out)
    row = sample.repartition(1).mapInArrow(run, "parts array<binary>").first()
    if row is None:
        return fit([], np.zeros(0))
    network = Network()
    network.parts = [np.frombuffer(blob, dtype="<f4").reshape(part.shape) for blob, part in zip(row.parts, network.parts)]
    return network


def score(documents: DataFrame, network: Network, *more: Column) -> DataFrame:
    """``doc_id``, the given columns and ``score`` (0 to 1) of each whole text.

    Null and empty texts are one empty passage. Repeated rows score alike; no rows give none.
    """
    rows = texts(documents, *more)
    names = [name for name in rows.columns if name != "text"]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    sent = documents.sparkSession.sparkContext.broadcast(network.parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network()
        network.parts = sent.value
        for batch, held in slices(batches, most=_SLICE):
            x, place = passages(Texts.of(held))
            found, _ = network.forward(x, place)
            own = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays([*own, pa.array(found.astype(float))], [*names, "score"])

    return rows.mapInArrow(run, f"{kept}, score double")
