"""Quality verdicts by logistic regression on hashed word and character n-grams.

A text's features are the relative frequencies of its hashed words, word pairs and character
n-grams, each family in its own table. So the score of a text is the mean weight of its n-grams
in each family, found in one pass over the whole text in Arrow batches. The weights are fitted on a
bounded sample of labelled rows, their scores calibrated (Platt) on rows left out of the fit, and
texts are judged against fixed thresholds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import slices, texts
from vaultline.llm.ngrams import Texts, mixed

#: At most so many labelled rows are used to fit and calibrate, those whose ids hash lowest.
SAMPLE_ROWS = 4_000
#: One row in so many calibrates instead of fitting.
CALIBRATE = 4
BITS = 15
CHARACTERS = 4
#: Kept from this calibrated probability of good quality on.
KEEP_FROM = 0.2
#: Fixed thresholds of the plain rules.
LEAST_WORDS, REPEAT_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
_STEPS, _RATE, _DECAY, _SCALE = 150, 0.1, 1e-5, 30.0
_SLICE = 2 << 20


def families(texts_: Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """For words, word pairs and character n-grams: buckets, and the text of each."""
    words = texts_.word_hashes()
    shift = np.uint64(64 - BITS)
    with np.errstate(over="ignore"):
        pairs = mixed(words[:-1] * np.uint64(31) + words[1:])
    same = texts_.word_text[:-1] == texts_.word_text[1:]
    grams = texts_.character_hashes(CHARACTERS) >> np.uint32(32 - BITS)
    place = np.searchsorted(texts_.stops, np.arange(len(grams)))
    whole = np.arange(len(grams)) + CHARACTERS <= texts_.stops[np.minimum(place, len(texts_.stops) - 1)]
    return [
        ((words >> shift).astype(np.int64), texts_.word_text),
        ((pairs[same] >> shift).astype(np.int64), texts_.word_text[:-1][same]),
        (grams[whole].astype(np.int64), place[whole]),
    ]


@dataclass
class Classifier:
    """Weights by family and bucket, bias, and the calibration's slope and shift."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, texts_: Texts) -> np.ndarray:
        total = np.full(len(texts_.starts), self.bias)
        for table, (buckets, place) in zip(self.weights, families(texts_)):
            size = np.bincount(place, minlength=len(total))
            total += np.bincount(place, weights=table[buckets], minlength=len(total)) * _SCALE / np.maximum(size, 1)
        return total

    def probability(self, texts_: Texts) -> np.ndarray:
        return _logistic(self.slope * self.raw(texts_) + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _sparse(held: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the texts' features."""
    rows, columns, values = [], [], []
    for start in range(0, len(held), 64):
        part = Texts.of(held[start : start + 64])
        for at, (buckets, place) in enumerate(families(part)):
            keys, times = np.unique((place << BITS) + buckets, return_counts=True)
            row = keys >> BITS
            rows.append((row + start).astype(np.int32))
            columns.append(((at << BITS) + (keys & ((1 << BITS) - 1))).astype(np.int32))
            values.append((times * _SCALE / np.bincount(place, minlength=64)[row]).astype(np.float32))
    return np.concatenate(rows), np.concatenate(columns), np.concatenate(values)


def platt(scores: np.ndarray, wanted: np.ndarray) -> tuple[float, float]:
    """Slope and shift that make scores probabilities, by Newton steps with smoothed targets."""
    good, bad = wanted.sum(), (1 - wanted).sum()
    target = np.where(wanted > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([scores, np.ones_like(scores)], axis=1)
    start = np.array([1.0, 0.0])
    loss = lambda at: (np.logaddexp(0, x @ at) - target * (x @ at)).sum() + 5e-4 * ((at - start) ** 2).sum()
    line = start
    for _ in range(50):
        p = _logistic(x @ line)
        slope = x.T @ (target - p) - 1e-3 * (line - start)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        while loss(line + step) > loss(line) and np.abs(step).max() > 1e-9:  # a whole step may overshoot
            step = step / 2
        line = line + step
        if np.abs(step).max() < 1e-9:
            break
    return float(line[0]), float(line[1])


def fit(held: list[bytes], quality: np.ndarray) -> Classifier:
    """Full-batch logistic regression with Adam; every ``CALIBRATE``-th row only calibrates.

    Without rows of both kinds everything is of good quality: nothing is known against it.
    """
    tables = np.zeros((3, 1 << BITS))
    if not len(held) or quality.min() == quality.max():
        return Classifier(tables, shift=30.0)
    row, column, value = _sparse(held)
    fitted = np.arange(len(held)) % CALIBRATE != 0
    weights, bias = tables.ravel(), 0.0
    mean, square = np.zeros(weights.size + 1), np.zeros(weights.size + 1)
    for step in range(1, _STEPS + 1):
        score = np.bincount(row, weights=weights[column] * value, minlength=len(held)) + bias
        wrong = np.where(fitted, _logistic(score) - quality, 0) / max(1, fitted.sum())
        slope = np.bincount(column, weights=wrong[row] * value, minlength=weights.size) + _DECAY * weights
        slope = np.append(slope, wrong.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope * slope
        move = _RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights = weights - move[:-1]
        bias -= move[-1]
    score = np.bincount(row, weights=weights[column] * value, minlength=len(held)) + bias
    kept = ~fitted if 0 < quality[~fitted].sum() < (~fitted).sum() else np.ones(len(held), dtype=bool)
    slope, shift = platt(score[kept], quality[kept])
    return Classifier(weights.reshape(3, -1), float(bias), slope, shift)


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int, where: Column | None = None) -> DataFrame:
    """``text`` and ``quality`` of at most ``most`` labelled documents, in order of hashed id.

    The sample is drawn from the labels alone, so that only ``most`` ids have to meet documents.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null")
    if where is not None:
        known = known.where(where)
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return texts(documents).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "quality")


def train(documents: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> Classifier:
    """The classifier of at most ``most`` labelled rows, fitted in one task of that bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            rows += zip(*[column.to_pylist() for column in batch.columns])
        rows = sorted(rows)[:most]
        found = fit([text.encode() for _, text, _ in rows], np.array([q for _, _, q in rows], dtype=float))
        numbers = np.array([found.bias, found.slope, found.shift])
        yield pa.RecordBatch.from_arrays(
            [pa.array([found.weights.tobytes()], pa.binary()), pa.array([numbers.tobytes()], pa.binary())],
            ["weights", "numbers"],
        )

    row = (
        labelled_sample(documents, labels, most)
        .repartition(1)
        .mapInArrow(run, "weights binary, numbers binary")
        .first()
    )
    if row is None:
        return fit([], np.zeros(0))
    numbers = np.frombuffer(row.numbers)
    return Classifier(np.frombuffer(row.weights).reshape(3, -1), *map(float, numbers))


def _flagged(texts_: Texts, hashes: np.ndarray) -> np.ndarray:
    """Places of words whose window has an equal hash elsewhere in the same text."""
    none = np.zeros(0, dtype=np.int64)
    count = len(hashes) - WINDOW + 1
    if count < 1:
        return none
    with np.errstate(over="ignore"):
        keys = texts_.word_text[:count].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for at in range(WINDOW):
            keys = mixed(keys * np.uint64(31) + hashes[at : at + count])
    inside = np.flatnonzero(texts_.word_text[:count] == texts_.word_text[WINDOW - 1 :])
    keys = keys[inside]
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return none
    found = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return inside[twice[found] == keys]


def repeated_words(texts_: Texts, hashes: np.ndarray) -> np.ndarray:
    """Whether each word is in a window found twice or more in its text.

    Windows are compared by hash first; those with an equal are compared by their words.
    """
    covered = np.zeros(len(hashes), dtype=bool)
    data = texts_.buffer.tobytes()
    starts, stops = texts_.word_starts, texts_.word_stops
    places: dict[tuple, list[int]] = {}
    for at in _flagged(texts_, hashes).tolist():
        window = tuple(data[starts[i] : stops[i]] for i in range(at, at + WINDOW))
        places.setdefault((texts_.word_text[at], window), []).append(at)
    for ats in places.values():
        if len(ats) > 1:
            for at in ats:
                covered[at : at + WINDOW] = True
    return covered


_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, probability double"
)


def judge(documents: DataFrame, classifier: Classifier, *more: Column, keep_from: float = KEEP_FROM) -> DataFrame:
    """``doc_id``, the given columns, the plain counts, ``base_failed``, ``kept`` and ``probability`` of each text.

    ``kept`` needs the plain rules (enough words, few repeated ones) and the classifier's calibrated
    probability. Null and empty texts have no words and fail. Repeated rows are judged alike; no
    rows give none.
    """
    rows = texts(documents, *more)
    names = [name for name in rows.columns if name != "text"]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    results = [part.split()[0] for part in _RESULT.split(", ")]
    numbers = (classifier.bias, classifier.slope, classifier.shift)
    sent = documents.sparkSession.sparkContext.broadcast(classifier.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(sent.value, *numbers)
        for batch, held in slices(batches, most=_SLICE):
            texts_ = Texts.of(held)
            words = texts_.word_counts()
            letters = ~texts_.space & ((texts_.buffer & 0xC0) != 0x80)
            lines = [[line for line in text.split(b"\n") if line.strip()] for text in held]
            covered = repeated_words(texts_, texts_.word_hashes())
            repeated = np.bincount(texts_.word_text[covered], minlength=len(held))
            failed = (words < LEAST_WORDS) | (100 * repeated > REPEAT_PERCENT * words)
            probability = model.probability(texts_)
            values = [
                words,
                texts_.per_text(letters.astype(np.int64)),
                texts_.per_text(_SYMBOL[texts_.buffer].astype(np.int64)),
                np.array([len(x) - len(set(x)) for x in lines], dtype=np.int64),
                repeated,
                failed,
                ~failed & (probability >= keep_from),
                probability,
            ]
            own = [batch.column(batch.schema.get_field_index(name)) for name in names]
            yield pa.RecordBatch.from_arrays([*own, *[pa.array(v) for v in values]], [*names, *results])

    return rows.mapInArrow(run, f"{kept}, {_RESULT}")
