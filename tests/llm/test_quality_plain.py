"""Scores of the two quality models against plain versions, text by text and value by value."""

import math
from collections import Counter

import numpy as np

from vaultline.llm import attention_quality, ngram_quality
from vaultline.llm.ngrams import Texts

M64 = (1 << 64) - 1
TEXTS = [
    "",
    "one",
    "The QUICK brown fox! The QUICK brown fox! The QUICK brown fox! jumps",
    "ünïcode wörds 東京 and\nlines\n\nof text, a;b:c {d}",
    " ".join(f"w{i % 50}" for i in range(400)),
    "   \t\n ",
    "x" * 700 + " tail",
]


def mixed(x):
    x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & M64
    return x ^ (x >> 29)


def word_hash(word):
    total, power = 0, 1
    for byte in word:
        total = (total + (byte + 1) * power) & M64
        power = power * 0x100000001B3 & M64
    return mixed(total)


def gram_hash(data):
    out = 0
    for byte in data:
        out = (out * 257 + byte) & 0xFFFFFFFF
    out = out * 0x9E3779B1 & 0xFFFFFFFF
    return out ^ (out >> 15)


def words_of(text):
    return text.encode().split()


def plain_ngram_score(model, text):
    data, words = text.encode(), [word_hash(w) for w in words_of(text)]
    families = [
        [w >> (64 - ngram_quality.BITS) for w in words],
        [mixed((a * 31 + b) & M64) >> (64 - ngram_quality.BITS) for a, b in zip(words, words[1:])],
        [gram_hash(data[i : i + 4]) >> (32 - ngram_quality.BITS) for i in range(len(data) - 3)],
    ]
    raw = model.bias
    for table, buckets in zip(model.weights, families):
        if buckets:
            raw += ngram_quality._SCALE * sum(table[b] for b in buckets) / len(buckets)
    return 1 / (1 + math.exp(-max(-35, min(35, model.slope * raw + model.shift))))


def test_ngram_probabilities():
    rng = np.random.default_rng(1)
    model = ngram_quality.Classifier(rng.normal(size=(3, 1 << ngram_quality.BITS)) / 10, 0.3, 1.2, -0.1)
    got = model.probability(Texts.of([t.encode() for t in TEXTS]))
    assert np.allclose(got, [plain_ngram_score(model, t) for t in TEXTS], rtol=1e-9)


def plain_passages(text):
    """The features of each passage of one text."""
    data, words = text.encode(), words_of(text)
    starts, at = [], 0
    for word in words:
        at = data.index(word, at)
        starts.append(at)
        at += len(word)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            again |= set(range(i, i + 5))
    size = attention_quality.PASSAGE_WORDS
    rows = []
    for first in range(0, max(1, len(words)), size):
        part = words[first : first + size]
        begin = starts[first] if part else 0
        # the line break behind a text is read with it
        end = starts[first + size] if first + size < len(words) else len(data) + 1
        behind = (data + b"\n")[begin:end] if part else b""
        padded = data + b"\n" + b"\0" * 3
        counts = [Counter(word_hash(w) % 128 for w in part),
                  Counter(gram_hash(padded[i : i + 3]) % 256 for i in range(begin, end) if part and padded[i] not in b" \t\n\x0b\x0c\r")]
        row = []
        for counter, many in zip(counts, (128, 256)):
            total = max(1, sum(counter.values()))
            row += [3 * math.sqrt(counter[b] / total) for b in range(many)]
        length = max(1, len(behind))
        symbols = sum(0x21 <= c < 0x30 or 0x3A <= c < 0x41 or 0x5B <= c < 0x61 or 0x7B <= c < 0x7F for c in behind)
        shares = [sum(first <= i < first + size for i in again) / max(1, len(part)), sum(65 <= c <= 90 for c in behind) / length,
                  symbols / length, behind.count(b"\n") / length]
        rows.append(row + [3 * x for x in shares])
    return rows


def plain_attention_score(parts, text):
    encode, shift, value, gate, weigh, out, bias = [np.asarray(p, dtype=float) for p in parts]
    logistic = lambda x: 1 / (1 + math.exp(-x))
    encoded, raw = [], []
    for row in plain_passages(text):
        h = [math.tanh(sum(x * encode[i][j] for i, x in enumerate(row) if x) + shift[j]) for j in range(len(shift))]
        gated = [
            math.tanh(sum(h[j] * value[j][k] for j in range(len(h)))) * logistic(sum(h[j] * gate[j][k] for j in range(len(h))))
            for k in range(value.shape[1])
        ]
        encoded.append(h)
        raw.append(math.exp(sum(g * w for g, w in zip(gated, weigh))))
    bag = [sum(r * h[j] for r, h in zip(raw, encoded)) / sum(raw) for j in range(len(shift))]
    return logistic(sum(b * o for b, o in zip(bag, out)) + bias[0])


def test_attention_scores(spark):
    network, rng = attention_quality.Network(), np.random.default_rng(2)
    network.parts = [(p + rng.normal(size=p.shape) / 3).astype(np.float32) for p in network.parts]
    # each text alone: the last bytes of a text in a longer buffer run into the next one's first
    want = [plain_attention_score(network.parts, t) for t in TEXTS]
    for text, score in zip(TEXTS, want):
        x, place = attention_quality.passages(Texts.of([text.encode()]))
        assert np.allclose(x, plain_passages(text), atol=1e-5), text[:20]
        assert abs(network.forward(x, place)[0][0] - score) < 1e-4
    documents = spark.createDataFrame([(len(TEXTS) - 3, TEXTS[4])], "doc_id long, text string")
    assert abs(attention_quality.score(documents, network).first()["score"] - want[4]) < 1e-4
