"""Aligned tokens against a plain version: byte ranges compared pair by pair."""

import hashlib
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st

from vaultline.llm import alignment
from vaultline.llm.queries import groups_digest

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    "Plain words, twice. Plain words, twice.",
    "naïve café — 東京 🙂🙂 ﬁn",
    "a <|endoftext|> b </s> <s> <unk> <0x41>",
    "   spaces\t\tand\n\n\nlines   ",
    "▁ is the marker itself",
    "x" * 3000 + " 1234567890" * 50,
    "",
    None,
    "Plain words, twice. Plain words, twice.",
    "\x00\x01 control",
]


@given(st.sets(st.integers(1, 400), min_size=1), st.sets(st.integers(1, 400), min_size=1))
def test_gallop_finds_lower_bounds(short, long):
    short, long = sorted(short), sorted(long | {401})
    assert alignment.gallop(short, long) == [min(i for i, x in enumerate(long) if x >= end) for end in short]


def plain(texts):
    """Ids, groups and links of each text by comparing all byte ranges of the two libraries' tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    library = sentencepiece.SentencePieceProcessor(model_file=B)
    backend = Tokenizer.from_file(A)
    backend.encode_special_tokens = True
    letters = {c: b for b, c in _letters().items()}
    found = []
    for text in texts:
        text = text or ""
        a = backend.encode(" " + text, add_special_tokens=False).ids if text else []
        b = library.encode(text)
        bytes_a = [bytes(letters[c] for c in backend.id_to_token(i)) for i in a]
        pieces = [library.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
        if not text or b"".join(bytes_a) != b" " + text.encode() or b"".join(bytes_b) != b" " + text.encode():
            found.append(([], [], [], []))
            continue
        spans = []
        for tokens in (bytes_a, bytes_b):
            ends = np.cumsum([len(x) for x in tokens]).tolist()
            spans.append(list(zip([0, *ends], ends)))
        links = [(a[i], b[j]) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
        groups, i, j = [], 0, 0
        for end in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
            first_i, first_j = i, j
            while i < len(a) and spans[0][i][1] <= end:
                i += 1
            while j < len(b) and spans[1][j][1] <= end:
                j += 1
            groups.append((a[first_i:i], b[first_j:j]))
        found.append((a, b, groups, links))
    return found


def _letters():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + at) for at, b in enumerate(rest)}


def expected(texts):
    found = plain(texts)
    counts = Counter(pair for *_, links in found for pair in set(links))
    best = {}
    for (a, _), n in counts.items():
        best[a] = max(best.get(a, 0), n)
    rows = []
    for a, b, groups, links in found:
        said = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        rows.append((len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                     sum(counts[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else ""))
    return rows


@pytest.mark.parametrize("partitions", [1, 3])
def test_scores_equal_the_plain_version(spark, monkeypatch, partitions):
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 100)
    rows = [(i if i != 5 else None, text, "en", 7) for i, text in enumerate(TEXTS)] + [(0, TEXTS[0], "en", 7)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, block string, codes int").repartition(partitions)
    got = alignment.link_scores(documents, A, B, groups_digest).collect()
    want = expected([row[1] for row in rows])
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, *tuple(r)[1:]) for r in got) == sorted(
        (row[0] is None, row[0] or 0, *figures) for row, figures in zip(rows, want)
    )


def test_groups_are_real_output(spark):
    documents = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row, (a, b, groups, _) in zip(alignment.align(documents, A, B).orderBy("doc_id").collect(), plain(TEXTS)):
        assert (row["ids_a"], row["ids_b"]) == (a, b)
        assert list(zip(row["sizes_a"], row["sizes_b"])) == [(len(x), len(y)) for x, y in groups]


def test_both_ways_round_and_nothing():
    ids = np.arange(1, 5)
    for ends_a, ends_b in permutations([np.array([1, 2, 3, 6]), np.array([2, 6])]):
        x = alignment.Alignment(ids[: len(ends_a)], ids[: len(ends_b)], ends_a, ends_b)
        assert sorted(zip(x.at_a.tolist(), x.at_b.tolist())) == sorted(
            (i, j)
            for i in range(len(ends_a))
            for j in range(len(ends_b))
            if ([0, *ends_a][i] < ends_b[j]) and ([0, *ends_b][j] < ends_a[i])
        )
        assert len(x.sizes_a) == 2


def test_no_documents(spark):
    assert alignment.link_scores(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []
