"""Unigram model files, long pieces, and parity that is found broken where it is broken."""

import math
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from vaultline.llm import lattice, sentencepiece_tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def field(number, kind, value):
    head = bytes([number << 3 | kind]) if number < 16 else bytes([(number << 3 | kind) & 127 | 128, number >> 4])
    return head + (b"" if kind != 2 else bytes([len(value) & 127 | 128, len(value) >> 7])) + value


def unigram_file(path, own, normaliser=b""):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)], *own]
    data = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([k]))) for p, s, k in pieces)
    path.write_bytes(data + field(2, 2, field(3, 0, b"\1") + field(35, 0, b"\1")) + field(3, 2, normaliser))
    return str(path)


OWN = [("▁", -3.0, 1), ("a", -2.5, 1), ("b", -2.6, 1), ("ab", -3.1, 1), ("▁ab", -3.3, 1), ("ba", -4.5, 1), ("a" * 20, -5.0, 1)]


@pytest.mark.parametrize("normaliser", [b"", field(4, 0, b"\0"), field(3, 0, b"\0")])
def test_a_model_that_agrees_is_said_to(tmp_path, normaliser):
    path = unigram_file(tmp_path / "m.model", OWN, normaliser)
    codec, library, rng = sentencepiece_tokens.Codec(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(4)
    texts = ["".join(rng.choice("ab  é\n") for _ in range(rng.randint(0, 14))) for _ in range(400)] + ["a" * 45]
    ids = codec.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == library.encode(texts)
    assert all(codec.agrees(text, x) for text, x in zip(texts, ids))


def test_a_lost_merge_is_found_where_it_matters(monkeypatch):
    real = sentencepiece_tokens.Model.merges
    monkeypatch.setattr(sentencepiece_tokens.Model, "merges", lambda self: [m for m in real(self) if "".join(m) != "▁nation"])
    codec, library = sentencepiece_tokens.Codec(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["one nation here", "words of all kinds stand here", "nation", "a (nation) b", ""]
    ids = codec.encode(texts)
    differ = [np.frombuffer(x, "<u4").tolist() != library.encode(text) for text, x in zip(texts, ids)]
    assert differ[0] and differ[2] and not differ[1]
    assert [codec.agrees(text, x) for text, x in zip(texts, ids)] == [not d for d in differ]


def test_whole_texts_are_compared_too(monkeypatch):
    monkeypatch.setattr(sentencepiece_tokens, "SHARE", 1)
    codec = sentencepiece_tokens.Codec(PIECES)
    (ids,) = codec.encode(["a text"])
    assert codec.agrees("a text", ids) and not codec.agrees("a text", ids[:-4])


def test_every_text_is_compared_whole():
    codec = sentencepiece_tokens.Codec(PIECES)
    real, codec.normal = codec.normal, lambda text: real(text.replace("K", "k"))
    texts = [f"Kind {n} words" for n in range(200)] + ["kind words"]
    assert [codec.agrees(text, x) for text, x in zip(texts, codec.encode(texts))] == [False] * 200 + [True]


def test_scores_of_the_file_weigh_segmentations(tmp_path):
    pieces, given = lattice.read_pieces(unigram_file(tmp_path / "m.model", OWN))
    assert dict(zip(pieces, given))["ba"] == -4.5 and dict(zip(pieces, given))["<0x41>"] == -15.0
    model = lattice.Lattice(*lattice.with_end(pieces, given))
    assert math.isclose(np.exp(model.scores).sum(), 1.0)
    assert math.isclose(model.scores[pieces.index("a")] - model.scores[pieces.index("ab")], 0.6, abs_tol=1e-6)
    weight = {p: math.exp(s) for p, s in zip(pieces, model.scores) if not p.startswith("<")}

    def total(text):
        return sum((w * total(text[len(p) :]) for p, w in weight.items() if text.startswith(p)), 0.0) if text else 1.0

    words = ["abba", "ab", "a" * 20, "a" * 21]  # the longest piece has twenty characters
    assert np.allclose(model.log_probability([w.encode() for w in words]), [math.log(total("▁" + w)) for w in words])
    assert lattice.read_pieces(PIECES)[1] is None


def test_fit_starts_from_the_files_scores(spark, tmp_path):
    pieces, given = lattice.read_pieces(unigram_file(tmp_path / "m.model", OWN))
    nothing = spark.createDataFrame([], "word binary, trained long, others long")
    assert np.allclose(lattice.fit(nothing, pieces, 0, given=given).scores, lattice.with_end(pieces, given)[1])
    assert np.allclose(lattice.fit(nothing, pieces, 0).scores, lattice.with_end(pieces, None)[1])
