"""Units of texts: what a process remembers of them, and where texts are cut."""

import os
import random

import public_tokenizers

from vaultline.llm import sentencepiece_tokens, units

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_a_unit_in_every_text_is_learned_once_whatever_else_is_forgotten(monkeypatch):
    monkeypatch.setattr(units, "MOST_UNITS", 40)
    codec, asked = sentencepiece_tokens.Codec(PIECES, 1), []
    plain = codec.encoder.ids_of
    codec.encoder.ids_of = lambda parts: asked.extend(parts) or plain(parts)
    rng = random.Random(5)
    for _ in range(30):
        codec.encode(["the " + "".join(rng.choices("abcdefgh", k=9))])
    assert sum(part.count("▁the") for part in asked) == 1
    assert len(codec.encoder.known) + len(codec.encoder.aside) <= 60


def test_units_are_cut_at_no_character_of_a_text():
    codec = sentencepiece_tokens.Codec(PIECES, 1)
    texts = ["\x01", "", "a\x01\x00b  c\n\n d", "\x01\x00\x00 \x01", " ", "\x00\x01\x01\x00\x00\x00\x00 x\n"]
    assert all(codec.agrees(text, ids) for text, ids in zip(texts, codec.encode(texts)))
    assert codec.encode([]) == [] and codec.encode(["", ""]) == [b"", b""]


def test_tasks_of_a_process_share_a_codec_until_the_file_changes(tmp_path):
    path = tmp_path / "a.model"
    path.write_bytes(open(PIECES, "rb").read())
    first = sentencepiece_tokens.codec_of(str(path), 1)
    assert sentencepiece_tokens.codec_of(str(path), 1) is first
    os.utime(path, (1, 1))
    assert sentencepiece_tokens.codec_of(str(path), 1) is not first
