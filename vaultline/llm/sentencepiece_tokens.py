"""SentencePiece models on the tokenizers library.

The model file is a protocol buffer; its pieces, scores and normaliser settings are read from
the wire format and rebuilt as a tokenizers model: unigram scores, or for a model of merges
the merges that its scores order, with byte fallback. The white-space marker is put in before
texts are cut into units, each distinct unit that a process remembers is encoded once, in batches on several
threads. Parity is verified on every text as a whole: the sentencepiece library encodes it too, which shows a wrong
piece as well as a wrong normaliser or cut.
"""

from __future__ import annotations

import gc
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vaultline.llm.common import slices, texts
from vaultline.llm.units import LONGEST_UNIT, MOST_UNITS, Encoder

MARK = "▁"
#: Of so many texts one is encoded whole by the library too: each of them.
SHARE = 1
#: Texts that the library encodes in one call.
TOGETHER = 256
#: Fixed values of the file format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2


def wire(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = number()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    prefix: bool = True
    squeeze: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls()
        for number, value in wire(data):
            if number == 1:
                piece = dict(wire(value))
                score = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
                model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(wire(value))
                model.kind = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                spec = dict(wire(value))
                model.charsmap = spec.get(2, b"")
                model.prefix, model.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        return model

    @property
    def unknown(self) -> int:
        return next(at for at, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)

    @cached_property
    def separable(self) -> bool:
        """Whether no piece has the marker behind another character."""
        return not any(MARK in piece.lstrip(MARK) for piece, _, kind in self.pieces if kind in (NORMAL, USER))

    def merges(self) -> list[tuple[str, str]]:
        """All ways to put a piece together from two, the best scores first."""
        scores = {piece: score for piece, score, kind in self.pieces if kind in (NORMAL, USER)}
        found = []
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in scores and right in scores:
                    found.append((-score, left, right))
        found.sort(key=lambda row: row[0])
        return [(left, right) for _, left, right in found]

    def backend(self):
        """A tokenizers model with a decoder, for text that is normalised and marked."""
        from tokenizers import Tokenizer, decoders, models

        if self.kind == MERGES:
            vocabulary = {piece: at for at, (piece, _, _) in enumerate(self.pieces)}
            model = models.BPE(
                vocab=vocabulary,
                merges=self.merges(),
                unk_token=self.pieces[self.unknown][0],
                fuse_unk=True,
                byte_fallback=self.byte_fallback,
            )
        elif self.kind == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown, self.byte_fallback)
        else:
            raise ValueError(f"models of kind {self.kind} are not read")
        backend = Tokenizer(model)
        backend.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        return backend

    def normaliser(self):
        """The text as the model's lattice sees it: mapped, squeezed, with its prefix, marked."""
        mapped = None
        if self.charsmap:
            from tokenizers import normalizers

            mapped = normalizers.Precompiled(self.charsmap)

        def normal(text: str) -> str:
            if mapped:
                text = mapped.normalize_str(text)
            if self.squeeze:
                text = " ".join(x for x in text.split(" ") if x)
            if text and self.prefix:
                text = " " + text
            return text.replace(" ", MARK)

        return normal

    @cached_property
    def joined(self) -> set[str]:
        """All pairs of neighbouring characters in pieces. Between others no piece ever reaches."""
        return {p[i : i + 2] for p, _, kind in self.pieces if kind in (NORMAL, USER) for i in range(len(p) - 1)}

    @cached_property
    def lines(self) -> bool:
        """Whether line breaks stand in no piece."""
        return not any("\n" in piece for piece, _, kind in self.pieces if kind in (NORMAL, USER))

    def apart(self, text: str, border: str) -> str:
        """A normalised text with a border before runs of the marker, and before line breaks."""
        if not self.separable:
            return text
        if MARK * 2 in text:
            text = re.sub(f"(?<=[^{MARK}])(?={MARK})", border, text)
        else:
            text = text.replace(MARK, border + MARK)
        return text.replace("\n", border + "\n") if self.lines else text

    def cut(self, unit: str) -> list[str]:
        """A unit cut wherever two characters stand together in no piece."""
        joined = self.joined
        if len(unit) > LONGEST_UNIT or joined.issuperset(map(add, unit, unit[1:])):
            return [unit]
        places = [i for i in range(1, len(unit)) if unit[i - 1 : i + 1] not in joined]
        return [unit[a:b] for a, b in zip([0, *places], [*places, len(unit)])]


class Codec:
    """Encode and decode lists of texts, and compare with the library."""

    def __init__(self, model_file: str, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        import sentencepiece

        with open(model_file, "rb") as file:
            data = file.read()
        self.model = Model.parse(data)
        self.normal, self.backend = self.model.normaliser(), self.model.backend()
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.starts = np.array([piece.startswith(MARK) for piece, _, _ in self.model.pieces])
        self.encoder = Encoder(self._ids, self.model.apart, self.model.cut, MARK, self.starts & self.model.separable)
        self.said: dict[bytes, str] = {}
        self.bytes_of = [
            bytes([int(piece[3:5], 16)]) if kind == BYTE else piece.replace(MARK, " ").encode() if kind in (NORMAL, USER) else None
            for piece, _, kind in self.model.pieces
        ]

    def _ids(self, units: list[str]) -> list[list[int]]:
        return [x.ids for x in self.backend.encode_batch_fast(units, add_special_tokens=False)]

    def encode(self, held: list[str]) -> list[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit bytes."""
        return self.encoder.encode([self.normal(text) for text in held])

    def agrees(self, text: str, ids: bytes) -> bool:
        """Whether the library gives the same ids for the whole text."""
        return self.all_agree([text], [ids])[0]

    def all_agree(self, held: list[str], ids: list[bytes]) -> list[bool]:
        """The same of each text; the library takes some hundred at a time."""
        out = []
        for at in range(0, len(held), TOGETHER):
            said = self.library.encode(held[at : at + TOGETHER], num_threads=1)
            out += [np.frombuffer(x, dtype="<u4").tolist() == y for x, y in zip(ids[at : at + TOGETHER], said)]
        return out

    def decode(self, held: list[bytes]) -> list[str]:
        """The texts of ids; the prefix is taken off again.

        Ids whose bytes are no text, and ids of control or unknown pieces, go to the backend's decoder.
        """
        out, bytes_of = [], self.bytes_of
        for ids in held:
            try:
                text = b"".join([bytes_of[at] for at in memoryview(ids).cast("I")]).decode()
            except (TypeError, UnicodeDecodeError):
                out += self._decode_by_backend([ids])
                continue
            out.append(text[1:] if self.model.prefix and text.startswith(" ") else text)
        return out

    def _decode_by_backend(self, held: list[bytes]) -> list[str]:
        said, split = self.said, []
        for ids in held:
            values = np.frombuffer(ids, dtype="<u4")
            borders = (np.flatnonzero(self.starts[values]) * 4).tolist()
            if not borders or borders[0]:
                borders = [0, *borders]
            split.append([ids[a:b] for a, b in zip(borders, [*borders[1:], len(ids)])])
        missing = list({unit for units in split for unit in units if unit not in said})
        for start in range(0, len(missing), 20_000):
            part = missing[start : start + 20_000]
            texts_ = self.backend.decode_batch([np.frombuffer(x, dtype="<u4").tolist() for x in part], False)
            said.update(zip(part, texts_))
        out = ["".join(map(said.__getitem__, units)) for units in split]
        if len(said) > MOST_UNITS or sum(len(x) > 4 * LONGEST_UNIT for x in missing) > 1_000:
            self.said = {}
        return [text[1:] if self.model.prefix and text.startswith(" ") else text for text in out]


@lru_cache(maxsize=1)
def _codec_of(model_file: str, written: int, size: int, threads: int) -> Codec:
    return Codec(model_file, threads)


def codec_of(model_file: str, threads: int) -> Codec:
    """A process's codec for a file as it is now: later tasks go on with the units that earlier ones have met."""
    state = os.stat(model_file)
    return _codec_of(model_file, state.st_mtime_ns, state.st_size, threads)


_TOKENS = "doc_id long, n_tokens long, ids binary, round_trip boolean, agrees boolean"


def encode(documents: DataFrame, model_file: str, threads: int = 2) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32 bits), ``round_trip``, ``agrees`` of each text.

    ``round_trip``: decoding gives the text back, as the model normalises it. ``agrees``: the
    sentencepiece library gives the same ids. Null and empty texts have no ids and pass both.
    Rows are kept as they are, repeated ones too; no rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_file, threads)
        for batch, held in slices(batches):
            gc.disable()  # a run makes a million texts and lists, and no cycles to look for
            try:
                plain = [text.decode() for text in held]
                ids = codec.encode(plain)
                back = codec.decode(ids)
                same = [a == b or codec.normal(a) == codec.normal(b) for a, b in zip(plain, back)]
                agrees = codec.all_agree(plain, ids)
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(same),
                    pa.array(agrees),
                ],
                ["doc_id", "n_tokens", "ids", "round_trip", "agrees"],
            )

    return texts(documents).mapInArrow(run, _TOKENS)


def decode(tokens: DataFrame, model_file: str, threads: int = 2) -> DataFrame:
    """``doc_id`` and ``text`` from rows of ``doc_id`` and ``ids``; null ids are an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model_file, threads)
        for batch, held in slices(batches, "ids"):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codec.decode(held), pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
