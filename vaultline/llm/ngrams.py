"""Words and hashed n-grams of many whole texts at once, as numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x100000001B3
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    values = (values ^ (values >> np.uint64(33))) * _MIX
    return values ^ (values >> np.uint64(29))


@dataclass
class Texts:
    """Some texts in one buffer (a line break behind each) and their words."""

    buffer: np.ndarray
    starts: np.ndarray  # of texts
    stops: np.ndarray
    word_starts: np.ndarray
    word_stops: np.ndarray
    word_text: np.ndarray
    space: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Texts:
        sizes = np.array([len(text) + 1 for text in texts], dtype=np.int64)
        stops = np.cumsum(sizes) - 1
        starts = stops - sizes + 1
        buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        space = _SPACE[buffer]
        turns = np.flatnonzero(np.diff(space.astype(np.int8), prepend=1, append=1))
        word_starts, word_stops = turns[::2], turns[1::2]
        return cls(buffer, starts, stops, word_starts, word_stops, np.searchsorted(stops, word_starts), space)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.word_text, minlength=len(self.starts))

    def word_hashes(self) -> np.ndarray:
        """64 bits for each word; equal words have equal hashes."""
        size = len(self.buffer)
        sums = np.zeros(size + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum((self.buffer + np.uint64(1)) * _powers(_BASE, size), out=sums[1:])
            plain = (sums[self.word_stops] - sums[self.word_starts]) * _powers(_INVERSE, size)[self.word_starts]
            return mixed(plain)

    def character_hashes(self, length: int) -> np.ndarray:
        """32 bits for the bytes that start at each place of the buffer (shorter near its end)."""
        padded = np.concatenate([self.buffer, np.zeros(length, dtype=np.uint8)]).astype(np.uint32)
        out = np.zeros(len(self.buffer), dtype=np.uint32)
        with np.errstate(over="ignore"):
            for at in range(length):
                out = out * np.uint32(257) + padded[at : at + len(out)]
            out = out * np.uint32(0x9E3779B1)
        return out ^ (out >> np.uint32(15))

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """The sum of values at places of the buffer, for each text."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.stops] - sums[self.starts]
