"""Token ids of whole texts from the ids of their units, each distinct unit encoded once.

A unit ends at a place where the tokenizer can never join what stands left and right; so a
text's ids are its units' ids in a row. A process remembers the units it has met lately. A unit that is new
is cut further where that is safe, so that ``word`` and ``word.`` share the work, and new units go
to the tokenizer many at a time as one text, whose ids are dealt out again at the marks that
begin units. Texts are cut, and their ids put together, as Arrow columns, so that only distinct units become objects.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterable
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units that a process remembers. When half as many are new they are set aside, and those set aside before are forgotten.
MOST_UNITS = 800_000
#: Longer units are encoded but not remembered.
LONGEST_UNIT = 64
_TOGETHER = 256

class Encoder:
    """``encode`` gives each text's ids as little-endian unsigned 32-bit bytes.

    ``apart`` puts a given text between the units of a text. ``begins`` says of each id whether it can only begin a unit that starts with ``mark``.
    """

    def __init__(
        self,
        ids_of: Callable[[list[str]], list[list[int]]],
        apart: Callable[[str, str], str],
        cut: Callable[[str], list[str]],
        mark: str,
        begins: np.ndarray,
    ):
        self.ids_of, self.apart, self.cut, self.mark, self.begins = ids_of, apart, cut, mark, begins
        self.known: dict[str, bytes] = {"": b""}
        self.aside: dict[str, bytes] = {}

    def _recall(self, units: Iterable[str]) -> set[str]:
        """Those units that are new; the ids of units set aside are taken up again."""
        known, aside = self.known, self.aside
        missing = set(filterfalse(known.__contains__, units))
        again = set(filter(aside.__contains__, missing))
        known.update((unit, aside[unit]) for unit in again)
        return missing - again

    def _learn(self, parts: list[str], into: dict[str, bytes]) -> None:
        """The ids of units that are new."""
        mark = self.mark
        plain = [x for x in parts if x[:1] == mark and len(x) <= LONGEST_UNIT and x[1:].isalpha()]
        for start in range(0, len(plain), _TOGETHER * 64):
            groups = [plain[at : at + _TOGETHER] for at in range(start, min(start + _TOGETHER * 64, len(plain)), _TOGETHER)]
            for group, ids in zip(groups, self.ids_of(["".join(group) for group in groups])):
                data = array("I", ids).tobytes()
                at = (np.flatnonzero(self.begins[ids]) * 4).tolist()
                if len(at) == len(group) and at[0] == 0:
                    for unit, a, b in zip(group, at, [*at[1:], len(data)]):
                        into[unit] = data[a:b]
        rest = [x for x in parts if x not in into]
        for start in range(0, len(rest), 10_000):
            part = rest[start : start + 10_000]
            for unit, ids in zip(part, self.ids_of(part)):
                into[unit] = array("I", ids).tobytes()

    def _units(self, texts: list[str]) -> pa.LargeListArray:
        """The units of each text; empty ones may stand among them."""
        border = "\x01"
        while any(border in text for text in texts):  # it overlaps neither itself nor what stands beside it
            border += "\x00" * len(border)
        return pc.split_pattern(pa.array([self.apart(text, border) for text in texts], pa.large_string()), border)

    def _ids_of(self, units: list[str]) -> list[bytes]:
        """The ids of distinct units, from memory or learned."""
        known, missing = self.known, self._recall(units)
        if missing:
            learned: dict[str, bytes] = {}
            cuts = {unit: parts for unit in missing if len(parts := self.cut(unit)) > 1}
            whole = missing.difference(cuts)
            whole |= self._recall(part for parts in cuts.values() for part in parts)
            self._learn(list(whole), learned)
            known.update(learned)
            for unit, parts in cuts.items():
                known[unit] = b"".join([known[part] for part in parts])
        found = list(map(known.__getitem__, units))
        for unit in missing:
            if len(unit) > LONGEST_UNIT:
                del known[unit]
        if len(known) > MOST_UNITS // 2:
            self.known, self.aside = {"": b""}, known
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        split = self._units(texts)
        distinct = split.flatten().dictionary_encode()
        ids = pa.array(self._ids_of(distinct.dictionary.to_pylist()), pa.large_binary()).take(distinct.indices)
        _, ends, data = ids.buffers()
        if data is None:
            return [b""] * len(texts)
        borders = np.frombuffer(ends, dtype="<i8")[: len(ids) + 1][split.offsets.to_numpy()].tolist()
        held = memoryview(data)
        return [bytes(held[a:b]) for a, b in zip(borders, borders[1:])]
