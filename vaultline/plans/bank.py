"""The curated tables and marts of one bank, as named DataFrames."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

from vaultline.operators.tables import TABLES
from vaultline.plans import marts


class Bank:
    """Gives tables and marts by name. Each mart is computed once, through ``materialise``.

    ``table`` gives a curated table; ``materialise`` stores a frame under a name and returns it
    as a scan of what was stored. Without one, marts stay lazy plans. ``given`` are tables or marts that are there already.
    """

    def __init__(
        self,
        table: Callable[[str], DataFrame],
        materialise: Callable[[DataFrame, str], DataFrame] | None = None,
        given: Mapping[str, DataFrame] | None = None,
    ):
        self._table = table
        self._materialise = materialise or (lambda frame, _: frame)
        self._known: dict[str, DataFrame] = dict(given or {})
        self._lock = threading.RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._known:
                if name in TABLES:
                    self._known[name] = self._table(name)
                else:
                    self._known[name] = self._materialise(marts.MARTS[name](self), name)
            return self._known[name]

    def tables(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in TABLES}

    def register_views(self) -> None:
        """Make every table and mart available to ``spark.sql`` under its own name."""
        for name in (*TABLES, *marts.PUBLIC_MARTS):
            self[name].createOrReplaceTempView(name)
