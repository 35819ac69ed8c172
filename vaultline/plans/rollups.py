"""Monthly rollups of the facts, kept between runs.

Facts are stored by month. A rollup's months add up to all that the marts need of a fact, and each depends on that month's rows
alone. So a refresh compares, month by month, which write of the fact it has seen last, and rolls up only the
months that were written since; the marts are then computed from rollups, a small part of the facts' size.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.functions.columns import month_of
from vaultline.operators.tables import TABLES
from vaultline.plans import marts
from vaultline.plans.bank import Bank
from vaultline.sources.buckets import BUCKET, Buckets, distinct_buckets

NO_MONTH = "none"
#: The facts, the date each is stored by, and the rollup that is made of it.
FACTS = {"transactions": "txn_date", "card_transactions": "txn_date"}
ROLLUPS: Mapping[str, tuple[str, Callable[[Mapping[str, DataFrame]], DataFrame]]] = {
    "account_month": ("transactions", marts.account_month),
    "card_month": ("card_transactions", marts.card_month),
}


class MonthlyFacts:
    """Curated facts below one root folder, in months."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Buckets(spark, root)

    def replace_months(self, name: str, rows: DataFrame) -> list[str]:
        """Replace the months that occur in ``rows``, and no other; which ones."""
        month = F.coalesce(month_of(F.col(FACTS[name])), F.lit(NO_MONTH))
        rows = rows.select(*TABLES[name].columns).withColumn(BUCKET, month)
        change, months = self.store.begin(), distinct_buckets(rows)
        try:
            self.store.replace(change, name, rows, months)
            self.store.commit(change)
        except BaseException:
            self.store.discard(change)
            raise
        return months

    def rows(self, name: str, months=None, stored: dict | None = None) -> DataFrame:
        stored = self.store.record()["stored"] if stored is None else stored
        return self.store.read(stored, name, TABLES[name].schema, months, T.StringType()).select(*TABLES[name].columns)


class Rollups:
    """The rollups of ``facts``, below one root folder."""

    def __init__(self, spark: SparkSession, root: str, facts: MonthlyFacts):
        self.store, self.facts = Buckets(spark, root), facts

    def refresh(self) -> dict[str, list[str]]:
        """Bring the rollups up to the facts' current months; which months were rolled up."""
        source = self.facts.store.record()["stored"]
        change = self.store.begin()
        seen = {name: dict(months) for name, months in change.record.get("seen", {}).items()}
        done = {}
        try:
            for name, (fact, roll_up) in ROLLUPS.items():
                now, before = source.get(fact, {}), seen.get(name, {})
                months = sorted(m for m in now.keys() | before.keys() if now.get(m) != before.get(m))
                if months:
                    frame = roll_up({fact: self.facts.rows(fact, months, source)})
                    frame = frame.withColumn(BUCKET, F.coalesce("month_year", F.lit(NO_MONTH)))
                    self.store.replace(change, name, frame, months)
                    seen[name], done[name] = dict(now), months
            if done:
                self.store.commit(change, seen=seen, columns={**change.record.get("columns", {}), **self._columns(done)})
        except BaseException:
            self.store.discard(change)
            raise
        return done

    def _columns(self, names) -> dict[str, str]:
        """The schemas of rollups, as they are written."""
        found = {}
        for name in names:
            fact, roll_up = ROLLUPS[name]
            found[name] = roll_up({fact: self.facts.rows(fact, [], {})}).schema.json()
        return found

    def bank(self, table: Callable[[str], DataFrame], materialise=None) -> Bank:
        """A bank whose marts are computed from these rollups; ``table`` gives its other tables."""
        record = self.store.record()
        stored, columns = record["stored"], record.get("columns", {})
        given = {}
        for name in ROLLUPS:
            if name not in columns:
                raise FileNotFoundError(f"no {name} below {self.store.root}: refresh first")
            schema = T.StructType.fromJson(json.loads(columns[name]))
            given[name] = self.store.read(stored, name, schema, kind=T.StringType()).select(*schema.names)
        return Bank(table, materialise, given)
