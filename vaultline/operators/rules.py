"""Kinds of data-quality rule.

A rule says when a row breaks it, what the quarantine shall say, and at which stage.
Rules read the columns that ``curation.parsed`` adds for each raw column ``x``:

``raw_x``  the text as read           ``text_x``  the same, stripped
``num_x``  as double                  ``key_x``   as bigint
``time_x`` as timestamp without zone
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from vaultline.functions.columns import (
    capitalise,
    is_blank,
    number_text,
    shown,
    time_text,
)

SCHEMA = "Schema Integrity"
PRIMARY_KEY = "Primary Key Constraint"
REFERENCE = "Referential Integrity"
DOMAIN = "Domain Boundary Check"
FORMAT = "Format Validation"
CHRONOLOGY = "Chronological Logic"
RECONCILIATION = "Accounting Reconciliation"

IS_DUPLICATE = "is_duplicate_key"


def is_orphan_name(column: str) -> str:
    return f"is_orphan_{column}"


@dataclass(frozen=True)
class Rule:
    """One check. ``broken`` and ``reason`` are built lazily, when a session exists."""

    name: str
    stage: str
    columns: tuple[str, ...]
    broken: object
    reason: object

    def broken_column(self) -> Column:
        return F.coalesce(self.broken(), F.lit(False))

    def reason_column(self) -> Column:
        reason = self.reason
        return F.lit(reason) if isinstance(reason, str) else reason()


def _num(column: str) -> Column:
    return F.col(f"num_{column}")


def _text(column: str) -> Column:
    return F.col(f"text_{column}")


def _time(column: str) -> Column:
    return F.col(f"time_{column}")


def _any(conditions) -> Column:
    return reduce(or_, conditions)


def _with(template: str, *values) -> object:
    """A reason whose ``{}`` slots are filled from columns."""
    if not values:
        return template
    parts = template.split("{}")

    def build() -> Column:
        pieces = [F.lit(parts[0])]
        for value, after in zip(values, parts[1:]):
            pieces += [value(), F.lit(after)]
        return F.concat(*pieces)

    return build


def missing_key(key: str, entity: str) -> Rule:
    return Rule("missing_key", SCHEMA, (key,), lambda: is_blank(_text(key)), f"Missing {entity} ID")


def non_numeric_key(key: str, entity: str) -> Rule:
    """A key that cannot become a number is rejected here, so standardising never fails on it."""
    return Rule(
        "non_numeric_key",
        SCHEMA,
        (key,),
        lambda: ~is_blank(_text(key)) & F.col(f"key_{key}").isNull(),
        f"Non-numeric {entity} ID",
    )


def duplicate_key(key: str, entity: str) -> Rule:
    return Rule("duplicate_key", PRIMARY_KEY, (key,), lambda: F.col(IS_DUPLICATE), f"Duplicate {entity} ID")


def orphan_key(column: str, entity: str, parent: str) -> Rule:
    def value() -> Column:
        return F.coalesce(F.col(f"key_{column}").cast("string"), number_text(_num(column)))

    return Rule(
        f"orphan_key:{column}",
        REFERENCE,
        (column,),
        lambda: F.col(is_orphan_name(column)),
        _with(f"{entity} ID {{}} not found in Curated {parent}", value),
    )


def not_in_domain(column: str, domain: tuple[str, ...], reason: str, as_status: bool = False) -> Rule:
    allowed = [value.upper() for value in domain]
    show = (lambda: capitalise(shown(_text(column)))) if as_status else (lambda: shown(_text(column)))
    return Rule(
        f"not_in_domain:{column}",
        DOMAIN,
        (column,),
        lambda: _text(column).isNull() | ~F.upper(_text(column)).isin(allowed),
        _with(reason, show),
    )


def out_of_range(
    column: str, reason: str, above: float | None = None, low: float | None = None, high: float | None = None
) -> Rule:
    """Missing, not above ``above``, below ``low`` or over ``high``."""

    def broken() -> Column:
        number, conditions = _num(column), [_num(column).isNull()]
        if above is not None:
            conditions.append(number <= above)
        if low is not None:
            conditions.append(number < low)
        if high is not None:
            conditions.append(number > high)
        return _any(conditions)

    values = [lambda: number_text(_num(column))] if "{}" in reason else []
    return Rule(f"out_of_range:{column}", DOMAIN, (column,), broken, _with(reason, *values))


def bad_date(*columns: str, reason: str) -> Rule:
    values = [lambda: shown(F.col(f"raw_{columns[0]}"))] if "{}" in reason else []
    return Rule(
        "bad_date:" + ",".join(columns),
        FORMAT,
        columns,
        lambda: _any([_time(c).isNull() for c in columns]),
        _with(reason, *values),
    )


def blank(*columns: str, reason: str) -> Rule:
    return Rule(
        "blank:" + ",".join(columns), DOMAIN, columns, lambda: _any([is_blank(_text(c)) for c in columns]), reason
    )


def pattern_mismatch(column: str, pattern: str, reason: str) -> Rule:
    return Rule(
        f"pattern_mismatch:{column}",
        FORMAT,
        (column,),
        lambda: _text(column).isNull() | ~_text(column).rlike(pattern),
        reason,
    )


def not_binary(column: str, reason: str) -> Rule:
    return Rule(
        f"not_binary:{column}",
        DOMAIN,
        (column,),
        lambda: _num(column).isNull() | ~_num(column).isin(0.0, 1.0),
        _with(reason, lambda: shown(F.col(f"raw_{column}"))),
    )


def date_before(late: str, early: str, reason: str) -> Rule:
    """Both dates parse and the one that must be later is earlier."""
    return Rule(
        f"date_before:{late},{early}",
        CHRONOLOGY,
        (late, early),
        lambda: _time(late) < _time(early),
        _with(reason, lambda: time_text(_time(late)), lambda: time_text(_time(early))),
    )


def components_unbalanced(total: str, parts: tuple[str, str], tolerance: float, reason: str) -> Rule:
    def broken() -> Column:
        first, second = (_num(p) for p in parts)
        off = F.coalesce(F.abs(first + second - _num(total)) > tolerance, F.lit(False))
        return _any([first.isNull(), second.isNull(), first < 0, second < 0, off])

    return Rule(f"components_unbalanced:{total}", RECONCILIATION, (total, *parts), broken, reason)
