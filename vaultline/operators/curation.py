"""Validation and standardising of one table: one lazy plan, one scan of the rows, one write."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.functions import columns as C
from vaultline.operators import rules as R
from vaultline.operators.keys import ROW_ID, KeySet, find_duplicates, mark_members, mark_orphans
from vaultline.operators.tables import ROUNDED, Field, Table
from vaultline.sources.scratch import keep

AUDIT_COLUMNS = ("rejection_reason", "validation_stage", "pipeline_name", "processed_at")
IS_BAD = "is_bad"
VIOLATIONS = "violations"
KEY_TEXT = "_key_text"

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("rejection_reason", T.StringType()),
        T.StructField("validation_stage", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
VIOLATIONS_TYPE = T.ArrayType(
    T.StructType([T.StructField("rule", T.StringType()), T.StructField("stage", T.StringType())])
)


def _cells(raw: DataFrame, table: Table) -> DataFrame:
    """The raw cells as text, and the row id."""
    needed = {table.key, *(c for rule in table.rules for c in rule.columns)}
    absent = sorted(needed - set(raw.columns))
    if absent:
        raise ValueError(f"{table.name}: raw columns missing: {', '.join(absent)}")
    present = set(raw.columns)
    return raw.select(
        *[
            (F.col(f.name).cast("string") if f.name in present else F.lit(None).cast("string")).alias(f"raw_{f.name}")
            for f in table.fields
        ],
        (F.col(ROW_ID) if ROW_ID in present else F.monotonically_increasing_id()).alias(ROW_ID),
    )


def _with_readings(frame: DataFrame, table: Table, fields: Iterable[Field], at_once: bool = False) -> DataFrame:
    """Add the stripped, numeric, key and time readings of fields, where they aren't there already.

    ``at_once`` does it in one projection: where a plan is too long for whole-stage code, every further one copies
    the whole row. A plan that a shuffle cuts in two is short enough, and is compiled if the readings come step by step.
    """
    present, steps = set(frame.columns), {}
    for step, name, value in (reading for f in fields for reading in _read_as(f, table, at_once)):
        if name not in present:
            steps.setdefault(0 if at_once else step, {})[name] = value
    for step in sorted(steps):
        frame = frame.withColumns(steps[step])
    return frame


def parsed(raw: DataFrame, table: Table) -> DataFrame:
    """Raw text columns plus their stripped, numeric, key and time readings."""
    return _with_readings(_cells(raw, table), table, table.fields)


def keyed(raw: DataFrame, table: Table, at_once: bool = True) -> DataFrame:
    """Raw text columns and no more than the readings that key probes need, for these may be shuffled."""
    names = {table.key, *(p.column for p in table.validated_parents)}
    cells = _cells(raw, table)
    frame = _with_readings(cells, table, [f for f in table.fields if f.name in names], at_once)
    keys = [f"key_{f.name}" for f in table.fields if f.name in names]
    return frame.select(*cells.columns, *keys, F.col(f"text_{table.key}").alias(KEY_TEXT))


def _read_as(f: Field, table: Table, at_once: bool):
    """``(step, name, value)`` of each reading; step by step, a reading refers to the columns of those before it."""
    text = C.strip(F.col(f"raw_{f.name}"))
    yield 0, f"text_{f.name}", text
    text = text if at_once else F.col(f"text_{f.name}")
    if f.kind in ("key", "number"):
        number = C.parse_number(text)
        yield 1, f"num_{f.name}", number
        number = number if at_once else F.col(f"num_{f.name}")
    if f.kind == "key":
        probed = any(p.column == f.name for p in table.validated_parents)
        yield 2, f"key_{f.name}", C.parse_reference(text, number) if probed else C.parse_key(text, number)
    elif f.kind == "date" and at_once:
        yield 2, f"time_{f.name}", C.in_time_span(C.parse_time(text))
    elif f.kind == "date":
        yield 2, f"time_{f.name}", C.parse_time(text)
        yield 3, f"time_{f.name}", C.in_time_span(F.col(f"time_{f.name}"))


def _account_type(text: Column) -> Column:
    return F.when(F.upper(text) == "NRI", "NRI").otherwise(C.title_words(text))


_TEXT_FORMS = {
    "strip": lambda text: text,
    "title": C.title_case,
    "title_words": C.title_words,
    "capitalise": C.capitalise,
    "upper": F.upper,
    "lower": F.lower,
    "account_type": _account_type,
}


def standard_value(f: Field) -> Column:
    """The curated value of a column, from its parsed reading. Text that is missing stays NULL."""
    if f.kind == "key":
        return F.col(f"key_{f.name}")
    if f.kind == "date":
        return F.to_date(f"time_{f.name}")
    if f.kind == "number":
        number = F.col(f"num_{f.name}")
        if isinstance(f.type, T.DecimalType):
            return (C.half_even(number) if f.clean == ROUNDED else number).try_cast(f.type)
        return number.try_cast(f.type)
    if f.clean == "raw":
        return F.col(f"raw_{f.name}")
    return _TEXT_FORMS[f.clean](F.col(f"text_{f.name}"))


def standardise(frame: DataFrame, table: Table) -> DataFrame:
    """Curated columns of parsed rows, whether or not the rows are valid."""
    return frame.select(*[standard_value(f).alias(f.name) for f in table.fields])


def probe_keys(frame: DataFrame, table: Table, parents: dict[str, KeySet], source: DataFrame) -> DataFrame:
    """Add the duplicate flag of the key and the orphan flag of every validated foreign key.

    Values are counted in ``source``, which has the same keys as the frame.
    """
    key, text = f"key_{table.key}", KEY_TEXT
    duplicates = find_duplicates(source, key, text)
    frame = mark_members(frame, key, duplicates.numeric, "_repeats_number", source)
    frame = mark_members(frame, text, duplicates.textual, "_repeats_text", source)
    missing = C.is_blank(F.col(text)) & F.lit(duplicates.missing)
    frame = frame.withColumn(
        R.IS_DUPLICATE,
        F.col("_repeats_number") | (F.col(key).isNull() & F.col("_repeats_text")) | missing,
    ).drop("_repeats_number", "_repeats_text", text)
    for parent in table.validated_parents:
        flag = R.is_orphan_name(parent.column)
        frame = mark_orphans(frame, f"key_{parent.column}", parents[parent.table], flag, source)
    return frame


def _apart(frame: DataFrame, table: Table) -> DataFrame:
    """The flags of the key probes, by a projection with a lambda, which Spark leaves out of whole-stage code.

    The lookups below it are then compiled by themselves, and so is what is made of a row above. As one they are too long,
    none of it is compiled as a whole, and each lookup copies the row.
    """
    flags = (R.IS_DUPLICATE, *(R.is_orphan_name(p.column) for p in table.validated_parents))
    return frame.withColumns({name: F.exists(F.array(name), lambda flag: flag) for name in flags})


HUGE_METHODS = "spark.sql.codegen.hugeMethodLimit"


def _compile_wide_rows(spark: SparkSession) -> None:
    """HotSpot interprets methods over 8000 bytes, and a table's rules in one method are longer.

    A session that leaves the limit at 64 KB gets 8000 and keeps it, for the rows are judged when the caller reads them.
    """
    if int(spark.conf.get(HUGE_METHODS)) == 65535:
        spark.conf.set(HUGE_METHODS, "8000")


def _broken_name(position: int) -> str:
    return f"broken_{position}"


def judged(raw: DataFrame, table: Table, parents: dict[str, KeySet]) -> DataFrame:
    """Parsed rows with one boolean column per rule and ``is_bad``, their disjunction.

    Keys are probed first and the other columns parsed afterwards: a shuffle, if one is needed, carries raw text only.
    """
    _compile_wide_rows(raw.sparkSession)
    stay = all(parents[p.table].stays() for p in table.validated_parents)  # else rows may be shuffled
    source = keyed(raw, table)
    frame = probe_keys(source if stay else keyed(raw, table, at_once=False), table, parents, source)
    frame = _with_readings(_apart(frame, table) if stay else frame, table, table.fields, at_once=stay)
    broken = {_broken_name(i): rule.broken_column() for i, rule in enumerate(table.rules)}
    if stay:
        return frame.withColumns({**broken, IS_BAD: reduce(or_, broken.values())})
    return frame.withColumns(broken).withColumn(IS_BAD, reduce(or_, map(F.col, broken)))


def _reasons(table: Table) -> Column:
    return F.concat_ws(
        "; ", *[F.when(F.col(_broken_name(i)), rule.reason_column()) for i, rule in enumerate(table.rules)]
    )


def _stages(table: Table) -> Column:
    """Each stage once, where its first broken rule stands."""
    pieces, earlier = [], {}
    for i, rule in enumerate(table.rules):
        first = F.col(_broken_name(i))
        for before in earlier.get(rule.stage, []):
            first = first & ~F.col(_broken_name(before))
        pieces.append(F.when(first, rule.stage))
        earlier.setdefault(rule.stage, []).append(i)
    return F.concat_ws("; ", *pieces)


def _violations(table: Table) -> Column:
    return F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(_broken_name(i)),
                    F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.stage).alias("stage")),
                )
                for i, rule in enumerate(table.rules)
            ]
        )
    )


def run_time() -> datetime:
    return datetime.now(timezone.utc).replace(microsecond=0)


def validated(
    raw: DataFrame, table: Table, parents: dict[str, KeySet], run_at: datetime | None = None, keep_raw: bool = False
) -> DataFrame:
    """Every raw row once, either curated or quarantined.

    Good rows fill the curated columns, bad rows the ``raw_`` and audit columns; the other side
    is NULL, which costs next to nothing in a columnar file. One write partitioned by
    ``is_bad`` then stores both results from a single execution of the plan. With ``keep_raw`` good rows
    keep their raw columns too, so that they can be judged again.
    """
    frame, bad = judged(raw, table, parents), F.col(IS_BAD)
    stamp = F.lit((run_at or run_time()).strftime("%Y-%m-%d %H:%M:%S+00:00")).cast("timestamp")
    return frame.select(
        *[F.when(~bad, standard_value(f)).alias(f.name) for f in table.fields],
        *[F.col(f"raw_{f.name}") if keep_raw else F.when(bad, F.col(f"raw_{f.name}")).alias(f"raw_{f.name}") for f in table.fields],
        F.when(bad, _reasons(table)).alias("rejection_reason"),
        F.when(bad, _stages(table)).alias("validation_stage"),
        F.when(bad, F.lit(f"process_{table.name}")).alias("pipeline_name"),
        F.when(bad, stamp).alias("processed_at"),
        F.when(bad, _violations(table)).alias(VIOLATIONS),
        bad.alias(IS_BAD),
    )


def stored_schema(table: Table) -> T.StructType:
    """The schema of a stored table: curated, raw and audit columns, and the partition column."""
    return T.StructType(
        [
            *table.schema.fields,
            *[T.StructField(f"raw_{f.name}", T.StringType()) for f in table.fields],
            *AUDIT_SCHEMA.fields,
            T.StructField(VIOLATIONS, VIOLATIONS_TYPE),
            T.StructField(IS_BAD, T.BooleanType()),
        ]
    )


def good_rows(rows: DataFrame, table: Table) -> DataFrame:
    return rows.where(~F.col(IS_BAD)).select(*table.columns)


def bad_rows(rows: DataFrame, table: Table) -> DataFrame:
    return rows.where(IS_BAD).select(
        *[F.col(f"raw_{name}").alias(name) for name in table.columns], *AUDIT_COLUMNS
    )


def split(rows: DataFrame, table: Table) -> tuple[DataFrame, DataFrame]:
    """The curated rows and the quarantine rows, exact complements of each other."""
    return good_rows(rows, table), bad_rows(rows, table)


def validate(
    raw: DataFrame, table: Table, parents: dict[str, KeySet] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Curated rows and quarantine rows of one raw table.

    The verdicts are computed once and kept partitioned by ``is_bad``; each result then reads
    its own files. Filtering the lazy plan twice would evaluate every rule four times.
    """
    return split(keep(validated(raw, table, parents or {}), "validated", IS_BAD), table)


def quarantine_schema(table: Table) -> T.StructType:
    return T.StructType([*table.raw_schema.fields, *AUDIT_SCHEMA.fields])
