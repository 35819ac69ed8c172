"""Conversations of any known layout as canonical turns, and turns as template text.

The layout of a record is recognised by a fingerprint: the SHA-256 of its sorted nested field
paths. Fingerprints select declarative mappings (``LAYOUTS``), each a list of turns given by paths
into the record. A frame with one schema is recognised as a whole; JSON records, which may differ
from row to row, are recognised row by row.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Turn:
    """One turn of a record: its role and the field with its text. A missing optional text gives no turn."""

    role: str
    text: str
    optional: bool = False


@dataclass(frozen=True)
class Layout:
    """Field paths that identify a layout and how to read its turns.

    Either ``turns`` (flat fields), or ``each`` with the paths of role and text in its elements,
    or ``row`` with the columns of turn number, role and text (one row for each turn).
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[Turn, ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    row: tuple[str, str, str] | None = None


LAYOUTS = (
    Layout("turn rows", ("role", "text", "turn"), row=("turn", "role", "text")),
    Layout("messages", ("messages[].content", "messages[].role"), each="messages", role="role", text="content"),
    Layout("exchanges", ("conversations[].from", "conversations[].value"), each="conversations", role="from", text="value"),
    Layout("prompt", ("completion", "prompt"), (Turn("user", "prompt"), Turn("assistant", "completion"))),
    Layout("prompt and response", ("prompt", "response"), (Turn("user", "prompt"), Turn("assistant", "response"))),
    Layout(
        "instruction",
        ("input", "instruction", "output"),
        (Turn("user", "instruction"), Turn("user", "input", optional=True), Turn("assistant", "output")),
    ),
    Layout("short instruction", ("instruction", "output"), (Turn("user", "instruction"), Turn("assistant", "output"))),
    Layout(
        "system prompt",
        ("completion", "prompt", "system"),
        (Turn("system", "system", optional=True), Turn("user", "prompt"), Turn("assistant", "completion")),
    ),
)

#: Names that layouts use for the three roles; others stay as they are.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}

_NO_ORDER = "array<struct<role:string,text:string>>"


def fingerprint_of(paths: list[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """The nested field paths of a type; ``[]`` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        return [path for f in kind.fields for path in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def _roles(role: Column) -> Column:
    pairs = [F.lit(x) for pair in ROLES.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.lower(role)), role, F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(_roles(role).cast("string").alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _each(elements: Column, layout: Layout) -> Column:
    return F.transform(elements, lambda x: _turn(x[layout.role], x[layout.text]))


def _layout(kind: T.StructType, key: str, layouts: tuple[Layout, ...]) -> Layout:
    """The layout whose paths all occur; the longest if several do, and an exact fingerprint before all."""
    paths = [p for p in field_paths(kind) if p != key]
    exact = {fingerprint_of(layout.paths): layout for layout in layouts}
    if found := exact.get(fingerprint_of(paths)):
        return found
    fitting = [layout for layout in layouts if set(layout.paths) <= set(paths)]
    if not fitting:
        raise ValueError(f"no layout has the fields {sorted(paths)}; fingerprint {fingerprint_of(paths)}")
    return max(fitting, key=lambda layout: len(layout.paths))


def canonical_turns(records: DataFrame, key: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``key``, ``turn`` long, ``role``, ``text`` for each turn of records that share one schema.

    Fields that no layout names are ignored if the named ones are there. Null texts are empty,
    null roles too. Repeated rows are repeated turns. An unknown schema raises.
    """
    layout = _layout(records.schema, key, layouts)
    if layout.row:
        turn, role, text = layout.row
        one = _turn(F.col(role), F.col(text))
        return records.select(F.col(key), F.col(turn).cast("long").alias("turn"), one.alias("one")).select(
            key, "turn", "one.role", "one.text"
        )
    if layout.each:
        turns = _each(F.col(layout.each), layout)
    else:
        turns = F.array_compact(
            F.array(
                *[
                    F.when(F.coalesce(F.col(t.text), F.lit("")) != "", _turn(F.lit(t.role), F.col(t.text)))
                    if t.optional
                    else _turn(F.lit(t.role), F.col(t.text))
                    for t in layout.turns
                ]
            )
        )
    return _numbered(records.select(F.col(key), turns.alias("turns")), key)


def _numbered(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, F.posexplode("turns").alias("turn", "one")).select(
        key, F.col("turn").cast("long").alias("turn"), "one.role", "one.text"
    )


def record_fingerprint(record: Column) -> Column:
    """The fingerprint of the field paths of one JSON text; null if it isn't JSON.

    The type of a JSON value lists its fields in order of name, so only the types of the leaves
    have to go: ``OBJECT<a: ARRAY<OBJECT<b: STRING>>>`` becomes ``{a:[{b}]}``.
    """
    shape = F.schema_of_variant(F.try_parse_json(record))
    for pattern, put in (
        ("OBJECT<", "{"),
        ("ARRAY<", "["),
        (r": (?![\[{])[A-Z][A-Z0-9_]*(\(\d+,\d+\))?", ""),
        (": ", ":"),
    ):
        shape = F.regexp_replace(shape, pattern, put)
    return F.sha2(shape, 256)


def _json_shape(layout: Layout) -> str:
    """The text that ``record_fingerprint`` hashes for a layout (its ``>`` close both brackets)."""
    if layout.each:
        return f"{{{layout.each}:[{{{', '.join(sorted((layout.role, layout.text)))}>>>"
    return f"{{{', '.join(sorted(layout.paths))}>"


def canonical_json(
    records: DataFrame, key: str, record: str, layouts: tuple[Layout, ...] = LAYOUTS
) -> tuple[DataFrame, DataFrame]:
    """Turns of JSON records of any of the layouts, and the records that have none.

    The first frame is as from ``canonical_turns``; the second has ``key``, the record and its
    ``fingerprint`` (null for what isn't JSON), so nothing is lost without a trace.
    """
    marked = records.select(F.col(key), F.col(record), record_fingerprint(F.col(record)).alias("fingerprint"))
    chosen = F.lit(None).cast(_NO_ORDER)
    known = []
    for layout in layouts:
        if layout.row:
            continue
        print_ = hashlib.sha256(_json_shape(layout).encode()).hexdigest()
        known.append(print_)
        if layout.each:
            shape = f"struct<{layout.each}:array<struct<`{layout.role}`:string,`{layout.text}`:string>>>"
            parsed = F.from_json(F.col(record), shape)
            turns = _each(parsed[layout.each], layout)
        else:
            parsed = F.from_json(F.col(record), "struct<" + ",".join(f"`{p}`:string" for p in layout.paths) + ">")
            turns = F.array_compact(
                F.array(
                    *[
                        F.when(F.coalesce(parsed[t.text], F.lit("")) != "", _turn(F.lit(t.role), parsed[t.text]))
                        if t.optional
                        else _turn(F.lit(t.role), parsed[t.text])
                        for t in layout.turns
                    ]
                )
            )
        chosen = F.when(F.col("fingerprint") == print_, turns).otherwise(chosen)
    fits = F.coalesce(F.col("fingerprint").isin(known), F.lit(False))
    return _numbered(marked.where(fits).select(key, chosen.alias("turns")), key), marked.where(~fits)


@dataclass(frozen=True)
class Template:
    """Control strings around a turn: ``open role head text close``.

    No control string may be the beginning or end of another's inside, so that they never overlap.
    """

    open: str = "<s>"
    head: str = "[INST]"
    tail: str = "[/INST]"
    close: str = "</s>"
    learned: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.head, self.tail, self.close)


    def escape(self, text: Column) -> Column:
        """One backslash more behind the first character of every control string, escaped or not."""
        return F.regexp_replace(text, self._inside(r"(\\*)"), r"$1\\")

    def _inside(self, middle: str) -> str:
        firsts = "".join(re.escape(c) for c in sorted({c[0] for c in self.controls}))
        rests = "|".join(re.escape(c[1:]) for c in self.controls)
        return f"(?<=[{firsts}]){middle}(?=(?:{rests}))"

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._inside(r"(\\*)\\"), "$1")

    def turn(self, role: Column, text: Column) -> Column:
        return F.concat(
            F.lit(self.open), self.escape(role), F.lit(self.head), self.escape(text), F.lit(self.tail + self.close)
        )

    def read(self, formatted: Column) -> Column:
        """The turns of a formatted text, as ``array<struct<role, text>>``."""
        o, h, t, c = (re.escape(x) for x in self.controls)
        pattern = F.lit(f"(?s){o}(.*?){h}(.*?){t}{c}")
        return F.transform(
            F.arrays_zip(
                F.regexp_extract_all(formatted, pattern, F.lit(1)).alias("role"),
                F.regexp_extract_all(formatted, pattern, F.lit(2)).alias("text"),
            ),
            lambda x: F.struct(self.unescape(x["role"]).alias("role"), self.unescape(x["text"]).alias("text")),
        )


def format_turns(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """The turns with ``formatted``, and the learned part of it: ``loss_start`` (code points), ``loss_length``.

    Each turn is formatted by itself, so a conversation of any length needs no one place.
    ``loss_length`` is zero for turns that aren't learned.
    """
    learned = F.col("role").isin(*template.learned)
    before = F.length(F.lit(template.open + template.head)) + F.length(template.escape(F.col("role")))
    return turns.select(
        "*",
        template.turn(F.col("role"), F.col("text")).alias("formatted"),
        before.cast("long").alias("loss_start"),
        F.when(learned, F.length(template.escape(F.col("text")))).otherwise(0).cast("long").alias("loss_length"),
    )


def conversations_text(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row for each conversation: ``formatted`` and its learned ``spans`` (start, length; code points).

    Turns come in order of turn, then role and text, so ties have one order. Only for consumers
    that need a conversation in one piece; its size is that of the conversation.
    """
    row = F.struct("turn", "role", "text", "formatted", "loss_start", "loss_length", F.length("formatted").alias("size"))
    gathered = formatted.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda state, x: F.struct(
            (state["at"] + x["size"]).alias("at"),
            F.when(
                x["loss_length"] > 0,
                F.concat(
                    state["spans"],
                    F.array(F.struct((state["at"] + x["loss_start"]).alias("start"), x["loss_length"].alias("length"))),
                ),
            )
            .otherwise(state["spans"])
            .alias("spans"),
        ),
        lambda state: state["spans"],
    )
    return gathered.select(
        key, F.array_join(F.transform("turns", lambda x: x["formatted"]), "").alias("formatted"), spans.alias("spans")
    )
