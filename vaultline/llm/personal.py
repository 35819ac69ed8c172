"""Personal data by weak supervision, in DataFrame functions alone.

Plain patterns give the sure spans; wider patterns give candidates. Labelers vote on every span:
format, validity, a gazetteer, the words before it, and what it touches. Votes are counted by their
pattern (a table of bounded size). Expectation maximisation estimates how reliable each labeler is
and how likely each pattern is personal data, and these probabilities train a logistic classifier
of votes and kinds, which judges the candidates. Sure spans always stay.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import texts
from vaultline.sources.scratch import keep

KINDS = ("email", "ip", "card", "phone")

#: Written so that no position is tried twice within a run: possessive, and at a run's start or where
#: the last match ended. They match what ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+`` and the
#: like match, whatever the length of the text; runs of fewer digits than a card has, which the test
#: of cards would drop, are passed over at once.
SURE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])(?=(?:[0-9][ -]?){16})[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}

#: Candidates: spelled-out addresses, addresses of eight groups, shorter card numbers, local numbers.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}+"
    r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:.])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:.])",
    "card": r"(?<![0-9A-Za-z.-])(?:[0-9]{13,15}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z]|[.-][0-9])",
    "phone": r"(?<![0-9A-Za-z.+(-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])",
}
WIDE_NEEDS = {"email": r"[(\[{]at[)\]}]", "ip": r":[0-9A-Fa-f]{1,4}:", "card": "[0-9]{5}", "phone": "[0-9]{3}[ .-][0-9]{4}"}

#: Words whose presence shortly before a span speaks for or against it.
CUES = {
    "email": r"(?i)mail|contact|write|courriel|correo|schreib|kontakt",
    "ip": r"(?i)\bip\b|addr|host|server|client|login",
    "card": r"(?i)card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta",
    "phone": r"(?i)phone|tel|call|mobile|cell|fax|anruf|appel|llam|ruf",
}
AGAINST = r"(?i)version|isbn|order|invoice|serial|section|chapter|build|article|\bid\b|\bno\b\.?|#"
#: Gazetteers: endings of addresses, first digits of card issuers.
DOMAINS = ("com", "net", "org", "edu", "gov", "info", "io", "de", "fr", "es", "eu", "uk", "us")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65|62)"
#: Characters before a span that are read for cue words.
BEFORE = 32
LABELERS = ("format", "valid", "gazetteer", "context", "border")

_SPAN = "array<struct<kind:int,start:bigint,stop:bigint,match:string>>"


#: A text is cut into parts of so many characters, so that places in it are reached without counting from its start.
PART = 1024


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it, in lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan(rows: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """What ``step`` gives for each row, in order; it takes a number (first 0) and a row, and gives the next
    number and an array (of type ``kind``) of what this row adds.

    Rows go in blocks of about the square root of their number, as adding to an array copies it.
    """
    none, zero = F.array().cast(kind), F.lit(0).cast("long")

    def blocks(rows: Column) -> Column:
        side = F.ceil(F.sqrt(F.size(rows))).cast("int")
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / side).cast("int")), lambda b: F.slice(rows, b * side + 1, side))

    def within(s: Column, row: Column) -> Column:
        at, more = step(s["at"], row)
        return F.struct(at.cast("long").alias("at"), F.concat(s["out"], more).alias("out"))

    def over(s: Column, block: Column) -> Column:
        done = F.aggregate(block, F.struct(s["at"].alias("at"), none.alias("out")), within)
        return _let(done, lambda r: F.struct(r["at"].alias("at"), F.concat(s["out"], F.array(r["out"])).alias("out")))

    start = F.struct(zero.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))
    return _let(
        rows, lambda r: F.when(F.size(r) == 0, none).otherwise(F.flatten(F.aggregate(blocks(r), start, over, lambda s: s["out"])))
    )


def _parts(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))


def _cut(parts: Column, start: Column, stop: Column) -> Column:
    """The characters from ``start`` to ``stop`` of a text in parts."""
    first = F.floor(start / PART).cast("int")
    near = F.array_join(F.slice(parts, first + 1, F.floor(stop / PART).cast("int") - first + 1), "")
    return F.substring(near, (start - first * PART + 1).cast("int"), (stop - start).cast("int"))


def _all(text: Column, pattern: str, kind: int, needs: str | None) -> Column:
    """All matches with their places in code points, from the gaps between them."""
    none = F.array().cast(_SPAN)

    def step(at: Column, row: Column) -> tuple[Column, Column]:
        start = at + row["gap"]
        stop = start + F.length(row["match"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), stop.alias("stop"), row["match"].alias("match"))
        return stop, F.array(one)

    def placed(matches: Column) -> Column:
        gaps = F.slice(F.transform(F.split(text, pattern, -1), F.length), F.lit(1), F.size(matches))
        rows = F.zip_with(gaps, matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
        return F.when(F.size(matches) == 0, none).otherwise(_scan(rows, _SPAN, step))

    found = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)
    return found if needs is None else F.when(F.regexp_like(text, F.lit(needs)), found).otherwise(none)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _holds(span: Column) -> Column:
    """Whether a plain match passes its kind's test."""
    digits, match = _digits(span["match"]), span["match"]
    part = lambda x: F.regexp_replace(x, "^0+", "")
    octets = F.forall(F.split(match, "[.]"), lambda x: (F.length(part(x)) <= 3) & (F.lpad(F.substring(part(x), 1, 3), 3, "0").cast("int") <= 255))
    size = F.length(digits)
    return (
        F.when(span["kind"] == 0, F.lit(True))
        .when(span["kind"] == 1, octets)
        .when(span["kind"] == 2, size.between(16, 19) & F.call_function("luhn_check", digits))
        .otherwise(size.between(8, 15))
    )


def _votes(span: Column, parts: Column, sure: bool) -> Column:
    """One for, minus one against, zero for no opinion; in the order of ``LABELERS``."""
    digits, match, kind = _digits(span["match"]), span["match"], span["kind"]
    before = _cut(parts, F.greatest(span["start"] - BEFORE, F.lit(0)), span["start"])
    after = _cut(parts, span["stop"], span["stop"] + 1)
    cue = F.lit(False)
    for at, name in enumerate(KINDS):
        cue = F.when(kind == at, F.regexp_like(before, F.lit(CUES[name]))).otherwise(cue)
    size = F.length(digits)
    ending = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1))
    valid = (
        F.when(kind == 0, F.when(F.regexp_like(ending, F.lit("^[a-z]{2,}$")), 1).otherwise(-1))
        .when(kind == 1, F.lit(1))
        .when(kind == 2, F.when(F.call_function("luhn_check", digits), 1).otherwise(-1))
        .otherwise(F.when(size.between(10, 15), 1).otherwise(0))
    )
    gazetteer = (
        F.when(kind == 0, F.when(ending.isin(*DOMAINS), 1).otherwise(-1))
        .when(kind == 1, F.when(F.regexp_like(match, F.lit(r"^(?:0|127|255)\.")), -1).otherwise(0))
        .when(kind == 2, F.when(F.regexp_like(digits, F.lit(ISSUERS)), 1).otherwise(-1))
        .otherwise(F.when(F.regexp_like(match, F.lit(r"^\+?[0 ]*$|0000000")), -1).otherwise(0))
    )
    context = F.when(cue, 1).when(F.regexp_like(before, F.lit(AGAINST)), -1).otherwise(0)
    border = F.when(
        F.regexp_like(before, F.lit(r"[A-Za-z0-9_=/]$")) | F.regexp_like(after, F.lit("[A-Za-z0-9_=/]")), -1
    ).otherwise(1)
    return F.array(F.lit(1 if sure else -1), valid, gazetteer, context, border)


def spans_of(documents: DataFrame, *more: Column) -> DataFrame:
    """``doc_id``, the given columns, ``sure`` and ``wide`` spans with their votes, in order of kind and start.

    A span is ``kind`` (place in ``KINDS``), ``start``, ``stop`` (code points, end exclusive) and
    ``votes``. Wide spans that touch a sure one, or an earlier wide one, are left out.
    """
    text = F.col("text")
    rows = texts(documents, *more)
    sure = F.concat(*[F.filter(_all(text, SURE[k], at, _need(NEEDS.get(k))), _holds) for at, k in enumerate(KINDS)])
    wide = F.concat(*[_all(text, WIDE[k], at, WIDE_NEEDS[k]) for at, k in enumerate(KINDS)])
    names = [name for name in rows.columns if name not in ("doc_id", "text")]

    def voted(name: str, is_sure: bool) -> Column:
        one = lambda parts: lambda x: F.struct(
            x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), _votes(x, parts, is_sure).alias("votes")
        )
        none = F.array().cast("array<struct<kind:int,start:bigint,stop:bigint,votes:array<int>>>")
        return F.when(F.size(name) == 0, none).otherwise(_let(_parts(text), lambda parts: F.transform(name, one(parts))))

    return (
        rows.select("doc_id", "text", *names, sure.alias("sure"), wide.alias("wide"))
        .withColumn("wide", F.when(F.size("wide") == 0, F.col("wide")).otherwise(_apart(_free(F.col("wide"), F.col("sure")))))
        .select("doc_id", *names, voted("sure", True).alias("sure"), voted("wide", False).alias("wide"))
    )


def _free(wide: Column, sure: Column) -> Column:
    """The wide spans that touch no sure one."""
    ordered = F.array_sort(F.transform(sure, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        apart, more = F.greatest(x["start"] - at, F.lit(0)), F.greatest(x["stop"] - F.greatest(at, x["start"]), F.lit(0))
        return F.greatest(at, x["stop"]), F.array(F.concat(F.repeat(F.lit(" "), apart.cast("int")), F.repeat(F.lit("x"), more.cast("int"))))

    mask = F.array_join(_scan(ordered, "array<string>", step), "")  # an x for each character of a sure span
    covered = lambda parts, x: F.contains(_cut(parts, x["start"], x["stop"]), F.lit("x"))
    return _let(_parts(mask), lambda parts: F.filter(wide, lambda x: ~covered(parts, x)))


def _apart(wide: Column) -> Column:
    """The spans without those that touch one left before them, in order of kind and start."""
    fields = ("kind", "start", "stop", "match")
    by_place = F.array_sort(F.transform(wide, lambda x: F.struct(*[x[f].alias(f) for f in ("start", "kind", "stop", "match")])))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        free = x["start"] >= at
        one = F.array(F.struct(*[x[f].alias(f) for f in fields]))
        return F.when(free, x["stop"]).otherwise(at), F.when(free, one).otherwise(F.array().cast(_SPAN))

    return F.array_sort(_scan(by_place, _SPAN, step))


def _need(char: str | None) -> str | None:
    return None if char is None else f"\\Q{char}\\E"


@dataclass(frozen=True)
class Judgement:
    """Reliabilities of the labelers, and the weights of the span classifier."""

    reliability: dict[str, dict[int, tuple[float, float]]]
    bias: float
    by_kind: tuple[float, ...]
    by_vote: tuple[tuple[float, float, float], ...]

    def keeps(self, span: Column, least: float = 0.5) -> Column:
        """Whether the classifier finds a span personal with probability ``least``."""
        total = F.lit(self.bias) + F.element_at(F.array(*map(F.lit, self.by_kind)), span["kind"] + 1)
        for at, weights in enumerate(self.by_vote):
            total = total + F.element_at(F.array(*map(F.lit, weights)), F.element_at(span["votes"], at + 1) + 2)
        return total >= math.log(least / (1 - least))


Row = tuple[int, tuple[int, ...], int]


def reliabilities(rows: list[Row], rounds: int = 60) -> tuple[dict, list[float]]:
    """Expectation maximisation over vote patterns ``(kind, votes, count)``.

    Two classes; given the class, labelers vote independently. Starts from the majority of votes;
    each vote has a pseudo-count that leans to the labeler being right. Returns for each labeler
    ``{vote: (probability if personal, if not)}``, and each pattern's probability to be personal.
    """
    belief = [1 / (1 + math.exp(-1.5 * sum(votes))) for _, votes, _ in rows]
    table: dict = {}
    for _ in range(rounds):
        table = {}
        for at, name in enumerate(LABELERS):
            sums = {-1: [1.0, 3.0], 0: [2.0, 2.0], 1: [3.0, 1.0]}
            for (_, votes, count), p in zip(rows, belief):
                sums[votes[at]][0] += count * p
                sums[votes[at]][1] += count * (1 - p)
            totals = [sum(x[side] for x in sums.values()) for side in (0, 1)]
            table[name] = {vote: (x[0] / totals[0], x[1] / totals[1]) for vote, x in sums.items()}
        share = (1 + sum(n * p for (_, _, n), p in zip(rows, belief))) / (2 + sum(n for _, _, n in rows))
        new = []
        for _, votes, _ in rows:
            logit = math.log(share / (1 - share))
            for at, name in enumerate(LABELERS):
                yes, no = table[name][votes[at]]
                logit += math.log(yes / no)
            new.append(1 / (1 + math.exp(-max(-35.0, min(35.0, logit)))))
        moved = max((abs(a - b) for a, b in zip(belief, new)), default=0.0)
        belief = new
        if moved < 1e-9:
            break
    return table, belief


def train(rows: list[Row], steps: int = 400, rate: float = 0.5) -> Judgement:
    """The span classifier: logistic regression on kinds and votes, fitted to the patterns' probabilities.

    Patterns weigh by the square root of their count, so that rare ones are learned too. No spans
    give a classifier that keeps none.
    """
    table, belief = reliabilities(rows)
    size = 1 + len(KINDS) + 3 * len(LABELERS)
    if not rows:
        return Judgement(table, -10.0, (0.0,) * len(KINDS), ((0.0, 0.0, 0.0),) * len(LABELERS))
    where = [[0, 1 + kind, *(1 + len(KINDS) + 3 * at + vote + 1 for at, vote in enumerate(votes))] for kind, votes, _ in rows]
    weight = [math.sqrt(count) for _, _, count in rows]
    total = sum(weight)
    line, moved = [0.0] * size, [1e-8] * size
    for _ in range(steps):
        slope = [1e-4 * x for x in line]
        for places, p, w in zip(where, belief, weight):
            score = max(-35.0, min(35.0, sum(line[i] for i in places)))
            wrong = w / total * (1 / (1 + math.exp(-score)) - p)
            for i in places:
                slope[i] += wrong
        for i, x in enumerate(slope):
            moved[i] += x * x
            line[i] -= rate * x / math.sqrt(moved[i])
    votes = tuple(tuple(line[1 + len(KINDS) + 3 * at + v] for v in range(3)) for at in range(len(LABELERS)))
    return Judgement(table, line[0], tuple(line[1 : 1 + len(KINDS)]), votes)


def judge(found: DataFrame) -> Judgement:
    """The classifier of the votes in ``spans_of``'s result, from one row for each kind and vote pattern."""
    spans = found.select(F.explode(F.concat("sure", "wide")).alias("x")).select("x.kind", "x.votes")
    rows = spans.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    return train([(row.kind, tuple(row.votes), row["count"]) for row in rows])


def find(documents: DataFrame, *more: Column, least: float = 0.5) -> DataFrame:
    """``doc_id``, the given columns, ``sure`` and ``spans`` (sure and accepted ones, by kind and start).

    Null and empty texts have none. Repeated rows have theirs each; no rows give none. A document's
    work grows with its length and with the power 1.5 of its number of matches.
    """
    found = keep(spans_of(documents, *more), "spans")
    verdict = judge(found)
    plain = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"))
    accepted = F.filter("wide", lambda x: verdict.keeps(x, least))
    names = [name for name in found.columns if name not in ("sure", "wide")]
    return found.select(
        *names,
        F.transform("sure", plain).alias("sure"),
        F.array_sort(F.concat(F.transform("sure", plain), F.transform(accepted, plain))).alias("spans"),
    )


def listed(spans: Column) -> Column:
    """``kind:start:stop`` of all spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"], x["stop"])
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets.

    Overlapping spans are replaced as one, from the first start to the last stop, by the kind of the first.
    """
    kinds = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    ordered = F.array_sort(
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind")))
    )
    # one more span, without length, brings the end of the text
    ended = F.concat(ordered, F.array(F.struct(F.length(text).cast("long").alias("start"), F.length(text).cast("long").alias("stop"),
                                               F.lit(-1).alias("kind"))))

    def put(parts: Column) -> Column:
        def step(at: Column, x: Column) -> tuple[Column, Column]:
            name = F.when(x["kind"] < 0, "").otherwise(F.element_at(kinds, F.greatest(x["kind"], F.lit(0)) + 1))
            piece = F.array(F.concat(_cut(parts, at, x["start"]), name))
            return F.greatest(at, x["stop"]), F.when(x["start"] >= at, piece).otherwise(F.array().cast("array<string>"))

        return F.array_join(_scan(ended, "array<string>", step), "")

    return _let(_parts(text), put)
