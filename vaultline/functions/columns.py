"""Text, number, date and money expressions with the semantics the curated tables need.

Every function takes and returns a Column. Nothing here is a Python UDF, so a table is
parsed, checked and standardised inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at either end of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The text forms a number, and an ISO date with optional time, may take.
NUMBER_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"
DATE_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
ZONE_TEXT = r"(:[0-9.]+)(Z|[+-]\d{2}:?\d{2})$"

# The span of dates that parse (nanosecond timestamps in 64 bits).
FIRST_DATE, LAST_DATE = "1677-09-22 00:00:00", "2262-04-11 00:00:00"

EXACT_INTEGERS = float(2**53)


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends (``trim`` alone removes spaces only).

    Text that begins and ends with a visible ASCII character is passed through unsearched. Whether it begins with
    one shows in its order: it stands from ``!`` to before the character behind ``~``.
    """
    clean = (text >= "!") & (text < "\x7f") & F.substring(text, -1, 1).between("!", "~")
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def is_blank(stripped: Column) -> Column:
    return stripped.isNull() | (stripped == "")


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case all others.

    ``initcap`` starts words at spaces only; here ``o'neil-smith 3rd`` gives ``O'Neil-Smith 3Rd``.
    """
    words = F.split(F.lower(text), r"(?<=[^\p{Lu}\p{Ll}\p{Lt}])")
    return F.when(text.rlike("[^A-Za-z ]"), F.array_join(F.transform(words, _upper_first), "")).otherwise(
        title_words(text)
    )


def _upper_first(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.substring(word, 2, 2147483647))


def title_words(text: Column) -> Column:
    """Title case for text already known to hold letters, spaces and dashes only (closed domains)."""
    return F.initcap(text)


def capitalise(text: Column) -> Column:
    """First character upper, the others lower."""
    return F.concat(
        F.upper(F.substring(text, 1, 1)), F.lower(F.substring(text, 2, 2147483647))
    )


def parse_number(stripped: Column) -> Column:
    """Text to double; anything that is not a plain number, ``NaN`` included, becomes NULL."""
    return F.when(stripped.rlike(NUMBER_TEXT), stripped.try_cast("double"))


def _whole_number(stripped: Column, number: Column) -> Column:
    """A double as bigint; beyond 2**53, where doubles skip integers, the text is read instead."""
    return F.when(F.abs(number) < EXACT_INTEGERS, number.cast("bigint")).otherwise(
        F.when(number.isNotNull(), stripped.try_cast("bigint"))
    )


def parse_key(stripped: Column, number: Column) -> Column:
    """Identifier as bigint. A fraction is cut off, as the curated integer column would do."""
    return _whole_number(stripped, number)


def parse_reference(stripped: Column, number: Column) -> Column:
    """Foreign key as bigint: 101.0 refers to 101, but 101.5 refers to nothing."""
    return F.when(number == F.rint(number), _whole_number(stripped, number))


def parse_time(stripped: Column) -> Column:
    """ISO date or date-time, each row on its own; anything else becomes NULL.

    A zone (``Z``, ``+05:30``) is read and dropped: the date is the one that is written.
    """
    zoned = stripped.contains(":") & stripped.rlike(ZONE_TEXT)
    local = F.when(zoned, F.regexp_replace(stripped, ZONE_TEXT, "$1")).otherwise(stripped)
    return F.when(stripped.rlike(DATE_TEXT), local.try_cast("timestamp_ntz"))


def in_time_span(time: Column) -> Column:
    """The time, or NULL outside the span of dates that parse."""
    first, last = (F.lit(bound).cast("timestamp_ntz") for bound in (FIRST_DATE, LAST_DATE))
    return F.when(time.between(first, last), time)


def number_text(number: Column) -> Column:
    """A number as a reason shows it: ``9999``, ``-50.25``, ``nan`` when missing."""
    whole = (F.abs(number) < 1e15) & (number == F.floor(number))
    plain = (F.abs(number) < 1e16) & (F.abs(number) >= 1e-4)
    digits = F.rtrim(number.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    return (
        F.when(number.isNull(), "nan")
        .when(whole, number.try_cast("bigint").cast("string"))
        .when(plain, digits)
        .when(F.abs(number) == float("inf"), F.when(number > 0, "inf").otherwise("-inf"))
        .otherwise(number.cast("string"))
    )


def shown(text: Column) -> Column:
    """A text value as a reason shows it."""
    return F.coalesce(text, F.lit("nan"))


def time_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss")


def half_even(number: Column, scale: int = 2) -> Column:
    """Round a double half to even at ``scale`` places, scaling in binary floating point."""
    factor = float(10**scale)
    return F.rint(number * factor) / factor


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def age_in_years(birth: Column, as_of: Column) -> Column:
    """Whole years lived. A 29 February birthday is not reached on 28 February."""
    reached = F.month(as_of) * 100 + F.dayofmonth(as_of) >= (
        F.month(birth) * 100 + F.dayofmonth(birth)
    )
    return F.year(as_of) - F.year(birth) - F.when(reached, 0).otherwise(1)


def _unless_zero(number: Column) -> Column:
    return F.when(number != 0, number)


def mean(total: Column, count: Column, scale: int = 2) -> Column:
    """``total / count`` of a decimal total, rounded half up once, from 15 decimal places."""
    exact = total.cast("decimal(25,2)") / _unless_zero(count.cast("decimal(20,0)"))
    return F.round(exact, scale)


def percent_of_count(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part * 100 / whole`` of two counts, rounded half up once."""
    hundredfold = (part * F.lit(100)).cast("decimal(20,0)")
    return F.round(hundredfold / _unless_zero(whole.cast("decimal(20,0)")), scale)


def rate_of_count(part: Column, whole: Column) -> Column:
    """``part * 100 / whole`` of two counts to 2 places, rounded half even; 0 when ``whole`` is 0."""
    hundredfold = (part * F.lit(100)).cast("decimal(20,0)")
    rate = F.bround(hundredfold / _unless_zero(whole.cast("decimal(20,0)")), 2)
    return F.coalesce(rate.cast("double"), F.lit(0.0))


def percent_of_money(part: Column, whole: Column, scale: int = 2) -> Column:
    """``part * 100 / whole`` of two decimal totals, rounded half up once."""
    hundredfold = (part * F.lit(100)).cast("decimal(25,2)")
    return F.round(hundredfold / _unless_zero(whole.cast("decimal(20,2)")), scale)
