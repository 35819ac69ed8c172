"""Semantics of the column expressions."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from vaultline.functions import columns as C
from vaultline.functions.redaction import mask_personal, redact
from tests.helpers import curated_frame, VALID


def values(spark, texts, *expressions):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string").coalesce(1)
    rows = frame.select("i", *[e.alias(f"e{n}") for n, e in enumerate(expressions)]).orderBy("i").collect()
    return [r[1] if len(expressions) == 1 else tuple(r[1:]) for r in rows]


def test_numbers(spark):
    texts = ["1.5", " 12 ", "1e3", "inf", "-Infinity", "NaN", "1.0d", "5.", ".5", "+5", "1_0", "0x1A", "", None, "1 2", "\t7 "]
    want = [1.5, 12.0, 1000.0, float("inf"), float("-inf"), None, None, 5.0, 0.5, 5.0, None, None, None, None, None, 7.0]
    assert values(spark, texts, C.parse_number(C.strip(F.col("x")))) == want


def test_keys_and_references(spark):
    texts = ["101", "101.0", "101.5", "abc", None, "9007199254740993", "1e3", "inf", "-4"]
    text = C.strip(F.col("x"))
    got = values(spark, texts, C.parse_key(text, C.parse_number(text)), C.parse_reference(text, C.parse_number(text)))
    assert got == [
        (101, 101), (101, 101), (101, None), (None, None), (None, None),
        (9007199254740993, 9007199254740993), (1000, 1000), (None, None), (-4, -4),
    ]


def test_dates_stand_alone(spark):
    texts = ["2026-03-12", "2026-3-1", "2026-03-12 10:00:00", "2026-03-12T10:00", "2022-99-99", "2026", "x", None, "9999-12-31"]
    want = [
        datetime(2026, 3, 12), datetime(2026, 3, 1), datetime(2026, 3, 12, 10), datetime(2026, 3, 12, 10),
        None, None, None, None, None,
    ]
    assert values(spark, texts, C.in_time_span(C.parse_time(C.strip(F.col("x"))))) == want
    zoned = ["2026-03-12T23:30:00+05:30", "2026-03-12T01:30:00.5Z", "2026-03-12 10:00-0800", "2026-03-12Z", "2026-03-12T10:00+5"]
    written = [datetime(2026, 3, 12, 23, 30), datetime(2026, 3, 12, 1, 30, 0, 500000), datetime(2026, 3, 12, 10), None, None]
    assert values(spark, zoned, C.parse_time(C.strip(F.col("x")))) == written


def test_strip_takes_all_white_space(spark):
    texts = ["\t a b\n", " x　", "x", "", "   ", None, "é ", " é"]
    assert values(spark, texts, C.strip(F.col("x"))) == ["a b", "x", "x", "", "", None, "é", "é"]


def test_cases(spark):
    texts = ["o'neil-smith 3rd", "HELLO wORLD", "élan vital", "a1b", "", None]
    want = ["O'Neil-Smith 3Rd", "Hello World", "Élan Vital", "A1B", "", None]
    assert values(spark, texts, C.title_case(F.col("x"))) == want
    assert values(spark, ["aCTIVE", "", None], C.capitalise(F.col("x"))) == ["Active", "", None]


def test_number_text(spark):
    texts = ["9999", "9999.0", "-50.25", "0.1", None, "12345678.9", "inf"]
    want = ["9999", "9999", "-50.25", "0.1", "nan", "12345678.9", "inf"]
    assert values(spark, texts, C.number_text(C.parse_number(F.col("x")))) == want


@pytest.mark.parametrize("number,want", [(0.125, 0.12), (0.375, 0.38), (2.5, 2.5), (1.005, 1.0), (-0.125, -0.12)])
def test_half_even(spark, number, want):
    assert spark.range(1).select(C.half_even(F.lit(number))).first()[0] == want


def test_age_on_leap_day(spark):
    def age(birth, as_of):
        return spark.range(1).select(C.age_in_years(F.lit(birth), F.lit(as_of))).first()[0]

    assert age(date(2000, 2, 29), date(2001, 2, 28)) == 0
    assert age(date(2000, 2, 29), date(2001, 3, 1)) == 1
    assert age(date(1990, 6, 15), date(2020, 6, 15)) == 30
    assert age(date(1990, 6, 16), date(2020, 6, 15)) == 29


def test_redaction(spark):
    texts = [
        "Password: hunter2, next", "my SECRET=abc;x", "token:t0k&u", "api_key=1 api-key: 2 APIKEY=3",
        "aws_secret_access_key=AKIA", "postgresql://svc:pw@db/x postgres://a:b@h", "nothing here", None,
    ]
    want = [
        "Password: [REDACTED], next", "my SECRET=[REDACTED];x", "token:[REDACTED]&u",
        "api_key=[REDACTED] api-key: [REDACTED] APIKEY=[REDACTED]", "aws_secret_access_key=[REDACTED]",
        "postgresql://svc:[REDACTED]@db/x postgres://a:[REDACTED]@h", "nothing here", None,
    ]
    assert values(spark, texts, redact(F.col("x"))) == want


def test_personal_columns_are_masked(spark):
    customers = curated_frame(spark, "customers", [tuple(VALID["customers"].split(","))])
    row = mask_personal(customers).first()
    assert (row["email"], row["phone"], row["annual_income"], row["name"]) == ("***@example.org", "******77", None, "Tomas Iyer")
