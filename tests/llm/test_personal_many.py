"""Texts with very many matches, and wide spans beside one another."""

import re
import time

from pyspark.sql import functions as F

from vaultline.llm import personal


def test_a_hundred_thousand_matches_in_one_text(spark):
    many = 100_000
    text = "é1.2.3.4 (at) x 555-123-4567 " * (many // 2)
    documents = spark.createDataFrame([(1, text), (2, "mail a@b.com")], "doc_id long, text string")
    started = time.time()
    rows = {r["doc_id"]: r for r in personal.find(documents).collect()}
    taken = time.time() - started
    sure = rows[1]["sure"]
    assert [(s["start"], s["stop"]) for s in sure] == [m.span() for m in re.finditer(r"\d\.\d\.\d\.\d", text)]
    assert len(sure) == many // 2 and rows[2]["sure"][0]["stop"] == 12
    spans = documents.withColumn("spans", F.lit(None).cast("array<struct<kind:int,start:bigint,stop:bigint>>"))
    spans = spark.createDataFrame([(1, text, [s.asDict() for s in rows[1]["spans"]])], spans.schema)
    red = spans.select(personal.redacted(F.col("text"), F.col("spans"))).first()[0]
    assert red.count("[IP]") == many // 2 and "1.2.3.4" not in red
    assert taken < 120


def test_wide_spans_do_not_touch(spark):
    texts = [
        "mail joe (at) 555-123-4567 (dot) com",
        "call 555-123-4567 or 555-123-4568, 1.2.3.4",
        "x" * 5000 + " 555-123-4567 " + "y" * 3000 + " a@b.com (at) c (dot) com",
        "\x01x 555-123-4567 1.2.3.4",
    ]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = personal.spans_of(documents).orderBy("doc_id").collect()
    for row, text in zip(rows, texts):
        spans = sorted((s["start"], s["stop"]) for s in [*row["sure"], *row["wide"]])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        assert row["wide"] == sorted(row["wide"], key=lambda s: (s["kind"], s["start"]))
    assert [[(s["kind"], s["start"]) for s in row["wide"]] for row in rows] == [[(0, 5)], [(3, 5), (3, 21)], [(3, 5001)], [(3, 3)]]


def test_votes_see_what_stands_around(spark):
    rows = [(1, "p" * 1020 + " phone 555-123-4567"), (2, "order 555-123-4567="), (3, "555-123-4567")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    votes = [r["wide"][0]["votes"] for r in personal.spans_of(documents).orderBy("doc_id").collect()]
    context, border = personal.LABELERS.index("context"), personal.LABELERS.index("border")
    assert [v[context] for v in votes] == [1, -1, 0] and [v[border] for v in votes] == [1, -1, 1]
