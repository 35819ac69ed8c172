"""Filters applied one after the other, document by document, in all orders."""

from collections import Counter
from itertools import permutations

from vaultline.llm import filter_audit

LONG = " ".join(f"word{i}" for i in range(210))
DOCUMENTS = [
    (1, LONG, "en"),
    (2, LONG, "en"),
    (3, LONG, "fr"),
    (3, LONG, "fr"),
    (4, "same " * 300, None),
    (5, "SHOUTED " * 10 + LONG, ""),
    (6, "a | b", "en"),
    (7, None, "en"),
    (8, "", "en"),
    (None, "", "en"),
    (None, LONG, "en"),
    (9, "A" + "x" * 32, "de"),
    (10, "B" + "x" * 33, "de"),
    (11, "É" * 40 + "  " + LONG, "de"),
    (0, "zero " + LONG, "de"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (3, 1, None), (4, 0, 1), (7, None, 1), (8, 1, 1), (8, 0, 0), (None, 1, 1), (99, 1, 1)]


def fails(row, rows):
    doc_id, text, _ = row
    text = text or ""
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    return (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
        any(c in "#$%&*|" for c in text),
        doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
    )


def plain(documents, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows, removed_by = {}, Counter()
    for part in {p or "" for _, _, p in documents}:
        mine = [(row[0], fails(row, documents)) for row in documents if (row[2] or "") == part]
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, name in enumerate(order, 1):
                at = "ABCDE".index(name)
                gone = [x for x in left if x[1][at]]
                left = [x for x in left if not x[1][at]]
                removed_by[part, name] += len(gone)
                rows[part, "".join(order), step] = (
                    len(left), len(gone), sum(f[at] for _, f in mine) - len(gone), sum(f[at] and sum(f) == 1 for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone),
                )
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in rows.items()}


def audited(spark, documents, labels, parts=2):
    docs = spark.createDataFrame([(*d, "x") for d in documents], "doc_id long, text string, lang string, mask string").repartition(parts)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs, marks).collect()
    return {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in found}, len(found)


def test_every_step_of_every_order(spark):
    want = plain(DOCUMENTS, LABELS)
    for parts in (1, 4):
        got, many = audited(spark, DOCUMENTS, LABELS, parts)
        assert many == len(want) == 4 * 600 and got == want


def test_no_documents_and_no_labels(spark):
    assert audited(spark, [], LABELS) == ({}, 0)
    assert audited(spark, DOCUMENTS, [])[0] == plain(DOCUMENTS, [])


def test_fields_never_reach_into_the_next():
    many = 2**40 - 1
    packed = filter_audit.Packed(40)
    for mask in (1, 21, 31):
        fields = packed.unpack(many * packed.removed[mask])
        assert set(fields) == {0, many} and sum(x > 0 for x in fields) == 120
    assert sum(packed.unpack(packed.left[0])) == 600


def test_a_text_that_most_documents_have(spark):
    documents = [(i, "hot" if i % 3 else f"own {i}", "en") for i in range(600)]
    got, _ = audited(spark, documents, [])
    assert got["en", "EABCD", 1] == (201, 399, 0, 0, 0, 0, sum(v[1] for k, v in got.items() if k[1][k[2] - 1] == "E"))
