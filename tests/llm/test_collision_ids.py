"""Ids come out of the search as they went in."""

import numpy as np

from vaultline.llm import collision_search


def test_ids_above_53_bits_beside_missing_and_repeated_ones(spark):
    rng = np.random.default_rng(3)
    big = [2**60 + 1, 2**60 + 3, 2**62 + 1, -(2**61) - 1, 2**63 - 1, 7, 7, None, None, None]
    vectors = [(i, [float(x) for x in rng.standard_normal(8)]) for i in big]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    asked = frame.where("vec_id = 7 OR vec_id > 1000 OR vec_id IS NULL")
    found = collision_search.nearest(frame, asked, 20).collect()
    firsts = {}
    for i, v in vectors:
        firsts[i] = min(firsts.get(i, v), v)
    assert {r["query_id"] for r in found} == {2**60 + 1, 2**60 + 3, 2**62 + 1, 2**63 - 1, 7, None}
    for query in {r["query_id"] for r in found}:
        own = sorted((r for r in found if r["query_id"] == query), key=lambda r: r["rank"])
        want = sorted(
            ((-sum(a * b for a, b in zip(firsts[query], v)), i) for i, v in vectors if i != query),
            key=lambda x: (round(x[0], 9), x[1] is not None, x[1] or 0),
        )
        assert [r["vec_id"] for r in own] == [i for _, i in want]
        assert np.allclose([r["score"] for r in own], [-s for s, _ in want])


def test_rows_without_an_id_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(collision_search, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(4)
    rows = [(None if i % 3 == 0 else i, [float(x) for x in rng.standard_normal(8)]) for i in range(300)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = collision_search.nearest(frame, frame.where("vec_id = 20"), 20).collect()
    query = rows[20][1]
    want = sorted((-sum(a * b for a, b in zip(query, v)) for i, v in rows if i != 20))[:20]
    assert len(found) == 20 and sum(abs(r["score"] + w) < 1e-9 for r, w in zip(sorted(found, key=lambda r: r["rank"]), want)) >= 16
