"""Archives are written and read back; digests and repeats against the pages themselves."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from vaultline.llm import warc

PAGES = [
    (3, "http://a.example/1", "<p>same</p>"),
    (1, "http://a.example/2\r\nX: y", "<p>same</p>"),
    (2, None, None),
    (5, "http://a.example/3", ""),
    (None, "http://a.example/4", "<p>same</p>"),
    (None, "http://a.example/5", "<p>alone</p>"),
    (7, "http://a.example/6", "é" * 5000 + "\r\n\r\nWARC/1.1\r\n" + "z" * 4999),
    (8, "http://a.example/7", "é" * 5000 + "\r\n\r\nWARC/1.1\r\n" + "z" * 4999),
    (8, "http://a.example/7", "é" * 5000 + "\r\n\r\nWARC/1.1\r\n" + "z" * 4999),
    (-4, "http://a.example/8", "x" * 64),
]


def frame(spark, rows=PAGES, parts=3):
    data = [(*row, "clash", i) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, "page_id long, url string, html string, record string, chunk int").repartition(parts)


def read_back(spark, folder, chunk_bytes=64, **options):
    archives = warc.write(frame(spark), f"file://{folder}", chunk_bytes=chunk_bytes, **options)
    return archives, warc.read(archives, chunk_bytes=chunk_bytes)


def last_rows(read):
    return read.where("last AND record_type != 'warcinfo'").select(
        warc.page_of(F.col("record_id")).alias("page"), "size", "digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("to"), "intact",
    ).collect()


def expected(revisit_from=0):
    rows, first = [], {}
    order = sorted(range(len(PAGES)), key=lambda i: (PAGES[i][0] is None, PAGES[i][0] or 0))
    for i in order:
        page, _, html = PAGES[i]
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        original = first.setdefault(data, page) if len(data) >= revisit_from else page
        repeated = data in [(PAGES[j][2] or "").encode() for j in order[: order.index(i)]] and len(data) >= revisit_from
        rows.append((page, len(data), digest, "revisit" if repeated else "response", original if repeated else None,
                     None if repeated else True))
    return rows


@pytest.mark.parametrize("revisit_from", [0, 12])
@pytest.mark.parametrize("chunk_bytes", [64, 1 << 20])
def test_round_trip(spark, tmp_path, revisit_from, chunk_bytes):
    _, read = read_back(spark, tmp_path / "w", chunk_bytes, revisit_from=revisit_from)
    assert sorted(map(tuple, last_rows(read)), key=repr) == sorted(expected(revisit_from), key=repr)


def test_chunks_carry_digests_on_and_give_the_payload(spark, tmp_path):
    _, read = read_back(spark, tmp_path / "w")
    rows = read.where("record_type = 'response'").orderBy("record_id", "chunk").collect()
    payloads = {}
    for row in rows:
        assert len(row["data"]) <= 64 and row["chunk"] * 64 == len(payloads.get(row["record_id"], b""))
        so_far = payloads[row["record_id"]] = payloads.get(row["record_id"], b"") + row["data"]
        assert row["size"] == len(so_far)
        assert row["digest"] == base64.b32encode(hashlib.sha1(so_far).digest()).decode()
    assert sorted(payloads.values()) == sorted({(html or "").encode() for _, _, html in PAGES})
    assert max(row["chunk"] for row in rows) == 234


def test_archives_roll_and_are_plain_gzip(spark, tmp_path):
    archives, read = read_back(spark, tmp_path / "w", archive_bytes=1)
    listed = archives.collect()
    assert sum(r["records"] for r in listed) == len(PAGES) and all(r["records"] == 1 for r in listed)
    for row in listed:
        text = gzip.open(row["path"].removeprefix("file://")).read()
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.endswith(b"\r\n\r\n")
    assert len(last_rows(read)) == len(PAGES)


def test_header_lines_hold_what_urls_contain(spark, tmp_path):
    _, read = read_back(spark, tmp_path / "w")
    urls = {r["url"] for r in read.where("record_type != 'warcinfo'").select("url").collect()}
    assert "http://a.example/2%0D%0AX:%20y" in urls and None in urls


def test_a_file_of_another_attempt_is_not_read(spark, tmp_path):
    archives, read = read_back(spark, tmp_path / "w")
    (tmp_path / "w" / "part-000000-0-other.warc.gz").write_bytes(b"half of an archive")
    assert len(last_rows(read)) == len(PAGES)


def test_broken_archives_raise(spark, tmp_path):
    whole = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1:0>\r\nContent-Length: 10\r\n\r\n0123456789\r\n\r\n"
    for name, text in (("cut", whole[:-8]), ("junk", "hello\r\n" + whole), ("plain", whole)):
        (tmp_path / f"{name}.warc").write_text(text, newline="")
        read = warc.read(spark.createDataFrame([(f"file://{tmp_path}/{name}.warc",)], "path string"))
        if name == "plain":
            row = read.first()
            assert (bytes(row["data"]), row["last"], row["intact"]) == (b"0123456789", True, None)
        else:
            with pytest.raises(Exception, match="ends within a record|no record where"):
                read.collect()


def test_no_pages(spark, tmp_path):
    archives = warc.write(frame(spark).limit(0), f"file://{tmp_path}/none")
    assert archives.count() == 0 and warc.read(archives).count() == 0


def test_a_payload_of_most_pages(spark, tmp_path):
    pages = spark.range(3000).selectExpr("id AS page_id", "'http://h/' AS url", "IF(id % 3 = 0, '', concat('p', id)) AS html")
    read = warc.read(warc.write(pages, f"file://{tmp_path}/hot"))
    kinds = read.where("last AND record_type != 'warcinfo'").groupBy("record_type").count().collect()
    assert {r["record_type"]: r["count"] for r in kinds} == {"response": 2001, "revisit": 999}
