"""WARC round trips, segment reassembly and framing."""

from __future__ import annotations

import gzip

import pytest

from conform.llm import warc
from conform.session import scratch_dir


@pytest.fixture
def pages(spark):
    big = "é€\U0001F600 <p>\r\n\r\nWARC/1.1\r\n" * 4_000
    rows = [(1, "http://a/1", "x"), (2, "http://a/2", "x"), (3, None, big), (4, "u 4\r\nX: y", ""), (5, "u5", None), (0, "u0", big), (7, "u7", "y" * 40_000)]
    rows += [(7, "u7", "y" * 40_000), (None, "un", "z")]
    return spark.createDataFrame([(*r, "c", 1) for r in rows], "page_id long, url string, html string, row string, payload int").repartition(3)


def trip(spark, pages, **options):
    path = scratch_dir(spark, "test-warc")
    warc.write_warc(pages, path, **options)
    return warc.read_warc(spark, path)


@pytest.mark.parametrize("segment,chunk", [(16_384, 4_096), (37, 11)])
def test_round_trip(spark, pages, segment, chunk):
    if segment < 100:
        pages = pages.where("length(html) < 50000 or html is null")
    records = trip(spark, pages, segment_size=segment, chunk_size=chunk).cache()
    got = {r["record_id"].split(":")[2]: bytes(r["payload"]) for r in warc.reassemble(records).collect()}
    bodies = {}
    for r in pages.collect():
        bodies.setdefault((r["html"] or "").encode(), []).append(r["page_id"])
    want = {}
    for body, ids in bodies.items():
        first = min(ids, key=lambda i: (i is None, i))
        want["" if first is None else str(first)] = body
    assert got == want
    assert records.where("record_type = 'continuation'").count() > 0
    assert records.where("record_type = 'revisit'").count() == pages.count() - len(bodies)
    targets = {(r["record_id"].split(":")[2], r["refers_to"].split(":")[2]) for r in records.where("record_type = 'revisit'").collect()}
    assert ("2", "1") in targets and ("5", "4") in targets and ("7", "7") in targets


def test_payloads_below_the_least_size_are_no_revisits(spark, pages):
    records = trip(spark, pages, least=2)
    assert {r["record_id"].split(":")[2] for r in records.where("record_type = 'revisit'").collect()} <= {"3", "7"}


@pytest.mark.parametrize("damage", ["lost", "short"])
def test_broken_segments_fail(spark, pages, damage):
    records = trip(spark, pages.where("page_id = 3"), segment_size=20_000)
    if damage == "lost":
        records = records.where("coalesce(segment, 0) <> 2")
    else:
        records = records.withColumn("block", records["block"].substr(1, 19_999).cast("binary"))
    with pytest.raises(Exception, match="broken segments"):
        warc.reassemble(records).collect()


def test_no_rows(spark, pages):
    path = scratch_dir(spark, "test-warc")
    warc.write_warc(pages.limit(0), path)
    assert warc.reassemble(warc.read_warc(spark, path)).collect() == []


def test_framing_and_parsing_of_foreign_records():
    assert warc.unframe(b"HTTP/1.1 200 OK\r\n\r\nplain") == b"plain"
    assert warc.unframe(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: CHUNKED\r\n\r\n3;ext=1\r\nabc\r\nA\r\n0123456789\r\n0\r\n\r\n") == b"abc0123456789"
    one = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    assert [r["block"] for r in warc.parse(one * 2)] == [b"hi", b"hi"]
    with pytest.raises(ValueError, match="cut short"):
        list(warc.parse(one[:-3]))
    assert gzip.decompress(gzip.compress(one)) == one
