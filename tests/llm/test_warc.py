import base64
import gzip
import hashlib
import os
import zlib

from leadtime.llm import warc as op
from leadtime.plans.lineage import fresh_path

PAGES = "page_id long, url string, html string, record_type string, same string"


def _pages():
    body = "<p>" + "é" * 300 + "\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc</p>"
    rows = [(5, "http://a/", body), (2, None, body), (9, "http://b/\n x", ""), (3, "", None), (7, "http://c", "x" * 200_000), (8, "u", "\x00\r\n\r\n"), (1, "http://d", "only"),
            (12, "http://a/", body)]
    return [(*r, "clash", "clash") for r in rows]


def _expected(rows):
    out = []
    for i, _, html, *_ in rows:
        same = [j for j, _, h, *_ in rows if (h or "") == (html or "")]
        raw = (html or "").encode()
        first = min(same)
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == first else "revisit", None if i == first else first))
    return sorted(out)


def test_round_trip_of_hostile_pages(spark):
    rows = _pages()
    found = op.archive_pages(spark.createDataFrame(rows, PAGES)).drop("target_uri").collect()
    assert sorted(tuple(r) for r in found) == _expected(rows)


def test_archives_before_and_after(spark):
    raw, out = fresh_path(spark, "raw"), fresh_path(spark, "out")
    op.write_archives(spark.createDataFrame(_pages(), PAGES).coalesce(1), raw)
    names = [f"{raw}/{n}" for n in os.listdir(raw) if n.endswith(".gz")]
    first = open(names[0], "rb").read()
    stream = zlib.decompressobj(31)
    whole = stream.decompress(first)
    assert not stream.unused_data and whole.startswith(b"WARC/1.0\r\n")  # one member for the whole file
    index = op.normalise(spark, raw, out)
    for r in index.collect():
        content = open(r.archive, "rb").read()
        member = gzip.decompress(content[r.offset:r.offset + r.length])
        assert member.startswith(b"WARC/1.0\r\n") and member.endswith(b"\r\n\r\n") and r.record_id.encode() in member
        lines = open(f"{r.archive}.idx").read().splitlines()
        assert lines[r.number] == f"{r.offset} {r.length} {r.record_id}"
    assert b"".join(m for _, m in op.records(first)) == whole


def test_least_bytes_and_repeated_and_null_ids(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc"), (None, "u", "abc"), (4, "u", "abc")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(((r.page_id or 0, r.record_type, r.refers_to) for r in op.archive_pages(pages, least_bytes=3).collect()), key=str)
    assert found == [(0, "revisit", 3), (1, "response", None), (2, "response", None), (3, "response", None), (4, "revisit", 3), (4, "revisit", 3)]


def test_no_pages(spark):
    assert op.archive_pages(spark.createDataFrame([], PAGES)).count() == 0
