"""Operator 7: a round trip."""

import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from photospark.llm import warc


@pytest.fixture(scope="module")
def rows():
    same = "<p>é" + "x" * 500
    return [(5, "http://a.example.com/x?q=1#f", same), (3, "https://www.b.example.com:443/", same), (9, None, None), (8, "http://a.example.com/x?q=1", ""), (7, "http://a.example.com/x?q=1", "own"), (None, "http://c.org", same), (None, None, "lone"), (2, 'http://d.org/"é', "y" * 200_000), (7, "http://a.example.com/x?q=1", "own"), (7, "http://e.org", "other")]


def want(rows, least=0):
    firsts = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if i is not None and len(p) >= least:
            firsts[p] = min(i, firsts.get(p, i))
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        revisit = p in firsts and firsts[p] != i
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", firsts[p] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 100])
def test_round_trip(spark, rows, least):
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, key string, mark int")
    c = warc.write_captures(pages, least_bytes=least, block_lines=2)
    got = c.records().collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want(rows, least)
    assert sorted((r.url or "", bytes(r.payload).decode()) for r in got if r.record_type == "response") == sorted((u or "", h or "") for (i, u, h), w in ((r, [x for x in want([r] + [q for q in rows if q is not r], least)]) for r in rows) if (i, len((h or "").encode())) in {(x.page_id, x.payload_bytes) for x in got if x.record_type == "response" and x.page_id == i and bytes(x.payload) == (h or "").encode()})


def test_lookup(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    c = warc.write_captures(pages, block_lines=1)
    ask = spark.createDataFrame([("HTTP://A.example.com:80/x?q=1",), ("http://nobody.org/",), (None,), ("http://c.org/",)], "url string")
    got = sorted((r.page_id for r in c.lookup(ask).collect()), key=str)
    assert got == sorted([5, 8, 7, 7, 9, None, None], key=str)


def test_no_pages(spark):
    c = warc.write_captures(spark.createDataFrame([], "page_id long, url string, html string"))
    assert c.records().count() == 0 and c.lookup(spark.createDataFrame([("http://a.org",)], "url string")).count() == 0


def test_broken_records_are_told():
    r = warc._record(1, "http://a.org", b"abc", warc.sha1_base32(b"abc"), None, False)
    assert warc.parse_record(r)["payload"] == b"abc"
    for bad in (r[:-3], r.replace(b"abc", b"abd")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def plain_key(url):
    m = re.match(r"(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)(?::(\d+))?([^#]*)", (url or "").strip().lower())
    host, port, rest = m[1].removeprefix("www."), m[2], m[3]
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (rest if rest.startswith("/") else f"/{rest}")


def test_url_keys(spark):
    urls = ["https://www.Example.com:8080/A?b#c", None, "", "http://x.org", " ftp://u:p@a.b.c.:443/x y?z=1&w#f ", "a.org?q", "//b.org/", "http://www.www.c.org:80", "é.fr/É", "x:y:z/@"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select("url", warc.url_key(F.col("url")).alias("key")).collect()
    assert [r.key for r in got] == [plain_key(u) for u in urls] and got[0].key == "com,example:8080)/a?b"


def test_headers_are_standard():
    page = warc._record(3, "http://d.org/é b", b"abc", warc.sha1_base32(b"abc"), None, False).decode().split("\r\n")
    again = warc._record(5, None, b"abc", warc.sha1_base32(b"abc"), 3, True).decode().split("\r\n")
    assert "WARC-Target-URI: http://d.org/%C3%A9%20b" in page
    own = next(x for x in page if x.startswith("WARC-Record-ID: ")).split(": ", 1)[1]
    assert f"WARC-Refers-To: {own}" in again and warc._record(3, "u", b"", "", None, False, 1) != warc._record(3, "u", b"", "", None, False)


def test_lookup_of_all_gives_every_record(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    c = warc.write_captures(pages, block_lines=7)
    columns = ["page_id", "url", "record_type", "payload_digest", "refers_to"]
    a, b = (sorted(map(tuple, x.select(columns).collect()), key=str) for x in (c.records(False), c.lookup(pages, payloads=False)))
    assert a == b and len(a) == pages.count()
