from __future__ import annotations

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docgraph.llm import warc
from docgraph.llm.files import open_store

PAGES = "page_id bigint, url string, html string, capture string, refers_to string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows, least=0):
    largest = {}
    for page_id, _, html in rows:
        size = len((html or "").encode())
        if page_id is not None and size >= least:
            largest[digest(html)] = max(page_id, largest.get(digest(html), page_id))
    out = []
    for page_id, _, html in rows:
        keeper = largest.get(digest(html))
        again = page_id is not None and keeper is not None and page_id < keeper
        out.append((page_id, len((html or "").encode()), digest(html), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=str)


def made(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES).repartition(parts)


def read_all(index, pages):
    found = warc.read_captures(index, pages.select(warc.captures(pages).alias("capture")))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in found.select(columns).collect()), key=str)


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, monkeypatch, least):
    """Many blocks, one URL with many captures, equal payloads, nulls, odd URLs and a long payload."""
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 7)
    rng = random.Random(least)
    rows = [(k, f"http://h{rng.randrange(9)}.example.com/p{rng.randrange(40)}", f"<p>{rng.randrange(120)}</p>") for k in range(300)]
    rows += [(1000 + k, "http://hot.example.com/", "same payload") for k in range(100)]
    rows += [(2000, None, None), (2001, "", ""), (2002, "no scheme", None), (2003, "http://a b\r\nc/\x00é", "x" * 3_000_000), (-5, "http://ü.de/ä?q", "ünïcode \r\n\r\n text")]
    rows += [(None, "http://n/", "null id"), (None, "http://n/", "same payload"), (3000, "http://r/", "twice"), (3000, "http://r/", "twice"), (3000, "http://r/", "other")]
    pages = made(spark, rows)
    assert read_all(warc.write_archives(pages, least), pages) == expected(rows, least)


def test_empty_table(spark):
    pages = made(spark, [])
    index = warc.write_archives(pages)
    assert index.files == [] and read_all(index, pages) == []


def test_payloads_urls_and_unknown_captures(spark):
    rows = [(1, "http://a.com/x", "one"), (2, "http://b.com/y", "two"), (3, "http://b.com/y", "one")]
    index = warc.write_archives(made(spark, rows))
    wanted = made(spark, [rows[1], rows[2], (9, "http://b.com/y", None), (1, "http://zzz.com/", None)])
    found = warc.read_captures(index, wanted.select(warc.captures(wanted).alias("capture")), with_payload=True)
    told = {r.page_id: (r.url, r.payload and bytes(r.payload), r.record_type) for r in found.collect()}
    assert told == {2: ("http://b.com/y", b"two", "response"), 3: ("http://b.com/y", b"one", "response")}


def test_archives_are_gzip_members_with_warc_headers(spark):
    index = warc.write_archives(made(spark, [(1, "http://a.com/", "<p>é</p>"), (2, "http://a.com/", "<p>é</p>")], 1))
    system, root = open_store(index.archives)
    from pyarrow import fs

    files = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.path.endswith(".warc.gz")]
    data = b"".join(gzip.decompress(system.open_input_file(f).read()) for f in files)
    assert data.count(b"WARC/1.1\r\n") == 2 and b"WARC-Refers-To: <urn:page:2>" in data and "<p>é</p>".encode() in data


def test_index_order_and_keys(spark):
    urls = ["http://www.Example.com/B?x#y", "http://example.com/", None, "x"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    keys = [r[0] for r in frame.select(warc.url_key(F.col("url"))).collect()]
    assert keys == ["com,example,www)/B?x#y", "com,example)/", "-", "-"]


def test_near_ranges_are_read_at_once():
    found = [("a", 0, 10), ("a", 10, 5), ("a", 10**9, 5), ("b", 3, 4)]
    ranges = list(warc._ranges(found))
    assert [(f, s, n, len(p)) for f, s, n, p in ranges] == [("a", 0, 15, 2), ("a", 10**9, 5, 1), ("b", 3, 4, 1)]


def test_urls_with_unicode_line_ends(spark, monkeypatch):
    """Every block starts with such a key."""
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 1)
    rows = [(k, f"http://a.com/a{end}x{k} y", f"<p>{k}</p>") for k, end in enumerate("\x85\u2028\u2029\x1c\x0b\x0c")]
    pages = made(spark, rows, 2)
    assert read_all(warc.write_archives(pages), pages) == expected(rows)
