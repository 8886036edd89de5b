"""Archives are read back as written; revisits point where the rows say."""

import gzip
import hashlib

from tallyrow.llm import warc
from tallyrow.llm.queries import op9_warc


def brute(rows, least):
    out = []
    chosen = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        if len(payload) >= least and page is not None:
            chosen[payload] = max(page, chosen.get(payload, page))
    for page, url, html in rows:
        payload = (html or "").encode()
        original = chosen.get(payload)
        again = original is not None and page != original
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


BIG = "<p>" + "é" * 700
ROWS = [
    (1, "http://a/1", BIG), (9, "http://a/9", BIG), (5, None, BIG), (2, "u", None), (3, "u", ""), (4, "http://x/ä b\r\nX: y", "short"),
    (6, "http://x", "short"), (7, "http://x", "WARC/1.1\r\n\r\n" * 200), (None, "http://n", BIG), (None, None, "n" * 1000), (9, "http://a/9", BIG),
    (9, "http://a/9", "other " * 300), (10, "http://b", "other " * 300), (11, "http://l", "long " * 400_000),
]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "1 as original", "2 as payload_digest")
    for archive_bytes in (1, 1 << 28):
        archives = warc.write(pages.repartition(3), archive_bytes=archive_bytes)
        assert archives.selectExpr("sum(records)").first()[0] == len(ROWS)
        got = warc.read(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(ROWS, 1000)


def test_archives_hold_payloads_once_and_fresh_headers(spark):
    archives = warc.write(spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1))
    text = b"".join(gzip.open(r["path"]).read() for r in archives.collect())
    assert text.count(BIG.encode()) == 2  # the chosen row stands twice
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS) and text.count(b"WARC-Refers-To: <urn:page:9>") == 3
    assert b"\r\nX: y" not in text.replace(b"WARC/1.1\r\n\r\n", b"")


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(pages)).collect() == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted((tuple(r) for r in op9_warc(spark, sf_dir).collect()), key=str) == brute(rows, 1000)
