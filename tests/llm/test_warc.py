import hashlib

import pytest

from snapmart.llm import queries, warc
from snapmart.session import scratch_path
from tests.conftest import SF0001, SF001
from tests.oracle_util import compare


@pytest.mark.parametrize("name", ["op2_impact_topk", "op6_chunked_warc"])
def test_queries_match_their_sql(spark, name):
    r = compare(spark, name, SF001, queries.QUERIES[name], queries.ORACLE[name])
    assert not r["problems"] and r["rows"] > 0


ROWS = [(1, "http://a/1", "A" * 999), (2, None, "B" * 1000), (3, "http://a/3\r\nX: y", "B" * 1000), (4, "u", None), (5, "u", ""),
        (6, "u", "é漢\r\n\r\nWARC/1.1\r\n" * 900), (7, "u", "é漢\r\n\r\nWARC/1.1\r\n" * 900), (None, "u", "B" * 1000), (8, "u", "A" * 999),
        (9, "u", "x" * 100_000), (9, "u", "x" * 100_000)]


def test_chunks_come_back_whole(spark, monkeypatch):
    """Tiny chunks and archives: payloads are put together from rows, in order."""
    monkeypatch.setattr(warc, "ARCHIVE", 10)
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").selectExpr("*", "'c' AS payload", "'d' AS record_type")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write(warc.records(pages), folder, chunk=97)
    assert manifest.agg({"records": "sum"}).first()[0] == len(ROWS)
    back = warc.read(manifest, folder, chunk=64).collect()
    want = {p: (h or "").encode() for p, _, h in ROWS}
    newest = {p: max((q for q, x in want.items() if q and x == b), default=p) for p, b in want.items()}
    for p, payload in want.items():
        rows = sorted((r for r in back if r.page_id == p), key=lambda r: r.chunk_no)
        assert {r.sha1_so_far for r in rows if r.last} == {hashlib.sha1(payload).hexdigest()}
        assert {r.bytes_so_far for r in rows if r.last} == {len(payload)}
        if len(payload) >= 1000 and newest[p] != p:
            assert [(r.record_type, r.refers_to, r.bytes) for r in rows] == [("revisit", newest[p], None)]
        else:
            assert {(r.record_type, r.refers_to) for r in rows} == {("response", None)}
            copies = len([1 for q, _, _ in ROWS if q == p])
            assert b"".join(bytes(r.bytes) for r in rows[::copies]) == payload
            seen = b""
            for r in rows[::copies]:
                seen += bytes(r.bytes)
                assert r.sha1_so_far == hashlib.sha1(seen).hexdigest() and len(r.bytes) <= 64


def test_archives_are_valid_gzip_members(spark):
    import gzip
    import os
    pages = spark.createDataFrame(ROWS[:3], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc-test")
    names = [r.archive for r in warc.write(warc.records(pages), folder).collect()]
    whole = b"".join(gzip.open(os.path.join(folder, n)).read() for n in names)
    assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == 3 and b"WARC-Refers-To: <urn:page:3>" in whole
    assert b"WARC-Target-URI: http://a/3%0D%0AX: y\r\n" in whole


def test_no_pages(spark):
    pages = spark.read.parquet(f"{SF0001}/pages.parquet").limit(0)
    assert warc.roundtrip(pages).collect() == []


def test_readers_grow_with_archives(spark, monkeypatch):
    """Adaptive execution leaves the readers apart."""
    monkeypatch.setattr(warc, "ARCHIVE", 10)
    pages = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "sha2(string(id), 256) AS html").repartition(8)
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write(warc.records(pages), folder)
    archives = manifest.count()
    assert archives >= 8
    back = warc.read(manifest, folder)
    assert back.rdd.getNumPartitions() == archives
    tasks = back.selectExpr("spark_partition_id() AS t").distinct().count()
    assert tasks > archives / 3
