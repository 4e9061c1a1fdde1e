"""WARC round trip with payloads that look like records."""

import base64
import hashlib
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import warc

NASTY = [
    "<html>plain</html>", "", None, "ends with\r\n", "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n",
    "a\r\n\r\nWARC/1.0\r\n", "\r\n\r\n\r\n\r\nWARC/1.0\r\n\r\n\r\nWARC/1.0\r\n", "éü🙂 " * 3000, "<html>plain</html>", "x" * 400_000,
    "\x00\x01 binary-ish \x1a", "<html>plain</html>", "Content-Length: 9\r\n\r\n",
]


def base32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def captures(spark, pages, tmp_path, least=0):
    path = str(tmp_path / "warc")
    warc.write(pages, path, least_bytes=least)
    return warc.page_ids(warc.assemble(warc.records(spark, path)))


@pytest.fixture
def pages(spark, tmp_path):
    # Ids down to -3.
    rows = [(9 - i, f"http://h{i}.example/a b?\r\nx={i}" if i % 4 else None, t) for i, t in enumerate(NASTY)]
    made = cases.with_clashes(spark.createDataFrame(rows, "page_id long, url string, html string"), "digest", "bytes")
    made.repartition(3).write.parquet(str(tmp_path / "pages"))
    return spark.read.parquet(str(tmp_path / "pages"))


def test_base32(spark):
    rows = spark.createDataFrame([(t,) for t in NASTY if t is not None], "t string").select("t", warc.base32_sha1(F.col("t")).alias("d")).collect()
    assert all(r["d"] == base32(r["t"]) for r in rows)


def test_round_trip(spark, pages, tmp_path):
    rows = captures(spark, pages, tmp_path).collect()
    source = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    assert Counter(r["page_id"] for r in rows) == Counter(list(source))
    first = {t: min(k for k, v in source.items() if v == t) for t in source.values()}
    of = {r["capture_id"]: r["page_id"] for r in rows}
    for r in rows:
        text = source[r["page_id"]]
        assert r["payload_digest"] == f"sha1:{base32(text)}" and r["http_length"] == len(text.encode())
        assert r["type"] == ("response" if first[text] == r["page_id"] else "revisit")
        assert of.get(r["refers_to"]) == (None if r["type"] == "response" else first[text])
        assert bytes(r["payload"]) == (text.encode() if r["type"] == "response" else b"")
        assert [p["type"] for p in r["parts"]] == ["metadata", "request"]


def test_small_payloads_are_not_revisited(spark, pages, tmp_path):
    kinds = Counter(r["type"] for r in captures(spark, pages, tmp_path, least=10_000_000).collect())
    assert kinds == {"response": len(NASTY)}


def test_cases(spark, tmp_path):
    rows = [(1, "u", "same"), (1, "u", "same"), (None, None, "same"), (None, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = captures(spark, pages, tmp_path).collect()
    assert Counter(r["type"] for r in got) == {"response": 2, "revisit": 2}
    assert Counter(r["page_id"] for r in got) == {1: 2, None: 2}
    assert captures(spark, cases.empty(pages), tmp_path / "none").count() == 0


def test_parts_tied_the_other_way_and_by_way_of_another(spark):
    schema = warc._SCHEMA
    rows = [
        ("r1", "response", "u", "d", "x", None, ["q1"], 1, b"a"), ("q1", "request", "u", "d", None, None, [], None, b"q"),
        ("m1", "metadata", "u", "d", None, None, ["q1"], None, b"page-id: 5"), ("r2", "response", "u", "d", "x", None, [], 1, b"b"),
        ("lost", "metadata", "u", "d", None, None, ["gone"], None, b"page-id: 6"),
    ]
    got = {r["capture_id"]: r for r in warc.page_ids(warc.assemble(spark.createDataFrame(rows, schema))).collect()}
    assert [p["record_id"] for p in got["r1"]["parts"]] == ["m1", "q1"] and got["r1"]["page_id"] == 5
    assert got["r2"]["parts"] == [] and got["r2"]["page_id"] is None and len(got) == 2


def test_parser_takes_pieces_of_any_size():
    stream = b"WARC/1.0\r\nContent-Length: 5\r\nA: b\r\n\r\nhello\r\n\r\nWARC/1.0\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for size in (1, 2, 3, 7, 1000):
        pieces = (stream[i:i + size] for i in range(0, len(stream), size))
        assert [block for _, block in warc.parse(pieces)] == [b"hello", b""]
