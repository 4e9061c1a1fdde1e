"""Operator 8: WARC archives, written and assembled into captures.

Writing: each page becomes a response record (or a revisit of the record with the same
payload and the smallest id), a request and a metadata record, tied together by
WARC-Concurrent-To. Records are built as strings and written by Spark's text writer with
the record separator as line separator, so every executor writes through Spark's file
systems.

Reading: Spark's text reader splits the archives at record starts; a small parser puts the
byte stream of a file together again and cuts it by Content-Length, so a payload may hold
anything. Transaction assembly joins records through their concurrent-to ids, directly in
either direction or by way of one other record, into one nested row per capture.

Cases: null html is an empty payload; null urls and ids are written as empty values and
read back as null; of repeated ids with equal payloads one is the response; an empty table
gives no captures; other columns are not archived.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm.common import with_row

CRLF = "\r\n"
START = "WARC/1.0\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_HEX32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base32: each 10 hex digits are 40 bits, that is 8 digits to the base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def _urn(kind: str, row: Column) -> Column:
    """A record id that depends on the row alone."""
    h = F.md5(F.concat(F.lit(f"{kind}:"), row.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(kind: str, headers: list[tuple[str, Column | str | None]], block: Column) -> Column:
    """One record without the empty lines that end it."""
    parts: list[Column] = [F.lit(f"{START}WARC-Type: {kind}{CRLF}")]
    for name, value in headers:
        value = F.lit(value) if isinstance(value, str) else value
        parts += [F.lit(f"{name}: "), value, F.lit(CRLF)]
    size = F.octet_length(block).cast("string")
    return F.concat(*parts, F.lit("Content-Length: "), size, F.lit(CRLF + CRLF), block)


def captures_of(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Rows of pages with payload facts and, for revisits, the row that they revisit."""
    keyed = with_row(pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")))
    facts = keyed.select("_row", "page_id", base32_sha1(F.col("payload")).alias("digest"), F.octet_length("payload").alias("bytes"))
    first = (
        facts.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("null_id"), "page_id", "_row")).alias("first"))
    )
    marked = facts.join(first, ["digest", "bytes"], "left").select(
        "_row", "digest", "bytes", F.coalesce("first._row", "_row").alias("_of"))
    return keyed.join(marked, "_row")


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> None:
    """Write the archives of `pages` below `path`, one gzip file per task."""
    rows = captures_of(pages, least_bytes)
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7f]", "%20")
    rows = rows.withColumns({
        "url": clean, "id": _urn("capture", F.col("_row")), "of": _urn("capture", F.col("_of")),
        "digest": F.concat(F.lit("sha1:"), "digest")})
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(CRLF + CRLF))
    common = [("WARC-Target-URI", F.col("url")), ("WARC-Date", date)]
    response = _record("response", [
        ("WARC-Record-ID", F.col("id")), *common, ("WARC-Payload-Digest", F.col("digest")),
        ("Content-Type", "application/http; msgtype=response")], F.concat(http, "payload"))
    revisit = _record("revisit", [
        ("WARC-Record-ID", F.col("id")), *common, ("WARC-Payload-Digest", F.col("digest")), ("WARC-Refers-To", F.col("of")),
        ("WARC-Profile", PROFILE), ("Content-Type", "application/http; msgtype=response")], http)
    request = _record("request", [
        ("WARC-Record-ID", _urn("request", F.col("_row"))), *common, ("WARC-Concurrent-To", F.col("id")),
        ("Content-Type", "application/http; msgtype=request")],
        F.concat(F.lit("GET "), "url", F.lit(f" HTTP/1.1{CRLF}{CRLF}")))
    metadata = _record("metadata", [
        ("WARC-Record-ID", _urn("metadata", F.col("_row"))), *common, ("WARC-Concurrent-To", F.col("id")),
        ("Content-Type", "application/warc-fields")],
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(CRLF)))
    records = rows.select(F.explode(F.array(
        request, F.when(F.col("_of") == F.col("_row"), response).otherwise(revisit), metadata)).alias("value"))
    records.write.option("lineSep", CRLF + CRLF).option("compression", "gzip").text(path)


_FIELDS = (
    ("record_id", "warc-record-id"), ("type", "warc-type"), ("target_uri", "warc-target-uri"), ("date", "warc-date"),
    ("payload_digest", "warc-payload-digest"), ("refers_to", "warc-refers-to"),
)
_SCHEMA = ", ".join(f"{n} string" for n, _ in _FIELDS) + ", concurrent_to array<string>, http_length long, payload binary"


def _headers(raw: bytes) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for line in raw.decode("utf-8", "replace").split(CRLF):
        name, colon, value = line.partition(":")
        if colon:
            out.setdefault(name.strip().lower(), []).append(value.strip())
    return out


def parse(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Records of one archive from its bytes in pieces; only one record is held."""
    held = bytearray()
    more = True

    def until(n: int) -> bool:
        nonlocal more
        while more and len(held) < n:
            piece = next(chunks, None)
            if piece is None:
                more = False
            else:
                held.extend(piece)
        return len(held) >= n

    while True:
        while until(2) and held[:2] == b"\r\n":
            del held[:2]
        end = held.find(b"\r\n\r\n")
        while end < 0 and more:
            seen = len(held)
            until(seen + 1)
            end = held.find(b"\r\n\r\n", max(0, seen - 3))
        if end < 0:
            return
        head = _headers(bytes(held[:end]))
        size = int(head.get("content-length", ["0"])[0])
        until(end + 4 + size)
        yield head, bytes(held[end + 4:end + 4 + size])
        del held[:end + 4 + size]


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives below `path`; `payload` is the HTTP body, or the block."""
    separator = CRLF + CRLF + START
    lines = spark.read.option("lineSep", separator).text(path).select(
        F.input_file_name().alias("file"), F.col("value").cast("binary").alias("value"))
    joint = separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((f, v) for b in batches for f, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        ahead: list = [next(rows, None)]

        def one_file(name: str) -> Iterator[bytes]:
            first = True
            while ahead[0] is not None and ahead[0][0] == name:
                yield ahead[0][1] if first else joint + ahead[0][1]
                first = False
                ahead[0] = next(rows, None)

        schema = pa.schema([*[(n, pa.string()) for n, _ in _FIELDS], ("concurrent_to", pa.list_(pa.string())), ("http_length", pa.int64()), ("payload", pa.binary())])
        made, size = [], 0
        while ahead[0] is not None:
            for head, block in parse(one_file(ahead[0][0])):
                kind, length = head.get("warc-type", [""])[0], None
                if kind in ("response", "revisit"):
                    top, _, block = block.partition(b"\r\n\r\n")
                    length = int(_headers(top).get("content-length", [len(block)])[0])
                made.append({n: head.get(h, [None])[0] for n, h in _FIELDS} | {
                    "concurrent_to": head.get("warc-concurrent-to", []), "http_length": length, "payload": block})
                size += len(block)
                if size > 8_000_000 or len(made) >= 5000:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made, size = [], 0
        if made:
            yield pa.RecordBatch.from_pylist(made, schema)

    return lines.mapInArrow(run, _SCHEMA)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: its id, type, facts and `response`, and nested `parts`, the
    request and metadata records that belong to it."""
    main = F.col("type").isin("response", "revisit", "resource")
    captures = found.filter(main)
    others = found.filter(~main)
    tie = lambda rows: rows.select("record_id", F.explode("concurrent_to").alias("to"))
    ids = captures.select(F.col("record_id").alias("capture_id"))
    named = tie(others).join(ids, F.col("to") == F.col("capture_id")).select("record_id", "capture_id")
    naming = tie(captures).select(F.col("to").alias("record_id"), F.col("record_id").alias("capture_id"))
    direct = named.unionByName(naming)
    by_way = tie(others).join(direct.withColumnRenamed("record_id", "to"), "to").select("record_id", "capture_id")
    links = direct.unionByName(by_way).distinct()
    parts = others.join(links, "record_id").groupBy("capture_id").agg(
        F.sort_array(F.collect_list(F.struct("type", "record_id", "target_uri", "date", "payload"))).alias("parts"))
    return captures.join(parts, captures["record_id"] == parts["capture_id"], "left").select(
        captures["record_id"].alias("capture_id"), "type", "target_uri", "date", "payload_digest", "refers_to", "http_length",
        "payload", F.coalesce("parts", F.array().cast(parts.schema["parts"].dataType)).alias("parts"))


def page_ids(captures: DataFrame) -> DataFrame:
    """Add `page_id` from the metadata part."""
    fields = F.get(F.filter("parts", lambda p: p["type"] == "metadata"), F.lit(0))["payload"].cast("string")
    return captures.withColumn("page_id", F.nullif(F.regexp_extract(fields, r"page-id: *(-?\d*)", 1), F.lit("")).cast("long"))
