"""WARC archives: bytes as written, and captures assembled from them."""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starwright.llm import warc
from tests.llm.conftest import framed

PAGES = "page_id long, url string, html string"


def plain_pages(rows, min_bytes):
    """Rows of one id and one payload: a single one is the response."""
    smallest = {}
    for i, _, html in rows:
        data = (html or "").encode()
        key = (i is None, i or 0)
        smallest[data] = min(key, smallest.get(data, key))
    used = set()
    for i, _, html in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        late, origin = smallest[data]
        first = (late, origin) == (i is None, i or 0) and data not in used
        if first or len(data) < min_bytes:
            used.add(data)
            yield i, len(data), digest, "response", None
        else:
            yield i, len(data), digest, "revisit", None if late else origin


@pytest.fixture(scope="module")
def pages():
    rows = [(i, f"http://host/{i}?q#f", f"<p>page {i % 40} é漢</p>" * (i % 3)) for i in range(150)]
    return rows + [
        (900, None, None), (None, "", ""), (None, "x", "only here"),
        (901, "http://x y\r\nInjected: 1\r\n\r\nz", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"),
        (902, "not an address", "long " * 200_000), (7, "again", "<p>page 7 é漢</p>"),
        (903, "u", "twice"), (903, "u", "twice"),
    ]


@pytest.mark.parametrize("min_bytes", [0, 20])
def test_pages_come_back(spark, pages, min_bytes, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 50)
    monkeypatch.setattr(warc, "BATCH_RECORDS", 7)
    found = warc.round_trip(framed(spark, pages, PAGES).repartition(3), min_bytes)
    assert Counter(map(tuple, found.collect())) == Counter(plain_pages(pages, min_bytes))


def test_no_pages(spark):
    assert warc.round_trip(framed(spark, [], PAGES)).count() == 0


def test_archives_and_nested_captures(spark, tmp_path):
    rows = [(1, "http://a.example/x?y=1", "<p>é</p>"), (2, "http://b.example", "<p>é</p>")]
    folder = str(tmp_path / "archive")
    warc.write_archives(spark.createDataFrame(rows, PAGES).coalesce(1), folder)
    files = [p for p in Path(folder).iterdir() if p.name.startswith("part-")]
    data = b"".join(gzip.decompress(p.read_bytes()) for p in files)
    records = list(warc.records_in(data))
    assert [h["warc-type"] for h, _ in records] == [
        "response", "request", "metadata", "revisit", "request", "metadata",
    ]
    assert records[0][1].endswith("\r\n\r\n<p>é</p>".encode())
    assert records[3][0]["warc-refers-to"] == records[0][0]["warc-record-id"]
    assert records[1][0]["warc-concurrent-to"] == records[0][0]["warc-record-id"]
    assert records[1][1] == b"GET /x?y=1 HTTP/1.1\r\nHost: a.example\r\n\r\n"
    captures = warc.assemble(warc.read_records(spark, folder)).orderBy("response.target_uri")
    first, second = captures.collect()
    assert first.response.payload == "<p>é</p>".encode()
    assert [len(row.requests) for row in (first, second)] == [1, 1]
    assert first.metadata[0].record_type == "metadata"
    assert second.response.record_type == "revisit" and second.response.payload_bytes == 9


def test_concurrent_to_in_either_direction(spark):
    fields = {name: None for name, _ in warc.RECORD_FIELDS}
    schema = ", ".join(f"{name} {kind}" for name, kind in warc.RECORD_FIELDS)

    def record(**values):
        return tuple((fields | values).values())

    records = spark.createDataFrame([
        record(record_id="r1", record_type="response", concurrent_to="q1"),
        record(record_id="q1", record_type="request"),
        record(record_id="m1", record_type="metadata", concurrent_to="r1"),
        record(record_id="r2", record_type="response"),
        record(record_id="lost", record_type="request", concurrent_to="nowhere"),
    ], schema)
    found = {
        row.capture_id: ([x.record_id for x in row.requests or []],
                         [x.record_id for x in row.metadata or []])
        for row in warc.assemble(records).collect()
    }
    assert found == {"r1": (["q1"], ["m1"]), "r2": ([], [])}


@pytest.mark.parametrize("change", [
    lambda data: data.replace(b"Content-Length: ", b"Content-Length: 1", 1),
    lambda data: data[:-6] + data[-4:],
    lambda data: b"x" + data,
])
def test_damaged_archives_are_refused(spark, tmp_path, change):
    folder = tmp_path / "archive"
    warc.write_archives(spark.createDataFrame([(1, "u", "page")], PAGES).coalesce(1), str(folder))
    data = gzip.decompress(next(p for p in folder.iterdir() if p.suffix == ".gz").read_bytes())
    with pytest.raises((ValueError, KeyError)):
        list(warc.records_in(change(data)))


def test_base32_of_a_digest(spark):
    text = "some payload"
    row = spark.createDataFrame([(text,)], "x string").select(
        warc.base32_of_hex(F.sha1(F.col("x").cast("binary"))).alias("d")
    ).first()
    assert row.d == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
