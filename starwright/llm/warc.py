"""WARC archives: writing captures, and assembling transactions from what is read back.

A capture is three records: the response (or a revisit of an earlier equal payload), the
request and the metadata, tied by ``WARC-Concurrent-To``.  Records are built by expressions and
written by Spark's text sink, whose line separator is the end of a record.  Reading parses each
file by ``Content-Length`` and checks payloads against their digests; the records are then
joined through their identifiers into one nested row per capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.llm.common import materialize, scratch_path, stored

END = "\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 6000
BATCH_RECORDS, BATCH_BYTES = 2000, 16 << 20


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal text of a multiple of ten digits (SHA-1 has 40)."""
    parts = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    return F.translate(F.concat(*parts), digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(capture: Column, part: str) -> Column:
    """A name for a capture's record, laid out as a UUID."""
    return F.regexp_replace(
        F.md5(F.concat_ws(":", capture.cast("string"), F.lit(part))),
        "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>",
    )


def _record(headers: dict[str, Column | str], block: Column) -> Column:
    """A record up to, but without, the empty lines that end it."""
    lines = [
        F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value))
        for name, value in headers.items()
    ]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    # A header without a value is left out.
    return F.concat(F.concat_ws(END, F.lit("WARC/1.1"), *lines, length), F.lit(END * 2), block)


def captures_of(
    pages: DataFrame, min_bytes: int, id_col: str, url_col: str, html_col: str
) -> DataFrame:
    """``capture, page_id, url, payload, size, digest, origin, refers_to``.

    ``capture`` numbers the rows.  The numbered rows are written once, so a repeated task
    cannot number them in another way.  Of equal payloads of at least ``min_bytes`` bytes, the
    row with the smallest page id (then number) is the origin.  Only payloads that occur more
    than once are looked up, by a join that Spark may split at a hot payload.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = stored(
        pages.select(
            F.monotonically_increasing_id().alias("capture"),
            F.col(id_col).alias("page_id"),
            F.col(url_col).alias("url"),
            payload.alias("payload"),
            F.octet_length(payload).cast("long").alias("size"),
            base32_of_hex(F.sha1(payload.cast("binary"))).alias("digest"),
        ),
        "warc-captures",
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("late"), "page_id", "capture"))
    origins = materialize(
        rows.where(F.col("size") >= min_bytes)
        .groupBy("digest")
        .agg(first.alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(
            "digest", F.col("first.capture").alias("origin"),
            F.col("first.page_id").alias("origin_page"),
        ),
        "warc-origins",
    )
    revisits = F.col("origin").isNotNull() & (F.col("origin") != F.col("capture"))
    return (
        rows.join(origins, "digest", "left")
        .withColumn("origin", F.when((F.col("size") >= min_bytes) & revisits, F.col("origin")))
        .withColumn("origin_page", F.when(F.col("origin").isNotNull(), F.col("origin_page")))
    )


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
) -> None:
    """Write three records per row of ``pages`` into compressed archives in ``folder``."""
    rows = captures_of(pages, min_bytes, id_col, url_col, html_col)
    revisit = F.col("origin").isNotNull()
    # A header is one line of visible characters; the metadata keeps the exact address.
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    response_id = _record_id(F.col("capture"), "response")
    head = F.concat(
        F.lit(f"{HTTP_HEAD}{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("size").cast("string"), F.lit(END * 2),
    )
    response = _record(
        {
            "WARC-Type": F.when(revisit, "revisit").otherwise("response"),
            "WARC-Record-ID": response_id,
            "WARC-Date": date,
            "WARC-Target-URI": target,
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), "digest"),
            "WARC-Profile": F.when(revisit, REVISIT_PROFILE),
            "WARC-Refers-To": F.when(revisit, _record_id(F.col("origin"), "response")),
            "Content-Type": "application/http; msgtype=response",
        },
        F.when(revisit, head).otherwise(F.concat(head, "payload")),
    )
    path = F.coalesce(F.regexp_extract(target, "^[^:/?#]*://[^/?#]*([^#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract(target, "^[^:/?#]*://([^/?#]*)", 1), F.lit(""))
    request = _record(
        {
            "WARC-Type": "request",
            "WARC-Record-ID": _record_id(F.col("capture"), "request"),
            "WARC-Date": date,
            "WARC-Target-URI": target,
            "WARC-Concurrent-To": response_id,
            "Content-Type": "application/http; msgtype=request",
        },
        F.concat(
            F.lit("GET "), F.when(path == "", "/").otherwise(path),
            F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END * 2),
        ),
    )
    known = F.struct(F.col("page_id"), F.col("url"), F.col("origin_page").alias("refers_to"))
    metadata = _record(
        {
            "WARC-Type": "metadata",
            "WARC-Record-ID": _record_id(F.col("capture"), "metadata"),
            "WARC-Date": date,
            "WARC-Target-URI": target,
            "WARC-Concurrent-To": response_id,
            "Content-Type": "application/json",
        },
        F.to_json(known),
    )
    (
        rows.select(F.explode(F.array(response, request, metadata)).alias("value"))
        .write.option("lineSep", END * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:stop].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        headers = {}
        for line in lines:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        start = stop + 4
        stop = start + int(headers["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length than it says")
        yield headers, data[start:stop]
        at = stop + 4


RECORD_FIELDS = [
    ("record_id", "string"), ("record_type", "string"), ("concurrent_to", "string"),
    ("refers_to", "string"), ("target_uri", "string"), ("date", "string"),
    ("content_type", "string"), ("payload_digest", "string"), ("payload_bytes", "long"),
    ("head", "string"), ("payload", "binary"),
]
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _parsed(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A record as a row.  A payload is checked against its digest."""
    head, payload, size = "", block, len(block)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if headers.get("content-type", "").startswith("application/http"):
        top, _, payload = block.partition(b"\r\n\r\n")
        head, size = top.decode(), len(payload)
    kind = headers["warc-type"]
    if kind == "revisit":
        sizes = [x for x in head.split("\r\n") if x.lower().startswith("content-length:")]
        size = int(sizes[0].partition(":")[2]) if sizes else size
    elif kind == "response" and digest:
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"the payload of {headers['warc-record-id']} is damaged")
    # Small blocks of metadata are always kept; a response's payload if asked for.
    kept = payload if with_payload or kind == "metadata" else None
    return (
        headers["warc-record-id"], kind, headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"), headers.get("warc-target-uri"), headers.get("warc-date"),
        headers.get("content-type"), digest, size, head, kept,
    )


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives (compressed or not) in a folder."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, _ARROW[k]) for c, (_, k) in zip(zip(*rows), RECORD_FIELDS)],
                names=[name for name, _ in RECORD_FIELDS],
            )

        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                rows, size = [], 0
                for headers, block in records_in(data):
                    rows.append(_parsed(headers, block, with_payload))
                    size += len(block)
                    if len(rows) >= BATCH_RECORDS or size >= BATCH_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInArrow(parse, ", ".join(f"{name} {kind}" for name, kind in RECORD_FIELDS))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, requests, metadata``.

    ``response`` is the response or revisit record.  Requests and metadata belong to the
    response that they name as concurrent, or that names them.  A capture has few records, so
    the lists are short; a record that names no known response belongs to no capture.
    """
    answers = records.where(F.col("record_type").isin("response", "revisit"))
    others = records.where(F.col("record_type").isin("request", "metadata"))
    named = answers.where(F.col("concurrent_to").isNotNull()).select(
        F.col("concurrent_to").alias("record_id"), F.col("record_id").alias("capture_id")
    )
    direct = others.where(F.col("concurrent_to").isNotNull()).withColumn(
        "capture_id", F.col("concurrent_to")
    )
    indirect = others.where(F.col("concurrent_to").isNull()).join(named, "record_id")
    fields = [name for name, _ in RECORD_FIELDS]
    record = F.struct(*fields)
    tied = (
        direct.select("capture_id", *fields)
        .unionAll(indirect.select("capture_id", *fields))
        .groupBy("capture_id")
        .agg(
            F.collect_list(F.when(F.col("record_type") == "request", record)).alias("requests"),
            F.collect_list(F.when(F.col("record_type") == "metadata", record)).alias("metadata"),
        )
    )
    return answers.select(F.col("record_id").alias("capture_id"), record.alias("response")).join(
        tied, "capture_id", "left"
    )


def round_trip(
    pages: DataFrame, min_bytes: int = 0,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    folder: str | None = None,
) -> DataFrame:
    """Write the archives, read them back and describe each page from its capture.

    One row per page: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.  A
    null page is an empty payload.  Rows with null ids count as larger than all others; of
    rows with one id and one payload a single one is the response.  An empty table gives no
    row.  Other columns of ``pages`` are left out.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    write_archives(pages, folder, min_bytes, id_col=id_col, url_col=url_col, html_col=html_col)
    # The records without their payloads, written once since several joins read them.
    records = stored(read_records(spark, folder, with_payload=False), "warc-records")
    captures = assemble(records)
    kind = pages.schema[id_col].dataType.simpleString()
    known = F.from_json(
        F.element_at("metadata", 1)["payload"].cast("string"),
        f"page_id {kind}, url string, refers_to {kind}",
    )
    return captures.select(
        known["page_id"].alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        known["refers_to"].alias("refers_to"),
    )
