"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is written as three records: a response (or, where the same payload is archived
under a larger page id, a revisit without payload), its request, and a metadata record.
Request and metadata name the capture in WARC-Concurrent-To. Archives are text files of
whole records, cut by number of records, whose line separator is the two line ends that
close a record; so Spark's own writer makes them, in any store, and a lost task writes its
file again.

Reading takes whole archive files (a file is the unit of work), follows Content-Length, so
payloads may hold anything, and joins the records of a capture through their identifiers
into one nested row.

Rows: each page row is one capture; a repeated row gives equal records, which count. Null
html: empty payload. Null url: empty target. Null page id: written as empty, read as null.
Among pages with equal payloads the largest page id is the response; a null id never is,
unless all are null. Empty table: no archives, no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.ship import ship
from cartwise.session import materialize, new_path

END = "\r\n\r\n"
RECORDS_A_FILE = 6000
BATCH_BYTES = 8 << 20
# The alphabet of base 32 (RFC 4648) and that of numbers in base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
NUMERALS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1 of a string's bytes; five hex digits are four of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), NUMERALS, BASE32)


def _identifier(kind: str, *keys: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys]))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column | str, record_id: Column, headers: list[tuple[str, Column]], mime: str, block: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit("\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {DATE}\r\n")]
    for name, value in headers:
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    lines += [F.lit(f"Content-Type: {mime}\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END), block]
    return F.concat(*lines)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write the captures of ``pages`` (page_id, url, html) as compressed archives.

    Payloads of at least ``least_bytes`` that occur again are written once.
    """
    rows = pages.select(
        "page_id",
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("digest", base32_sha1(F.col("html")))
    # One row for each payload that occurs twice or more; counts combine before the shuffle.
    again = (
        rows.where(F.octet_length("html") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.max(F.struct("page_id", "url")).alias("top"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("digest", "first", F.col("top.url").alias("first_url"))
    )
    again = materialize(again, "payloads")
    joined = rows.join(again, "digest", "left")
    response = F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first"))
    record_id = _identifier("response", F.col("page_id"), F.col("url"), F.col("digest"))
    of_first = _identifier("response", F.col("first"), F.col("first_url"), F.col("digest"))
    size = F.octet_length("html").cast("string")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END))
    target = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    capture = F.when(
        response, _record("response", record_id, [target, digest], "application/http;msgtype=response", F.concat(head, F.col("html")))
    ).otherwise(
        _record(
            "revisit",
            record_id,
            [target, digest, ("WARC-Profile", F.lit(PROFILE)), ("WARC-Refers-To", of_first)],
            "application/http;msgtype=response",
            head,
        )
    )
    concurrent = ("WARC-Concurrent-To", record_id)
    same = [F.col("page_id"), F.col("url"), F.col("digest")]
    request = _record(
        "request",
        _identifier("request", *same),
        [target, concurrent],
        "application/http;msgtype=request",
        F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{END}")),
    )
    metadata = _record(
        "metadata",
        _identifier("metadata", *same),
        [target, concurrent],
        "application/warc-fields",
        F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n")),
    )
    joined.select(F.explode(F.array(request, capture, metadata)).alias("value")).write.option("lineSep", END).option(
        "maxRecordsPerFile", RECORDS_A_FILE
    ).option("compression", "gzip").text(path)


def _parsed(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of the records of one archive."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while at < len(content):
        end = content.find(b"\r\n\r\n", at)
        if end < 0 or not content.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        for line in content[at:end].decode("utf-8", "replace").split("\r\n")[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        start = end + 4
        stop = start + int(headers["content-length"])
        if stop > len(content):
            raise ValueError(f"record at byte {at} is cut off")
        yield headers, content[start:stop]
        at = stop + 4


SCHEMA = (
    "kind string, record_id string, concurrent_to string, refers_to string, target string, "
    "stated_digest string, payload_bytes long, payload_digest string, page_id long, payload binary"
)


def _read_batches(with_payload: bool):
    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind = headers.get("warc-type")
        payload = block
        if headers.get("content-type", "").startswith("application/http"):
            payload = block.partition(b"\r\n\r\n")[2]
        page = None
        if kind == "metadata":
            fields = dict(line.partition(b":")[::2] for line in block.split(b"\r\n") if b":" in line)
            text = fields.get(b"page-id", b"").strip()
            page = int(text) if text else None
        stated = headers.get("warc-payload-digest")
        return (
            kind,
            headers.get("warc-record-id"),
            headers.get("warc-concurrent-to"),
            headers.get("warc-refers-to"),
            headers.get("warc-target-uri"),
            stated.partition(":")[2] if stated else None,
            len(payload),
            base64.b32encode(hashlib.sha1(payload).digest()).decode(),
            page,
            payload if with_payload else None,
        )

    types = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [part.split()[0] for part in SCHEMA.split(",")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch["content"]:
                rows, held = [], 0
                for headers, block in _parsed(content.as_py()):
                    rows.append(row(headers, block))
                    held += len(block) if with_payload else 256
                    if held > BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record of the archives under ``path``; lengths and digests as read."""
    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read_batches(with_payload), SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: response (or revisit), request, metadata.

    Metadata may name the capture or its request. Of several requests or metadata records
    of one capture the smallest identifier stands; ``requests`` and ``metadatas`` count
    them. Captures without them have nulls; equal captures give equal rows.
    """
    every = F.struct(*[F.col(c) for c in records.columns])
    kept = records.withColumn("record", every)
    captures = kept.where(F.col("kind").isin("response", "revisit")).groupBy("record_id").agg(
        F.count(F.lit(1)).alias("copies"), F.first("record").alias("response")
    )
    requests = (
        kept.where("kind = 'request'")
        .groupBy(F.col("concurrent_to").alias("record_id"))
        .agg(F.min_by("record", "record_id").alias("request"), F.count(F.lit(1)).alias("requests"))
    )
    asked = records.where("kind = 'request'").select(F.col("record_id").alias("asked_id"), F.col("concurrent_to").alias("asked_of")).distinct()
    metadata = (
        kept.where("kind = 'metadata'")
        .join(asked, F.col("concurrent_to") == F.col("asked_id"), "left")
        .groupBy(F.coalesce("asked_of", "concurrent_to").alias("record_id"))
        .agg(F.min_by("record", "record_id").alias("metadata"), F.count(F.lit(1)).alias("metadatas"))
    )
    joined = captures.join(requests, "record_id", "left").join(metadata, "record_id", "left")
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("copy", "copies")


def page_digests(pages: DataFrame) -> DataFrame:
    """Write archives of all pages, read them back, and report each page's payload.

    page_id, payload_bytes, payload_digest, record_type and refers_to (page id of the
    response that a revisit stands for). A revisit's payload is that of its response.
    """
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write_archives(pages, path)
    captures = assemble(materialize(read_records(spark, path, with_payload=False).drop("payload"), "records"))
    found = materialize(
        captures.select(
            "record_id",
            F.col("metadata.page_id").alias("page_id"),
            F.col("response.kind").alias("record_type"),
            F.col("response.refers_to").alias("first_id"),
            F.col("response.payload_bytes").alias("payload_bytes"),
            F.col("response.payload_digest").alias("payload_digest"),
        ),
        "captures",
    )
    first = (
        found.where("record_type = 'response'")
        .groupBy(F.col("record_id").alias("first_id"))
        .agg(F.first("page_id").alias("refers_to"), F.first("payload_bytes").alias("full_bytes"), F.first("payload_digest").alias("full_digest"))
    )
    first = materialize(first.join(found.select("first_id").where("first_id is not null").distinct(), "first_id", "left_semi"), "firsts")
    return found.join(first, "first_id", "left").select(
        "page_id",
        F.coalesce("full_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("full_digest", "payload_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )
