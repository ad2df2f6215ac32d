"""Web archives: writing WARC files and reading them back with segment reassembly.

Writing: a page becomes a response record, or a revisit record if a page with an equal
payload and a larger id exists. The payload is framed as an HTTP body in chunks; a block
longer than SEGMENT_CHARS is cut into a first segment and continuation records that name
its record id as their origin, the last of which states the total length. Spark's text
writer puts the records into files, with the two empty lines that end a record as line
separator, and a row limit per file, so segments bound the size of every file. Files are
compressed with gzip.

Reading: files are parsed record by record by Content-Length; continuation records are
grouped by origin, ordered by segment number and joined, the total length is verified, the
chunked framing is decoded, and the payload digest is compared with the one in the header.
Records that are whole already pass without a shuffle; a group is one page's segments.

Defined results
  - a null html is an empty payload; null urls are written as an empty target;
  - of equal pages with equal ids one is the response and the others revisit it; null ids
    are smaller than all others and are read back as null;
  - archives with missing or surplus segments, a wrong total or a wrong digest raise an
    error that names the record; empty tables give an empty result;
  - other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkgauge.session import fresh_path

SEGMENT_CHARS = 16_384  # a segment has at most so many characters, so at most four times as many bytes
CHUNK_CHARS = 4_096
RECORDS_PER_FILE = 1_024
END_OF_RECORD = "\r\n\r\n"
# The date of all records; a capture date would come from the crawl.
DATE = "2024-01-01T00:00:00Z"

_HEADER = re.compile(r"([^:\r\n]+):[ \t]*([^\r\n]*)")


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(text: str) -> str:
    """HTTP/1.1 chunked framing; chunks end between characters."""
    parts = [text[i : i + CHUNK_CHARS] for i in range(0, len(text), CHUNK_CHARS)]
    return "".join(f"{len(p.encode()):x}\r\n{p}\r\n" for p in parts) + "0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk without an end")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, str]], block: str) -> str:
    fields = [*fields, ("Content-Length", str(len(block.encode())))]
    return "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n" + block


def page_records(key: str, url: str, html: str, digest: str, refers_to: str | None) -> Iterator[str]:
    """The records of a page without the end of record. key and refers_to are row keys."""
    rid = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, key)}>"
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    common = [("WARC-Target-URI", url), ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Row-Key", key)]
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    kind = ("Content-Type", "application/http; msgtype=response")
    if refers_to is not None:
        more = [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, refers_to)}>"),
            ("X-Refers-To-Key", refers_to),
            ("X-Payload-Length", str(len(html.encode()))),
        ]
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", rid), *common, kind, *more], http)
        return
    block = http + chunked(html)
    parts = [block[i : i + SEGMENT_CHARS] for i in range(0, len(block), SEGMENT_CHARS)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", rid), *common, kind]
    if len(parts) == 1:
        yield _record(first, block)
        return
    yield _record([*first, ("WARC-Segment-Number", "1")], parts[0])
    for i, part in enumerate(parts[1:], 2):
        fields = [
            ("WARC-Type", "continuation"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{key}/{i}')}>"),
            ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", rid),
            ("WARC-Segment-Number", str(i)),
        ]
        if i == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(block.encode()))))
        yield _record(fields, part)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        payloads = [(x.as_py() or "").encode() for x in batch.column(3)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(map(base32_sha1, payloads), pa.string()), pa.array(map(len, payloads), pa.int64())],
            names=["uid", "page_id", "url", "html", "digest", "size"],
        )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[str] = []
        for key, url, html, digest, to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            out.extend(page_records(key, url or "", html or "", digest, to))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Write the pages (page_id, url, html) as WARC files under path.

    Row keys are `uid:page_id`; the response of equal payloads is the row with the largest
    (page_id, uid). Payloads under min_revisit_bytes are all written as responses.
    """
    rows = pages.select(
        F.monotonically_increasing_id().alias("uid"), F.col("page_id").cast("long").alias("page_id"), F.col("url"), F.col("html")
    ).mapInArrow(_digests, "uid long, page_id long, url string, html string, digest string, size long")
    key = F.concat_ws(":", "uid", F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    rows = rows.withColumn("key", key)
    first = (
        rows.filter(F.col("size") >= min_revisit_bytes)
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "uid")).alias("top"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select("digest", F.concat_ws(":", "top.uid", F.coalesce(F.col("top.page_id").cast("string"), F.lit(""))).alias("first"))
    )
    revisits = F.when((F.col("first") != F.col("key")) & (F.col("size") >= min_revisit_bytes), F.col("first"))
    records = rows.join(first, "digest", "left").select("key", "url", "html", "digest", revisits.alias("to"))
    (
        records.mapInArrow(_records, "value string")
        .write.option("lineSep", END_OF_RECORD)
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .option("compression", "gzip")
        .text(path)
    )


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record of a file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        head = data[at:end].decode()
        if not head.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v for k, v in _HEADER.findall(head.split("\r\n", 1)[1])}
        begin, size = end + 4, int(fields["content-length"])
        if data[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} has no end")
        yield fields, data[begin : begin + size]
        at = begin + size + 4


def _unpacked(data: bytes) -> bytes:
    """Content of a file, gzip (any number of members) or plain."""
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


SEGMENT = (
    "origin string, number int, total long, type string, uri string, key string, refers_to string, digest string, "
    "length long, block binary"
)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.strip().split()[0] for x in SEGMENT.split(",")]
    kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    for batch in batches:
        for data in batch.column(0):
            rows = []
            for f, block in parse_records(_unpacked(data.as_py())):
                total, length = f.get("warc-segment-total-length"), f.get("x-payload-length")
                rows.append(
                    (
                        f.get("warc-segment-origin-id") or f["warc-record-id"],
                        int(f.get("warc-segment-number", 0)),
                        int(total) if total else None,
                        f["warc-type"],
                        f.get("warc-target-uri"),
                        f.get("x-row-key"),
                        f.get("x-refers-to-key"),
                        (f.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
                        int(length) if length else None,
                        block,
                    )
                )
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records -> payload and its digest, checked; revisits keep what their header says."""
    for batch in batches:
        blocks, kinds, said, lengths, origins = (batch.column(c).to_pylist() for c in ("block", "type", "digest", "length", "origin"))
        sizes, digests, payloads = [], [], []
        for block, kind, digest, length, origin in zip(blocks, kinds, said, lengths, origins, strict=True):
            if kind == "revisit":
                sizes.append(length)
                digests.append(digest)
                payloads.append(None)
                continue
            head, _, body = block.partition(b"\r\n\r\n")
            payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
            if digest and base32_sha1(payload) != digest:
                raise ValueError(f"payload of {origin} does not have its digest")
            sizes.append(len(payload))
            digests.append(base32_sha1(payload))
            payloads.append(payload)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("uri"),
                batch.column("type"),
                batch.column("refers_to"),
                pa.array(sizes, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(payloads, pa.binary()),
            ],
            names=["key", "uri", "record_type", "refers_key", "payload_bytes", "payload_digest", "payload"],
        )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per whole record: key, uri, record_type, refers_key, payload_bytes, payload_digest, payload."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0").select("content")
    segments = files.mapInArrow(_segments, SEGMENT)
    whole = segments.filter("number = 0").drop("number", "total")
    parts = segments.filter("number > 0")
    joined = parts.groupBy("origin").agg(
        F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"),
        F.max("total").alias("total"),
        *[F.max(c).alias(c) for c in ("uri", "key", "refers_to", "digest", "length")],
        F.max(F.when(F.col("number") == 1, F.col("type"))).alias("type"),
    )
    numbers = F.transform("parts", lambda p: p["number"])
    block = F.aggregate(F.transform("parts", lambda p: p["block"]), F.lit(b""), lambda a, b: F.concat(a, b))
    complete = (numbers == F.sequence(F.lit(1), F.size("parts"))) & (F.octet_length("block") == F.col("total")) & F.col("type").isNotNull()
    joined = joined.withColumn("block", block).withColumn(
        "block",
        F.when(complete, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("segments of "), "origin", F.lit(" are not whole")))),
    )
    rows = whole.unionByName(joined.select(*whole.columns))
    return rows.mapInArrow(
        _payloads,
        "key string, uri string, record_type string, refers_key string, payload_bytes long, payload_digest string, payload binary",
    )


def archive_round_trip(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write the pages, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, min_revisit_bytes)
    page = lambda key: F.substring_index(key, ":", -1).try_cast("long")  # noqa: E731  an empty id is a null id
    return read_archives(spark, path).select(
        page("key").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_key").alias("refers_to"),
    )
