"""WARC archives: writing with segments and revisits, reading with reassembly.

Payloads are sent in chunked transfer framing.  A block over `segment_bytes` is split: its
first part stays a response record, the others become continuation records that name the
first one's id and their number; the last tells the total length.  A payload that another
page has already is written as a revisit of it.  Archives are gzip files in the shared folder.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed values of the format.
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
# Records handed on at once.
BATCH_BYTES = 8 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PARSED = (
    "page_id bigint, uri string, type string, origin string, segment int, total bigint, "
    "digest string, refers_to bigint, block binary"
)
READ = "page_id bigint, uri string, record_type string, refers_to bigint, payload_digest string, payload binary"


@dataclass(frozen=True)
class Archive:
    """segment_bytes: longest block of a record.  chunk_bytes: payload bytes per transfer chunk.
    file_records: pages per archive file.  date: capture date written to all records.
    """

    segment_bytes: int = 16_384
    chunk_bytes: int = 4_096
    file_records: int = 2_000
    date: str = "2024-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in parts) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The payload of chunked framing; chunk extensions and trailers are skipped."""
    parts, at = [], 0
    while True:
        line_end = framed.index(b"\r\n", at)
        size = int(framed[at:line_end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        start = line_end + 2
        if framed[start + size : start + size + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(framed[start : start + size])
        at = start + size + 2


def _record(kind: str, record_id: str, block: bytes, how: Archive, **fields) -> bytes:
    """One record without the two line ends after it."""
    lines = [VERSION, f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <{record_id}>".encode(), f"WARC-Date: {how.date}".encode()]
    for name, value in fields.items():
        if value is not None:
            lines.append(f"{name.replace('_', '-')}: {' '.join(str(value).split())}".encode())
    if kind != "continuation":
        lines.append(b"Content-Type: application/http; msgtype=response")
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + END + block


def page_records(page_id: int | None, uri: str | None, payload: bytes, first: int | None, revisits: bool, how: Archive) -> Iterator[bytes]:
    """The records of one page; `first` is the smallest page with the same payload."""
    digest = payload_digest(payload)
    name = lambda *parts: uuid.uuid5(uuid.NAMESPACE_URL, "|".join(map(str, parts))).urn
    record_id = name(page_id, digest)
    fields = {"WARC_Target_URI": uri, "WARC_Payload_Digest": f"sha1:{digest}", "WARC_Page_ID": page_id}
    header = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if revisits:
        yield _record("revisit", record_id, header, how, **fields, WARC_Profile=PROFILE,
                      WARC_Refers_To=f"<{name(first, digest)}>", WARC_Refers_To_Page_ID=first)
        return
    block = header + chunked(payload, how.chunk_bytes)
    parts = [block[i : i + how.segment_bytes] for i in range(0, len(block), how.segment_bytes)]
    if len(parts) == 1:
        yield _record("response", record_id, block, how, **fields)
        return
    yield _record("response", record_id, parts[0], how, **fields, WARC_Segment_Number=1)
    for number, part in enumerate(parts[1:], 2):
        total = len(block) if number == len(parts) else None
        yield _record("continuation", name(record_id, number), part, how, WARC_Target_URI=uri,
                      WARC_Segment_Origin_ID=f"<{record_id}>", WARC_Segment_Number=number,
                      WARC_Segment_Total_Length=total)


def write_warc(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html",
               least_bytes: int = 0, how: Archive = Archive()) -> None:
    """Write one record per row and its continuations.

    Of rows with equal payloads of at least `least_bytes` the one with the smallest id is a
    response and the others revisit it; rows that repeat that id are responses too.  A null
    payload is empty.  A null id counts as larger than all others.
    """
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("uri"),
        F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    # The hot digest is one row on the right side; adaptive execution splits its rows on the left.
    firsts = rows.groupBy("sha1").agg(F.min("page_id").alias("first"))
    known = rows.join(firsts, "sha1").withColumn(
        "revisits", (F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256).to_pylist()
                records = [r for row in part for r in page_records(
                    row["page_id"], row["uri"], row["payload"].encode(), row["first"], row["revisits"], how)]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["value"])

    records = known.select("page_id", "uri", "payload", "first", "revisits").mapInArrow(run, "value binary")
    # The line separator of the writer is what follows every record.  Blocks are bytes, not letters; the cast keeps them.
    records.select(F.col("value").cast("string").alias("value")).write.option("lineSep", END.decode()).option(
        "compression", "gzip"
    ).option("maxRecordsPerFile", how.file_records).text(path)


def parse(archive: bytes | BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, names in lower case, and block of every record of an archive, one record in memory at a time."""
    file = io.BytesIO(archive) if isinstance(archive, bytes) else archive
    at = 0
    while first := file.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        lines = []
        while (line := file.readline()) != b"\r\n":
            if not line:
                raise ValueError(f"the header at byte {at} does not end")
            lines.append(line.decode("utf-8", "replace"))
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        block = file.read(int(fields["content-length"]))
        if file.read(len(END)) != END:
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield fields, block
        at = file.tell()


def http_payload(block: bytes) -> bytes:
    """The decoded body of an HTTP response."""
    head, _, body = block.partition(END)
    framed = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(b"\r\n"))
    return unchunked(body) if framed else body


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _decoded(rows: list[dict]) -> pa.RecordBatch:
    payloads = [None if r["type"] == "revisit" else http_payload(r["block"]) for r in rows]
    digests = [r["digest"] if p is None else payload_digest(p) for r, p in zip(rows, payloads)]
    for row, digest in zip(rows, digests):
        if row["digest"] and row["digest"] != digest:
            raise ValueError(f"payload of page {row['page_id']} does not match its digest")
    return pa.RecordBatch.from_arrays(
        [pa.array([r["page_id"] for r in rows], pa.int64()), pa.array([r["uri"] for r in rows], pa.string()),
         pa.array([r["type"] for r in rows], pa.string()), pa.array([r["refers_to"] for r in rows], pa.int64()),
         pa.array(digests, pa.string()), pa.array(payloads, pa.binary())],
        ["page_id", "uri", "record_type", "refers_to", "payload_digest", "payload"],
    )


def reassemble(segments: list[dict]) -> list[dict]:
    """One row per copy of a record from all its segments: ordered, complete and of the announced length.

    Repeated rows wrote the same segments several times; each copy gives a row.
    """
    numbers = sorted({s["segment"] for s in segments})
    by_number = {s["segment"]: s for s in segments}
    total = by_number[numbers[-1]]["total"]
    block = b"".join(by_number[n]["block"] for n in numbers)
    if numbers != list(range(1, len(numbers) + 1)) or total != len(block):
        raise ValueError(f"record {segments[0]['origin']}: segments {numbers} hold {len(block)} of {total} bytes")
    copies = sum(s["segment"] == 1 for s in segments)
    return [by_number[1] | {"block": block}] * copies


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit record, with decoded payload (null for a revisit) and its digest.

    Responses in one record are decoded where they are read.  Only segments are shuffled, by the
    id of the record they continue; a group is one record.  The compressed file is in memory as a whole, its
    records one after the other.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    names = [field.split()[0] for field in PARSED.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for f, block in parse(gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer()))):
                    segment = _number(f.get("warc-segment-number"))
                    digest = f.get("warc-payload-digest")
                    origin = f.get("warc-segment-origin-id", f["warc-record-id"]) if segment else None
                    rows.append((_number(f.get("warc-page-id")), f.get("warc-target-uri"), f["warc-type"], origin, segment,
                                 _number(f.get("warc-segment-total-length")), digest and digest.removeprefix("sha1:"),
                                 _number(f.get("warc-refers-to-page-id")), block))
                    held += len(block)
                    if len(rows) == 512 or held > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _decoded(batch.to_pylist())

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _decoded(reassemble(row["segments"]))

    records = files.mapInArrow(run, PARSED)
    single = records.filter("segment is null").mapInArrow(whole, READ)
    segments = records.filter("segment is not null")
    groups = segments.groupBy("origin").agg(F.collect_list(F.struct(*segments.columns)).alias("segments"))
    return single.unionByName(groups.select("segments").mapInArrow(joined, READ))


def lengths_of(records: DataFrame) -> DataFrame:
    """The records with the length of the payload instead of the payload; null for a revisit."""
    return records.withColumn("payload_bytes", F.octet_length("payload").cast("long")).drop("payload")


def pages_of(records: DataFrame) -> DataFrame:
    """Per record of `lengths_of`: page, payload length and digest, type and the page it refers to.

    A revisit has the length of the response with its digest, null where none is among the records.
    """
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = records.filter("record_type = 'response'").select(*columns)
    known = responses.groupBy(F.col("payload_digest").alias("of")).agg(F.max("payload_bytes").alias("length"))
    revisits = records.filter("record_type = 'revisit'").join(known, F.col("payload_digest") == F.col("of"), "left")
    return responses.unionByName(revisits.withColumn("payload_bytes", F.col("length")).select(*columns))
