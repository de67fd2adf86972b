"""Deterministic sharded WARC writer, and its reader.

Records are sorted by page_id in a range partitioning; each partition writes numbered archives, starting a new
one when the compressed size reaches a limit. A record is a gzip member of its own. Headers, block and payload digests are
made anew from the payload, and nothing in an archive depends on clock, host or attempt. Archives are written under
temporary names; the manifest, written last, lists those that count.

Of records with equal payloads the one with the largest page_id is a response, others are revisit records that
refer to it and keep the HTTP header, with the payload's length, but not the payload.
"""

from __future__ import annotations

import hashlib
import zlib
from base64 import b32encode
from collections.abc import Iterator
from contextlib import ExitStack
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermend.llm.files import committed, filesystem, read_manifest, write_manifest
from ledgermend.llm.shingling import parts_of
from ledgermend.llm.store import written

ROLL_BYTES = 64 << 20
"""Compressed size at which an archive ends."""

#: Fixed values of the WARC format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_SCHEMA = "file string, records long, bytes long"


def digest(data: bytes) -> str:
    """The base32 SHA-1 of the data."""
    return b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    number = record.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def clean_uri(url: str | None, page_id: int | None) -> str:
    """The URL without characters that a header line cannot hold; without URL, the record's name."""
    url = "".join(c if c.isprintable() and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in url or "")
    return url or record_id(page_id)[1:-1]


def _record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", *(f"{name}: {value}" for name, value in fields)]
    lines += [f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}", "", ""]
    member = zlib.compressobj(6, zlib.DEFLATED, 31)  # gzip without time or name
    return member.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + member.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A page's response or revisit record as one gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", clean_uri(url, page_id)),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
    ]
    if revisit:
        return _record("revisit", [*fields, ("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))], http)
    return _record("response", fields, http + payload)


def _archive_head(name: str, date: str) -> bytes:
    fields = [("WARC-Record-ID", f"<urn:archive:{name}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return _record("warcinfo", fields, b"format: WARC File Format 1.1\r\n")


def write_archives(
    pages: DataFrame, uri: str, least_bytes: int = 0, roll_bytes: int = ROLL_BYTES, date: str = "1970-01-01T00:00:00Z"
) -> None:
    """Writes a record for each row of pages (page_id, url, html) to archives at uri, then the manifest.

    Payloads are the html in UTF-8, null as empty; those below least_bytes are always responses. Of equal
    payloads with one largest page_id in several rows, one row is the response. Rows without page_id revisit
    a row that has one, and are responses if none has. Null page_ids come first; other columns are
    ignored; an empty table gives a manifest without archives.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    records = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    records = records.withColumn("sha1", F.sha1("payload"))
    # Only payloads that occur again need a partner; they are counted without the payloads themselves, and
    # written first, so that Spark knows the table's size before it decides whether to shuffle payloads.
    again = written(
        records.where(F.octet_length("payload") >= least_bytes)
        .groupBy("sha1").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
        .where("n > 1 and response is not null").drop("n"),
        "again",
    )
    order = ["page_id", "sha1", "url"]
    # Equal payloads of one page_id stay in one task, which makes the first of them the response.
    sorted_records = records.join(again, "sha1", "left").repartitionByRange("page_id", "sha1").sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, roll, before = TaskContext.get().partitionId(), 0, None
        with ExitStack() as stack:
            out, name, size, count = None, "", 0, 0
            for batch in parts_of(batches, "payload"):
                for page_id, url, payload, sha1, response in zip(*(batch[c].to_pylist() for c in ("page_id", "url", "payload", "sha1", "response")), strict=True):
                    if out is None:
                        name = f"pages-{number:06d}-{roll:06d}.warc.gz"
                        out = stack.enter_context(committed(f"{uri}/{name}"))
                        head = _archive_head(name, date)
                        out.write(head)
                        size, count = len(head), 0
                    revisit = response is not None and (page_id != response or before == (page_id, sha1))
                    before = (page_id, sha1)
                    data = page_record(page_id, url, payload, response, revisit, date)
                    out.write(data)
                    size, count = size + len(data), count + 1
                    if size >= roll_bytes:
                        stack.close()
                        yield pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size]})
                        out, roll = None, roll + 1
            stack.close()
            if out is not None:
                yield pa.RecordBatch.from_pydict({"file": [name], "records": [count], "bytes": [size]})

    # One row for each archive comes to the driver.
    archives = sorted_records.select(*order, "payload", "response").mapInArrow(write, FILE_SCHEMA).collect()
    write_manifest(uri, sorted((row.asDict() for row in archives), key=lambda f: f["file"]))


@dataclass
class Record:
    kind: str
    fields: dict[str, str]
    block: bytes


def records_of(source) -> Iterator[Record]:
    """The records of an archive, one gzip member after the other; a wrong block digest is an error."""
    rest = b""
    while True:
        member, parts = zlib.decompressobj(31), []
        while not member.eof:
            data = rest or source.read(1 << 20)
            rest = b""
            if not data:
                if parts:
                    raise ValueError("the archive ends inside a record")
                return
            parts.append(member.decompress(data))
            rest = member.unused_data
        head, _, body = b"".join(parts).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        block = body[: int(fields["Content-Length"])]
        if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
            raise ValueError(f"{fields['WARC-Record-ID']}: the block differs from its digest")
        yield Record(fields["WARC-Type"], fields, block)


def read_archives(spark: SparkSession, uri: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of all page records.

    A response's length and digest are taken from the payload itself; a revisit record has no payload, and
    both come from its headers.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch["file"].to_pylist():
                system, path = filesystem(f"{uri}/{file}")
                with system.open_input_stream(path, compression=None) as source:
                    yield from _pages(records_of(source))

    files = read_manifest(spark, uri, FILE_SCHEMA)
    return files.select("file").mapInArrow(
        read, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    )


def _pages(records: Iterator[Record], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    rows: list[dict] = []
    size = 0
    for record in records:
        if record.kind == "warcinfo":
            continue
        http, _, payload = record.block.partition(b"\r\n\r\n")
        response, fields = record.kind == "response", record.fields
        length = next(int(line[15:]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length:"))
        rows.append(
            {
                "page_id": page_of(fields["WARC-Record-ID"]),
                "url": fields["WARC-Target-URI"],
                "payload_bytes": len(payload) if response else length,
                "payload_digest": digest(payload) if response else fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                "record_type": record.kind,
                "refers_to": None if response else page_of(fields["WARC-Refers-To"]),
                "payload": payload if response else None,
            }
        )
        size += len(payload)
        if size >= most:
            yield _batch(rows)
            rows, size = [], 0
    yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(
        rows,
        pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        ),
    )
