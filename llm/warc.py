"""WARC archives: a writer with revisit records, and a reader that splits archives inside files.

Every record is a gzip member of its own. A reading task scans its byte range for the gzip magic, tries
to decode a member there and takes it for a record only if it begins with a WARC version line; it owns
the records that begin in its range and follows the last of them past the end of the range.

Files go to the shared folder through Arrow's file systems, so that folder may be a mounted path, HDFS
or an object store. A writing task names its file anew on each attempt, and only files listed in the
stored manifest are read, so a repeated task leaves no double records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.shared import shared_path, stored

SPLIT_BYTES = 8 << 20
CHUNK = 1 << 18
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MANIFEST = "path string, records long, bytes long"
_RECORDS = "record_type string, page_id long, url string, payload_bytes long, payload_digest string, refers_to long, payload binary"
_RECORD_ARROW = pa.schema(
    [("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64())]
    + [("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One record as a gzip member. With refers_to it is a revisit and holds no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20%]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(refers_to)), ("X-Refers-To-Page", str(refers_to))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + packer.flush()


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to: of pages with equal payloads of least_bytes or more, the largest id.

    refers_to is null for the page that the others refer to (rows that repeat its id too), for a page
    without an id and for shorter or single payloads. A null html is an empty payload.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({"_sha": F.sha1(F.col("html").cast("binary")), "_bytes": F.octet_length("html")})
    groups = rows.filter(F.col("_bytes") >= least_bytes).groupBy("_sha", "_bytes")
    groups = groups.agg(F.count(F.lit(1)).alias("_copies"), F.max("page_id").alias("_last")).filter("_copies > 1")
    refers = F.when(F.col("page_id") < F.col("_last"), F.col("_last"))
    return rows.join(groups, ["_sha", "_bytes"], "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str) -> DataFrame:
    """Write a record for each row of page_id, url, html, refers_to; one archive a task. Returns the stored manifest."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        out, path, records, size = None, f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to"))):
                page_id, url, html, refers_to = (x.as_py() for x in row)
                if out is None:
                    system.create_dir(base, recursive=True)
                    out = system.open_output_stream(path, compression=None)
                data = record(page_id, url, html.encode(), refers_to)
                out.write(data)
                records, size = records + 1, size + len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

    return stored(pages.select("page_id", "url", "html", "refers_to").mapInArrow(task, _MANIFEST), "warc-manifest")


def _member(file: pa.NativeFile, at: int) -> tuple[bytes, int] | None:
    """The WARC record whose gzip member begins at a byte, and the byte after it; None if there is none."""
    unpacker, out, first = zlib.decompressobj(31), [], b""
    while not unpacker.eof:
        data = file.read_at(CHUNK, at)
        if not data:
            return None
        try:
            out.append(unpacker.decompress(data))
        except zlib.error:
            return None
        at += len(data)
        if len(first) < 7:
            first = b"".join(out)[:7]
            if not b"WARC/1.".startswith(first[:7]):
                return None
    return (b"".join(out), at - len(unpacker.unused_data)) if first == b"WARC/1." else None


def members(file: pa.NativeFile, begin: int, end: int) -> Iterator[bytes]:
    """Records that begin in begin..end - 1, decompressed."""
    at = begin
    while at < end:
        data = file.read_at(min(CHUNK, end - at + len(MAGIC) - 1), at)
        found = data.find(MAGIC)
        if found < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            continue
        got = _member(file, at + found)
        if got is None:
            at += found + 1
        else:
            yield got[0]
            at = got[1]


def parsed(raw: bytes) -> dict:
    """The columns of a record; a payload that its digest does not fit is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('WARC-Record-ID')} is not as long as its header says")
    number = lambda name: int(fields[name]) if name in fields else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    if payload is not None and payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields.get('WARC-Record-ID')} does not fit its digest")
    url = fields.get("WARC-Target-URI")
    return {
        "record_type": fields["WARC-Type"],
        "page_id": number("X-Page-ID"),
        "url": None if url is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        "payload_bytes": number("X-Payload-Length"),
        "payload_digest": digest,
        "refers_to": number("X-Refers-To-Page"),
        "payload": payload,
    }


def read(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """The records of the archives in manifest (path, bytes), a task for each few byte ranges."""
    begin = F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("begin")
    splits = manifest.filter("bytes > 0").select("path", "bytes", begin)
    splits = splits.select("path", "begin", F.least(F.col("begin") + split_bytes, F.col("bytes")).alias("end"))
    spark = manifest.sparkSession
    uri = spark.conf.get("spark.checkpoint.dir")
    tasks = max(1, int(manifest.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 0))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = fs.FileSystem.from_uri(uri)
        for batch in batches:
            for path, begin, end in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows, held = [], 0
                with system.open_input_file(path) as file:
                    for raw in members(file, begin, end):
                        row = parsed(raw)
                        if not with_payload:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_ARROW)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD_ARROW)

    return splits.repartition(tasks).mapInArrow(task, _RECORDS)


def archived(pages: DataFrame, least_bytes: int = 0, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Write all pages to archives in the shared folder and read the records back, without payloads."""
    folder = shared_path(pages.sparkSession, "warc")
    return read(write(with_revisits(pages, least_bytes), folder), split_bytes, with_payload=False).drop("payload")
