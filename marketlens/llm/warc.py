"""WARC archives: one gzip member a record, and a splittable reader that needs no index."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlens.llm.shared import Shared

MAGIC = b"\x1f\x8b\x08"
GZIP = 16 + zlib.MAX_WBITS
READ = 1 << 17
BATCH_BYTES = 1 << 20
HEADER_BYTES = 1 << 12
ARCHIVE_BYTES = 1 << 28
SPLIT_BYTES = 1 << 24
MOST_TASKS = 20_000
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string,"
    " refers_to long, payload binary"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
           revisit: bool) -> bytes:
    """One record; a revisit keeps the HTTP header and leaves the payload to its response."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {quote(url or '', safe=URL_SAFE)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


URL_SAFE = "/:?#[]@!$&'()*+,;=%-._~"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(5, zlib.DEFLATED, GZIP)
    return packer.compress(data) + packer.flush()


def parsed(data: bytes) -> dict:
    """Fields of a whole decoded record."""
    head, block = data.split(b"\r\n\r\n", 1)
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode().lower()] = value.strip().decode()
    block = block[:int(fields["content-length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    revisit = fields["warc-type"] == "revisit"
    number = lambda name: re.search(r"(-?\d*)>$", fields.get(name, ">"))[1]
    told = fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?i)content-length: *(\d+)", http)[1])
    if not revisit and (len(payload) != size or digest(payload) != told):
        raise ValueError(f"payload of {fields['warc-record-id']} does not match its digest")
    page, refers = number("warc-record-id"), number("warc-refers-to")
    return {
        "page_id": int(page) if page else None, "payload_bytes": size, "payload_digest": told,
        "record_type": fields["warc-type"], "refers_to": int(refers) if refers else None,
        "payload": None if revisit else payload,
    }


#: Schemes that Hadoop spells otherwise than Arrow does for the same store.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}
#: Schemes whose files every machine also has below a folder.
MOUNTED = {"dbfs": "/dbfs"}


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """Any store that Arrow reaches (local, HDFS, S3, GCS, ABFS) by its URI, in Hadoop's
    spelling or Arrow's; a plain path is local. Other schemes raise a ValueError."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme in MOUNTED:
        return fs.LocalFileSystem(), f"{MOUNTED[scheme]}/{rest.lstrip('/')}"
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    except (pa.ArrowInvalid, OSError) as error:
        raise ValueError(f"archives cannot be kept in a {scheme}: store") from error


class Window:
    """Bytes of a file by position, read ahead in runs."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size = file, size
        self.at, self.data = 0, b""

    def bytes(self, at: int, least: int = 1) -> bytes:
        """What is held from ``at`` on: ``least`` bytes or more, fewer at the end of the file."""
        if not (self.at <= at and at + least <= self.at + len(self.data)):
            self.file.seek(at)
            self.at, self.data = at, self.file.read(max(READ, least))
        return self.data[at - self.at:]


def starts_record(window: Window, at: int) -> bool:
    """Whether the bytes at ``at`` decode to the header of a record."""
    try:
        head = zlib.decompressobj(GZIP).decompress(window.bytes(at, HEADER_BYTES), 64)
    except zlib.error:
        return False
    return head.startswith(b"WARC/1.")


def read_member(window: Window, at: int) -> tuple[bytes, int]:
    """A whole member and the position behind it."""
    decoder, parts = zlib.decompressobj(GZIP), []
    while not decoder.eof:
        data = window.bytes(at)
        if not data:
            raise ValueError("an archive ends inside a record")
        parts.append(decoder.decompress(data))
        at += len(data) - len(decoder.unused_data)
    return b"".join(parts), at


def records_in(
    file: pa.NativeFile, size: int, start: int, end: int
) -> Iterator[bytes | None]:
    """Decoded records whose first byte lies in [start, end); the last may reach beyond.

    A member that begins like a record and cannot be decoded to its end is None; the search
    goes on behind its first byte. Bytes that begin no record are passed over.
    """
    window, at = Window(file, size), start
    while at < min(end, size):
        data = window.bytes(at, len(MAGIC))
        found = data.find(MAGIC)
        if found < 0:
            at += max(1, len(data) - len(MAGIC) + 1)
            continue
        at += found
        if at >= end:
            return
        if not starts_record(window, at):
            at += 1
            continue
        try:
            data, at = read_member(window, at)
        except (ValueError, zlib.error):
            data, at = None, at + 1
        yield data


def read_archives(
    spark: SparkSession, archives: DataFrame, split_bytes: int = SPLIT_BYTES,
    keep_payload: bool = True,
) -> DataFrame:
    """Records of WARC files given as (path, bytes): page_id, payload_bytes, payload_digest,
    record_type, refers_to, payload (null in revisits).

    Files are cut into byte ranges, one row each. A task looks for gzip magic from the
    start of its range, accepts the first place that decodes to a record header, and
    owns all records that start inside, so a large archive needs no index and no single
    reader. A member that is cut off, or damaged so that gzip's checks fail, becomes a row of
    type ``damaged`` with nothing else in it, and reading goes on with the next record;
    bytes between members are passed over. A response that gzip finds whole and whose payload
    does not match its digest is an error.
    """

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for split in batch.to_pylist():
                store, path = open_store(split["path"])
                with store.open_input_file(path) as file:
                    held, size = [], 0
                    for data in records_in(file, split["bytes"], split["start"], split["end"]):
                        row = {"record_type": "damaged"} if data is None else parsed(data)
                        size += len(data or b"")
                        if not keep_payload:
                            row["payload"] = None
                        held.append(row)
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])
    starts = F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes)
    ))
    splits = archives.filter("bytes > 0").select("path", "bytes", starts.alias("start"))
    splits = splits.withColumn("end", F.least(F.col("start") + split_bytes, F.col("bytes")))
    # Ranges are few bytes as rows and many as files: their number, not their size, makes tasks.
    ranges = F.sum(F.ceil(F.col("bytes") / split_bytes))
    tasks = max(1, min(MOST_TASKS, int(archives.agg(ranges).first()[0] or 0)))
    return splits.repartition(tasks).mapInArrow(batches, RECORD)


def write_archives(
    pages: DataFrame, folder: str, url: str = "url", html: str = "html",
    page_id: str = "page_id", least_bytes: int = 0,
) -> DataFrame:
    """Write a record per row into gzipped WARC files under ``folder``; returns (path, bytes).

    Of equal payloads of at least ``least_bytes`` bytes, rows with the smallest page_id
    are responses and the others revisits of it. Equality is found by SHA-256 and a
    minimum per digest, combined before its shuffle. Every attempt of a task writes files of
    its own names and only the returned rows count, so a lost executor leaves no
    half-written archive behind. The result is lazy: store it before it is read twice.

    Null html is an empty payload; a null id is written as such and never a response
    others refer to, unless all of its copies have none: then all are responses.
    """
    open_store(folder)  # an unknown store is an error here, not in a task
    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"), pages[url].alias("url"),
        F.encode(F.coalesce(pages[html], F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    groups = rows.select("page_id", "same", F.length("payload").alias("n"))
    groups = (
        groups.filter(F.col("n") >= least_bytes).groupBy("same")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .filter("copies > 1 and first is not null").select(F.col("same").alias("_same"), "first")
    )
    # Stored, it meets the rows through a shuffle on both sides, so Spark can split a hot payload.
    groups = Shared(pages.sparkSession).put(groups)
    marked = rows.join(groups, F.col("same") == F.col("_same"), "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"),
    )

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = open_store(folder)
        store.create_dir(top, recursive=True)
        name, out, size = "", None, 0
        for batch in stream:
            for i in range(batch.num_rows):
                key, link, payload, refers = (c[i].as_py() for c in batch.columns)
                data = member(record(key, link, payload, refers, refers is not None))
                if out is None:
                    name, size = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                out.write(data)
                size += len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    yield named(name, size)
                    out = None
        if out is not None:
            out.close()
            yield named(name, size)

    def named(name: str, size: int) -> pa.RecordBatch:
        columns = [pa.array([f"{folder}/{name}"]), pa.array([size], pa.int64())]
        return pa.record_batch(columns, names=["path", "bytes"])

    return marked.mapInArrow(batches, "path string, bytes long")
