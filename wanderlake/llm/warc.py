"""WARC archives with one Zstandard dictionary for each file.

A file starts with its dictionary in a skippable frame; every record follows as a frame of its
own, so a reader can start at any of them. The dictionary is trained on the file's own first
records, a sample of bounded size. Of records with equal payloads the one with the largest
page id is stored as a response, and the others revisit it without a payload.

Every task writes its own file through the file system of the folder, under a name that holds
the attempt; the table of files returned by the tasks is the archive's content, so what a lost
or repeated attempt left behind is never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.llm.common import ship, written

DICTIONARY_MAGIC = 0x184D2A5D
DICTIONARY_BYTES = 64 * 1024
SAMPLE_BYTES = 4 * 1024 * 1024
SAMPLE_RECORD = 64 * 1024
FILE_BYTES = 256 * 1024 * 1024
LEVEL = 3
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    """SHA-1 as bare upper-case base32."""
    return b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def _record_id(page_id: int | None) -> str:
    return "<urn:page:none>" if page_id is None else f"<urn:page:{page_id}>"


def _page_id(record_id: str | None) -> int | None:
    tail = (record_id or "").strip("<>").rpartition(":")[2]
    return int(tail) if tail.lstrip("-").isdigit() else None


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, first: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record: an HTTP response, or a revisit that keeps its HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {_record_id(first)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers in lower case and the block of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary for these records; empty if there are too few to learn from."""
    samples = [r[:SAMPLE_RECORD] for r in records]
    if len(samples) < 16 or sum(map(len, samples)) < 8 * 1024:
        return b""
    size = min(size, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8, steps=1).as_bytes()
    except zstandard.ZstdError:
        return b""  # samples without anything in common


class ArchiveWriter:
    """One file: dictionary frame, then a frame for each record."""

    def __init__(self, stream, records: list[bytes]):
        self.stream, self.bytes, self.records = stream, 0, 0
        raw = train_dictionary(records)
        self._put(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        known = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True, write_checksum=True, **known).compress
        for record in records:
            self.add(record)

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.bytes += len(data)

    def add(self, record: bytes) -> None:
        self._put(self.pack(record))
        self.records += 1


def read_archive(stream) -> Iterator[bytes]:
    """Records of a file, one after the other; only one is held at a time."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the file does not start with a dictionary frame")
    raw = stream.read(size)
    known = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
    unpack, buffer = zstandard.ZstdDecompressor(**known), b""
    frame, parts = unpack.decompressobj(), []
    while chunk := buffer or stream.read(1 << 20):
        parts.append(frame.decompress(chunk))
        buffer = b""
        if frame.eof:
            yield b"".join(parts)
            buffer, parts, frame = frame.unused_data, [], unpack.decompressobj()
    if any(parts):
        raise ValueError("the file ends inside a record")


def with_responses(pages: DataFrame, least_bytes: int = 0, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """Add ``payload_digest``, ``payload_bytes`` and ``first_id``, the response of the row's payload.

    ``first_id`` is the largest page id with the same payload, null for payloads under
    ``least_bytes``. Digests are counted before the shuffle; a payload that a third of the
    pages share is one row for each task there, and its join partition can be split.
    """
    body = F.coalesce(F.col(html).cast("binary"), F.lit("").cast("binary"))
    keyed = pages.withColumns({"_wl_sha1": F.sha1(body), "payload_bytes": F.octet_length(body).cast("long")})
    first = keyed.filter(F.col("payload_bytes") >= least_bytes).groupBy("_wl_sha1", "payload_bytes").agg(F.max(page_id).alias("first_id"))
    return keyed.join(first, ["_wl_sha1", "payload_bytes"], "left")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "2025-01-01T00:00:00Z") -> DataFrame:
    """Write a record for every row to files in ``folder`` and return the stored table of files.

    The table has ``path, records, bytes``. ``folder`` must be one that all executors share. A
    null html is an empty payload, a null url is left out. A row with a null page id is a
    response only if no other row has its payload. Rows repeated with the largest id are all
    responses. Long payloads are records like any other; a file closes after about
    ``FILE_BYTES``. An empty table writes no file.
    """
    spark = pages.sparkSession
    ship(spark)

    def run(batches):
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        attempt, number, held, held_bytes, writer, stream, path = uuid.uuid4().hex, 0, [], 0, None, None, None

        def opened():
            nonlocal number, stream, path, writer
            path = f"{root}/{attempt}-{number:05d}.warc.zst"
            number += 1
            stream = system.open_output_stream(path, compression=None)
            writer = ArchiveWriter(stream, held)

        def closed():
            nonlocal writer
            stream.close()
            row = [[path], [writer.records], [writer.bytes]]
            writer = None
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, (pa.string(), pa.int64(), pa.int64()), strict=True)], names=["path", "records", "bytes"])

        for batch in batches:
            for n in range(batch.num_rows):
                key, target, payload, first, size = (batch.column(i)[n].as_py() for i in range(5))
                payload = (payload or "").encode("utf-8")
                revisit = first is not None and key != first
                record = build_record(key, target, payload, payload_digest(payload), first, revisit, date)
                if writer is None:
                    held.append(record)
                    held_bytes += len(record)
                    if held_bytes >= SAMPLE_BYTES:
                        opened()
                        held, held_bytes = [], 0
                else:
                    writer.add(record)
                    if writer.bytes >= FILE_BYTES:
                        yield closed()
        if held:
            opened()
        if writer is not None:
            yield closed()

    rows = with_responses(pages, least_bytes, page_id, html).select(page_id, url, html, "first_id", "payload_bytes")
    return written(spark, rows.mapInArrow(run, "path string, records long, bytes long"), "archive-files")


def read_archives(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """A row for each record of the listed files.

    ``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload``; a
    revisit's bytes are those its HTTP header states, its payload is null. The digest of a
    response is computed from the payload read and must be the one stated.
    """

    def run(batches):
        system, _ = pafs.FileSystem.from_uri(folder)
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
        types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for record in read_archive(stream):
                        rows.append(_row(*parse_record(record)))
                        held += len(record)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    ship(spark)
    spread = files.select("path").repartition(max(1, spark.sparkContext.defaultParallelism), "path")
    return spread.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def _row(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = headers["warc-payload-digest"].removeprefix("sha1:")
    size = int(next(line for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")).split(b":")[1])
    revisit = headers["warc-type"] == "revisit"
    if not revisit and (payload_digest(payload) != stated or len(payload) != size):
        raise ValueError(f"record {headers['warc-record-id']} does not hold the payload it states")
    refers = _page_id(headers["warc-refers-to"]) if revisit else None
    return _page_id(headers["warc-record-id"]), headers.get("warc-target-uri"), headers["warc-type"], size, stated, refers, None if revisit else payload
