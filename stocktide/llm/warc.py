"""WARC archives: written record by record as gzip members, and read back by byte ranges.

A task that reads a range looks for gzip magic numbers from the range's start, takes the first candidate
whose first bytes decode to a WARC header, and owns every record that begins inside its range, the last of
which may end beyond it. From one record to the next no search is needed. Files are opened with
pyarrow's file systems, so the shared folder must be of a kind that they know (local, S3, GCS, HDFS).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm.tables import written
from stocktide.shared_dir import new_folder

RANGE_BYTES = 8 << 20
ARCHIVE_BYTES = 1 << 30
READ_BYTES = 1 << 20
#: A header is decoded in steps of so many bytes, until it ends.
HEADER_BYTES = 1 << 16
DATE = "1970-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST_COLUMNS = "path string, bytes bigint, records bigint"
RECORD_COLUMNS = (
    "path string, offset bigint, record_id string, type string, target_uri string, date string, "
    "refers_to string, payload_digest string, payload_bytes bigint, payload binary"
)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_value(text: str) -> str:
    """A value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text)


def _record(key: str, url: str | None, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if refers_to is None else b"")
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{key}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else _header_value(url)),
        ("WARC-Payload-Digest", "sha1:" + digest),
        ("WARC-Refers-To", None if refers_to is None else f"<urn:page:{refers_to}>"),
        ("WARC-Profile", None if refers_to is None else PROFILE),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _writing(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        number, out, done = 0, None, []

        def close():
            # The name tells the partition, so that a task run again replaces its own files.
            name = f"part-{task.partitionId():06d}-{number:04d}.warc.gz"
            out.close()
            store.move(f"{base}/{name}.{task.taskAttemptId()}", f"{base}/{name}")
            done.append((f"{folder}/{name}", size, records))

        for batch in batches:
            for page, url, text, first in zip(*(batch.column(i) for i in range(4))):
                if out is None:
                    name = f"part-{task.partitionId():06d}-{number:04d}.warc.gz"
                    out, size, records = store.open_output_stream(f"{base}/{name}.{task.taskAttemptId()}"), 0, 0
                payload = (text.as_py() or "").encode()
                refers_to = None if first.as_py() is None else str(first.as_py())
                key = "null" if page.as_py() is None else str(page.as_py())
                record = _record(key, url.as_py(), payload, _digest(payload), refers_to)
                out.write(record)
                size, records = size + len(record), records + 1
                if size >= ARCHIVE_BYTES:
                    close()
                    number, out = number + 1, None
        if out is not None:
            close()
        columns = list(zip(*done)) or [(), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["path", "bytes", "records"]
        )

    return run


def write_archives(pages: DataFrame, folder: str, revisit_from: int = 0) -> DataFrame:
    """Archive every row of `pages` (page_id, url, html) below `folder`: (path, bytes, records) of the files.

    The payload is the html in UTF-8; a null is empty. Of rows with equal payloads of at least `revisit_from`
    bytes the one with the smallest page_id is a response and the others revisit it. Rows that repeat the
    smallest page_id with the same payload are responses all. A null page_id is written as `null`; it
    may revisit, and is revisited by nothing. A null url is left out. Other columns are ignored.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
        html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
    )
    slim = rows.where(F.octet_length("html") >= revisit_from).select("page_id", "digest")
    first = slim.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = first.where("n > 1 and first is not null").drop("n")
    again = slim.join(repeated, "digest").where("not page_id <=> first").distinct()
    again = again.withColumnsRenamed({"page_id": "_page", "digest": "_digest"})
    same = (F.col("digest") == F.col("_digest")) & F.col("page_id").eqNullSafe(F.col("_page"))
    ready = rows.join(again, same, "left").select("page_id", "url", "html", "first")
    return written(ready.mapInArrow(_writing(folder), MANIFEST_COLUMNS), "archives")


class _Member:
    """Bytes of a file from a place on, and the gzip members in them."""

    def __init__(self, file: pa.NativeFile, size: int):
        self.file, self.size = file, size
        self.at, self.buffer = 0, b""

    def view(self, at: int, n: int) -> bytes:
        """At least `n` bytes from `at` on, fewer only at the end of the file."""
        if not (self.at <= at and at + min(n, self.size - at) <= self.at + len(self.buffer)):
            self.file.seek(at)
            self.at, self.buffer = at, self.file.read(max(n, READ_BYTES))
        return self.buffer[at - self.at :]

    def header(self, at: int) -> bytes | None:
        """The WARC header of the member that starts at `at`, if one does."""
        unpack, head = zlib.decompressobj(31), bytearray()
        while not unpack.eof:
            data = unpack.unconsumed_tail
            if not data:
                data = self.view(at, HEADER_BYTES)[:HEADER_BYTES]
                at += len(data)
            try:
                piece = unpack.decompress(data, HEADER_BYTES)
            except zlib.error:
                return None
            if not data and not piece:
                return None
            head += piece
            if not (head.startswith(VERSION) or VERSION.startswith(head)):
                return None
            end = head.find(b"\r\n\r\n", max(0, len(head) - len(piece) - 3))
            if end > 0:
                return bytes(head[:end]) if b"\r\nWARC-Type:" in head[:end] else None
        return None

    def content(self, at: int) -> tuple[bytes, int]:
        """The whole member at `at`, and where it ends."""
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof and at < self.size:
            data = self.view(at, 1)
            parts.append(unpack.decompress(data))
            at += len(data) - len(unpack.unused_data)
        if not unpack.eof:
            raise ValueError(f"a record is cut off at byte {at}")
        return b"".join(parts), at

    def next(self, at: int, end: int) -> int | None:
        """Where the first record at or behind `at` and before `end` starts."""
        while at < end:
            data = self.view(at, len(MAGIC))
            found = data.find(MAGIC)
            if found < 0:
                at += max(1, len(data) - len(MAGIC) + 1)
                continue
            at += found
            if at < end and self.header(at) is not None:
                return at
            at += 1
        return None


def _row(path: str, at: int, content: bytes, with_payload: bool) -> dict:
    header, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in header.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: int(fields.get("content-length", 0))]
    payload, length = block, len(block)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        length = len(payload)
        if fields["warc-type"] == "revisit":
            sizes = [x for x in head.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")]
            length = int(sizes[0].split(":")[1]) if sizes else None
    if fields["warc-type"] != "revisit":
        digest = _digest(payload)
    return {
        "path": path, "offset": at, "record_id": fields.get("warc-record-id", "").strip("<>"),
        "type": fields["warc-type"], "target_uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
        "refers_to": fields.get("warc-refers-to", "").strip("<>") or None, "payload_digest": digest,
        "payload_bytes": length, "payload": payload if with_payload else None,
    }


def _reading(with_payload: bool):
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RECORD_COLUMNS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                store, name = _open(path)
                with store.open_input_file(name) as file:
                    member, rows, held = _Member(file, size), [], 0
                    at = member.next(start, end)
                    while at is not None:
                        content, behind = member.content(at)
                        rows.append(_row(path, at, content, with_payload))
                        held += len(content) if with_payload else 0
                        if len(rows) == 1000 or held > READ_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                        at = member.next(behind, end)
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(files: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True) -> DataFrame:
    """Every record of the gzip archives `files` (path, bytes), a task for each range of `range_bytes`.

    Columns as RECORD_COLUMNS. `payload_digest` is taken from the payload that was read, except in a
    revisit, which has only its header's; bytes before the first record of a file are skipped.
    """
    start = F.explode(F.sequence(F.lit(0), F.col("bytes") - 1, F.lit(range_bytes)).cast("array<bigint>"))
    ranges = files.where("bytes > 0").select("path", "bytes", start.alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + range_bytes, F.col("bytes")))
    n = max(1, files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1)
    spread = ranges.repartitionByRange(int(n), "path", "start")
    return spread.mapInArrow(_reading(with_payload), RECORD_COLUMNS)


def _page(record_id: Column) -> Column:
    """The page_id that a record's name holds; null of none."""
    return F.try_to_number(F.substring_index(record_id, ":", -1), F.lit("S" + "9" * 19)).cast("bigint")


def complete(records: DataFrame, files: DataFrame) -> DataFrame:
    """`records` as read from `files` (path, records), written. Raises if a file gave other than its number."""
    records = written(records, "records")
    read = records.groupBy("path").agg(F.count("*").alias("read"))
    wrong = files.groupBy("path").agg(F.sum("records").alias("records")).join(read, "path", "full")
    wrong = wrong.where(F.coalesce("read", F.lit(0)) != F.coalesce("records", F.lit(0)))
    first = wrong.orderBy("path").first()
    if first is not None:
        raise ValueError(f"{first.path} has {first.records} records, {first.read or 0} were read")
    return records


def archive_round_trip(spark: SparkSession, pages: DataFrame, revisit_from: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri) of every row of `pages`,
    written to archives in the shared folder and read back from them."""
    files = write_archives(pages, new_folder(spark, "warc"), revisit_from)
    return complete(read_archives(files, with_payload=False), files).select(
        _page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), _page(F.col("refers_to")).alias("refers_to"), "target_uri",
    )
