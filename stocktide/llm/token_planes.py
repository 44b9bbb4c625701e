"""Token ids of documents in binary files of transposed, compressed planes.

A file holds the ids of its documents in a row, cut into chunks of CHUNK_IDS whatever documents they
belong to. Each chunk is transposed into planes, one for each bit or byte of an id, and every plane is
compressed by itself; planes of zeros only are left out. An index at the end says where each chunk
lies, so that a reader may begin at any of them:

    MAGIC
    chunk: compressed table of the documents that begin in it, then its planes
    ...
    index: a row of numbers for each chunk (see INDEX_COLUMNS and its planes' sizes)
    footer: FOOTER (place and length of the index, chunks, ids, ids of a full chunk, planes), MAGIC

All numbers are little-endian. The table of a chunk holds, for each document, its id, whether it has
one, the place of its first id in the chunk and the number of its ids. A task that reads a range of chunks owns the
documents that begin in them, the last of which may end behind.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.llm.tables import written
from stocktide.llm.text import slices
from stocktide.llm.tokens import PieceIds, byte_level_ids
from stocktide.llm.warc import _open as open_store
from stocktide.shared_dir import new_folder

MAGIC = b"IDPLANE1"
FOOTER = "<QQQQIB"
#: Place of the chunk, its ids, its documents, bytes of their table, checksum of all its bytes.
INDEX_COLUMNS = 5
CHUNK_IDS = 1 << 16
PLANES = {"bit": 32, "byte": 4}
LEVEL = 3
END_ID = 0
SLICE_BYTES = 4 << 20
#: Chunks one task reads.
CHUNKS_A_TASK = 64
MANIFEST_COLUMNS = "path string, bytes bigint, ids bigint, documents bigint, chunks bigint"
TOKEN_COLUMNS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, planes: str) -> list[bytes]:
    """`ids` transposed: plane i holds bit or byte i of every id, the lowest first."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [raw[:, i].tobytes() for i in range(4)]
    out = []
    for i in range(4):
        bits = np.unpackbits(raw[:, i : i + 1], axis=1, bitorder="little") if raw[:, i].any() else None
        for j in range(8):
            out.append(b"" if bits is None else np.packbits(bits[:, j], bitorder="little").tobytes())
    return out


def from_planes(planes: list[bytes | None], n: int, kind: str) -> np.ndarray:
    """The `n` ids of their planes; a plane that is missing is all zeros."""
    ids = np.zeros(n, dtype=np.uint32)
    for i, plane in enumerate(planes):
        if plane is None:
            continue
        part = np.frombuffer(plane, dtype=np.uint8)
        if kind == "byte":
            ids |= part.astype(np.uint32) << np.uint32(8 * i)
        else:
            ids |= np.unpackbits(part, count=n, bitorder="little").astype(np.uint32) << np.uint32(i)
    return ids


class _Writer:
    """Chunks of one file. Ids wait until a chunk is full."""

    def __init__(self, out, chunk_ids: int, planes: str):
        self.out, self.chunk_ids, self.planes = out, chunk_ids, planes
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.ids = self.documents = 0
        self.begun: list[tuple[int | None, int, int]] = []
        self.index: list[list[int]] = []
        out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.begun.append((doc_id, self.n_waiting, len(ids)))
        self.documents += 1
        while True:
            taken = ids[: self.chunk_ids - self.n_waiting]
            self.waiting.append(taken)
            self.n_waiting += len(taken)
            ids = ids[len(taken) :]
            if self.n_waiting == self.chunk_ids:
                self._flush()
            if not len(ids):
                return

    def _flush(self) -> None:
        ids = np.concatenate(self.waiting)
        documents = np.array([(d or 0, d is not None, at, n) for d, at, n in self.begun], dtype="<i8").reshape(-1, 4)
        table = self.packer.compress(documents.T.tobytes()) if len(documents) else b""
        packed = [self.packer.compress(p) if p.strip(b"\0") else b"" for p in to_planes(ids, self.planes)]
        chunk = b"".join([table, *packed])
        self.out.write(chunk)
        sizes = [len(p) for p in packed]
        self.index.append([self.at, len(ids), len(documents), len(table), zlib.crc32(chunk), *sizes])
        self.at += len(chunk)
        self.ids += len(ids)
        self.waiting, self.begun, self.n_waiting = [], [], 0

    def close(self) -> None:
        if self.n_waiting:
            self._flush()
        index = self.packer.compress(np.array(self.index, dtype="<i8").tobytes())
        footer = struct.pack(
            FOOTER, self.at, len(index), len(self.index), self.ids, self.chunk_ids, PLANES[self.planes]
        )
        self.out.write(index + footer + MAGIC)
        self.at += len(index) + len(footer) + len(MAGIC)
        self.out.close()


class _Reader:
    """Chunks of one file by their number."""

    def __init__(self, file: pa.NativeFile):
        self.file, size = file, file.size()
        tail = struct.calcsize(FOOTER) + len(MAGIC)
        end = self._bytes(size - tail, tail) if size >= tail + len(MAGIC) else b""
        if not end.endswith(MAGIC) or self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError("no file of token planes, or one that is cut off")
        at, length, n, self.ids, self.chunk_ids, planes = struct.unpack(FOOTER, end[: -len(MAGIC)])
        self.kind = next(k for k, v in PLANES.items() if v == planes)
        self.unpacker = zstandard.ZstdDecompressor()
        raw = self.unpacker.decompress(self._bytes(at, length)) if length else b""
        self.index = np.frombuffer(raw, dtype="<i8").reshape(n, INDEX_COLUMNS + planes)

    def _bytes(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def chunk(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Its ids, and a row (doc_id, has one, place, ids) of each document that begins in it."""
        at, n, documents, table, checksum, *sizes = self.index[number].tolist()
        data = self._bytes(at, table + sum(sizes))
        if zlib.crc32(data) != checksum:
            raise ValueError(f"chunk {number} is damaged")
        begun = self.unpacker.decompress(data[:table]) if documents else b""
        planes, at = [], table
        for size in sizes:
            planes.append(self.unpacker.decompress(data[at : at + size]) if size else None)
            at += size
        return from_planes(planes, n, self.kind), np.frombuffer(begun, dtype="<i8").reshape(4, documents).T


def _writing(folder: str, tokenizer: str, chunk_ids: int, planes: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_store(folder)
        task, writer, pieces = TaskContext.get(), None, None
        name = f"part-{task.partitionId():06d}.ids"
        for batch in batches:
            for low, high in slices(batch.column(1), SLICE_BYTES):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    # Under its final name only when whole, so that a task run again replaces its own file.
                    out = store.open_output_stream(f"{base}/{name}.{task.taskAttemptId()}")
                    writer, pieces = _Writer(out, chunk_ids, planes), PieceIds.of_worker(tokenizer)
                ids, begins = byte_level_ids(batch.column(1).slice(low, high - low), pieces)
                ends = begins[1:]
                ids = np.insert(ids, ends, END_ID)
                bounds = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
                for i, doc_id in enumerate(batch.column(0).slice(low, high - low).to_pylist()):
                    writer.add(doc_id, ids[bounds[i] : bounds[i + 1]])
        columns: list[list] = [[], [], [], [], []]
        if writer is not None:
            writer.close()
            store.move(f"{base}/{name}.{task.taskAttemptId()}", f"{base}/{name}")
            found = (f"{folder}/{name}", writer.at, writer.ids, writer.documents, len(writer.index))
            columns = [[x] for x in found]
        kinds = [pa.string()] + [pa.int64()] * 4
        names = [c.split()[0] for c in MANIFEST_COLUMNS.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, chunk_ids: int = CHUNK_IDS, planes: str = "byte"
) -> DataFrame:
    """Write the token ids of every row of `docs` (doc_id, text) below `folder`: a row (path, bytes, ids,
    documents, chunks) for each file.

    Rows stand in ascending order of doc_id over all files in the order of their paths, rows without one
    first; rows of one id stay rows of their own, side by side, and are dealt over files where they are many. A
    text's ids end with END_ID; a null or empty text is END_ID alone. Bytes that are no UTF-8 count as U+FFFD. An
    empty table gives no files. Other columns are ignored. `tokenizer` is the path of a byte-level
    tokenizer without normaliser that every executor can read. `planes` is "bit" or "byte".
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The second number parts rows of one id, so that a hot id does not fill one file.
    numbered = rows.withColumn("_at", F.monotonically_increasing_id())
    ordered = numbered.repartitionByRange("doc_id", "_at").sortWithinPartitions("doc_id", "_at")
    files = ordered.select("doc_id", "text").mapInArrow(_writing(folder, tokenizer, chunk_ids, planes), MANIFEST_COLUMNS)
    return written(files, "token_files")


def _reading(with_ids: bool):
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())] * with_ids
    names = [c.split()[0] for c in TOKEN_COLUMNS.split(", ")] + ["ids"] * with_ids

    def documents(reader: _Reader, first: int, end: int) -> Iterator[tuple]:
        """(doc_id, start in the file, ids, checksum, parts of the ids) of documents that begin in chunks `first` to `end`."""
        number, open_doc = first, None
        while number < len(reader.index) and (number < end or open_doc):
            ids, begun = reader.chunk(number)
            if open_doc:
                doc_id, start, n, checksum, parts, left = open_doc
                part = ids[:left]
                checksum, left = zlib.crc32(part, checksum), left - len(part)
                parts = [*parts, part] if with_ids else parts
                open_doc = (doc_id, start, n, checksum, parts, left) if left else None
                if not left:
                    yield doc_id, start, n, checksum, parts
            if number < end:
                for doc_id, has_id, at, n in begun.tolist():
                    part = ids[at : at + n]
                    row = (doc_id if has_id else None, number * reader.chunk_ids + at, n, zlib.crc32(part), [part])
                    if len(part) == n:
                        yield row
                    else:
                        open_doc = (*row, n - len(part))
            number += 1
        if open_doc:
            raise ValueError("the last document is cut off")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for path, before, first in zip(*(batch.column(i).to_pylist() for i in range(3))):
                store, name = open_store(path)
                with store.open_input_file(name) as file:
                    rows, held = [], 0
                    for doc_id, start, n, checksum, parts in documents(_Reader(file), first, first + CHUNKS_A_TASK):
                        rows.append((doc_id, before + start, n, checksum, *([np.concatenate(parts)] * with_ids)))
                        held += n if with_ids else 1
                        if held > 1 << 18:
                            yield batch_of(rows)
                            rows, held = [], 0
                    yield batch_of(rows)

    return run


def read_tokens(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Every document of the files `files`, as `write_tokens` names them: (doc_id, start, n_tokens, ids_crc32).

    `start` counts the ids of all documents before, over all files in the order of their paths, and
    `ids_crc32` is the checksum of the ids as little-endian 32-bit numbers; both are taken from the files. With `with_ids` the ids come
    as well. A task reads CHUNKS_A_TASK chunks. A damaged chunk or a file that is cut off raises.
    """
    # One row per file.
    before = F.sum("ids").over(Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    placed = files.select("path", F.coalesce(before, F.lit(0)).alias("before"), "chunks")
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1, F.lit(CHUNKS_A_TASK).cast("bigint")))
    ranges = placed.where("chunks > 0").select("path", "before", first.alias("first"))
    n = files.agg(F.sum(F.ceil(F.col("chunks") / CHUNKS_A_TASK))).first()[0] or 1
    spread = ranges.repartitionByRange(int(n), "path", "first")
    return spread.mapInArrow(_reading(with_ids), TOKEN_COLUMNS + (", ids array<int>" if with_ids else ""))


def token_round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, planes: str = "byte") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of `docs`, written to files in the shared folder and read
    back from them."""
    files = write_tokens(docs, new_folder(spark, "tokens"), tokenizer, planes=planes)
    return read_tokens(files)
