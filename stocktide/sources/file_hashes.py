"""SHA-256 of files by streams: a file of any size is read in steps, and one that cannot be read is an entry with an error.

Files are opened with pyarrow's file systems, so they must lie where those reach (local, S3, GCS, HDFS).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

STEP_BYTES = 4 << 20
ATTEMPTS = 3
# About what one task hashes; a larger file is one task, since each step of the hash needs the one before.
TASK_BYTES = 1 << 30


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path in it) of a path as Spark lists it: `file:/a b`, `s3a://bucket/key`, nothing escaped."""
    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    authority, _, key = rest.lstrip("/").partition("/")
    system, root = fs.FileSystem.from_uri(f"{'s3' if scheme == 's3a' else scheme}://{authority}/")
    return system, f"{root.rstrip('/')}/{key}"


def hash_file(path: str, length: int, step: int = STEP_BYTES) -> tuple[str | None, str | None]:
    """(hash, error) of a file listed with `length` bytes. One that meanwhile has another length is an error."""
    error = None
    for _ in range(ATTEMPTS):
        try:
            system, inside = open_path(path)
            digest, seen = hashlib.sha256(), 0
            with system.open_input_stream(inside, compression=None) as stream:
                while data := stream.read(step):
                    digest.update(data)
                    seen += len(data)
        except FileNotFoundError:
            return None, "file is gone"
        except PermissionError:
            return None, "file may not be read"
        except OSError as failure:  # perhaps of the moment
            error = f"file cannot be read: {str(failure).splitlines()[0]}"
        else:
            return (digest.hexdigest(), None) if seen == length else (None, f"{seen} bytes, {length} when listed")
    return None, error


def _hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            hash_file(path, length)
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist())
        ]
        columns = [*batch.columns, *(pa.array([pair[i] for pair in found], pa.string()) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "sha256", "error"])


def hash_files(files: DataFrame) -> DataFrame:
    """`files` (`path`, `length` and any others) with `sha256` and `error`, one of which is null.

    A task holds a step of one file, whatever the sizes. Files are dealt evenly by number to tasks enough for
    their bytes. The listing is run twice, once for its size; contents are read once.
    """
    size = files.selectExpr("count(*) as n", "coalesce(sum(length), 0) as bytes").first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(size.n, max(cores, size.bytes // TASK_BYTES + 1)))
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in files.schema)
    # A number of its own: the listing is so small that adaptive execution would make one task of it.
    return files.repartition(int(tasks)).mapInArrow(_hash_batches, f"{kind}, sha256 string, error string")
