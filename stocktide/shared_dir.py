"""The folder every executor can reach, for checkpoints and written intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir` of the session. Only a session in one process may go without one; it gets a
    folder of its own, which is removed when the process ends."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="stocktide-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the shared one; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_dropped(spark: SparkSession):
    """Inside, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
    For queries whose result is written and whose frames are not run again."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def small_reads(spark: SparkSession):
    """Inside, a task of a query that is run reads 8 MB of files, for rows that are many times larger in memory."""
    return _setting(spark, "spark.sql.files.maxPartitionBytes", "8m")


def fixed(frame: DataFrame) -> DataFrame:
    """The frame computed once and kept in the shared folder, so that two uses of it agree."""
    shared_dir(frame.sparkSession)
    with shuffles_dropped(frame.sparkSession):
        return frame.checkpoint(eager=True)
