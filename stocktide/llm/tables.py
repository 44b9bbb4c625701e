"""Tables read by the queries, and tables written on the way."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.shared_dir import new_folder, shuffles_dropped

_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The frame written once to the shared folder and read again: later uses agree on its rows and
    survive the loss of any executor. `options` are those of the Parquet writer."""
    spark = frame.sparkSession
    folder = new_folder(spark, name)
    with shuffles_dropped(spark):
        frame.write.options(**options).parquet(folder)
    if _made.get() is not None:
        _made.get().append(folder)
    return spark.read.schema(frame.schema).parquet(folder)


class Scratch:
    """The tables written since it was opened."""

    def __init__(self, spark: SparkSession, folders: list[str]):
        self.spark, self.folders, self.kept = spark, folders, []

    def keep(self, frame: DataFrame) -> DataFrame:
        """`frame`, the last that was written, stays; it goes with the tables of what is around."""
        self.kept.append(self.folders.pop())
        return frame

    def drop(self) -> None:
        """Remove them all. Nothing that is run from then on may read one."""
        for folder in self.folders:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.folders.clear()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """What is written inside goes at the end, unless an error ends it."""
    here = Scratch(spark, [])
    token = _made.set(here.folders)
    try:
        yield here
    finally:
        _made.reset(token)
        if _made.get() is not None:
            _made.get().extend(here.kept)
    here.drop()


def row_keyed(frame: DataFrame) -> DataFrame:
    """`frame` with `_row`, a number for each row that is the same at every reading: its file's number and its
    place in the file. What is not read from files as it is gets written first."""
    places = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")]
    try:
        placed = frame.select("*", *places)
    except AnalysisException:
        placed = written(frame, "rows").select("*", *places)
    paths = placed.select("_file").distinct()
    number = F.row_number().over(Window.orderBy("_file")).cast("bigint")
    files = written(paths.select("_file", number.alias("_number")), "files")
    # One row per file, of which the planner has a list anyway.
    keyed = placed.join(F.broadcast(files), "_file")
    row = F.shiftleft("_number", 36) + F.col("_index")
    return keyed.select(*[F.col(f"`{c}`") for c in frame.columns], row.alias("_row"))
