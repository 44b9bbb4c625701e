"""Ledger of judged publications: `<raw>/ledger`, appended to by every load.

An entry says how a publication (a folder with so many files and bytes) was judged and how it was read. What
counts for a dataset's year is the newest publication that was found valid, whichever of them was looked
at first, so that a load of a whole landing folder and loads as publications arrive give the same store.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalogue import list_type_of

ENTRIES = (
    "dataset string, year_key string, published string, folder string, n_files bigint, bytes bigint, "
    "allow_bad_rows boolean, multi_line boolean, n_rows bigint, reason string, detail string, judged_at timestamp"
)
NAMES = [part.split()[0] for part in ENTRIES.split(", ")]


def read_ledger(spark: SparkSession, raw: str) -> DataFrame:
    """All entries of a store; none of a store that was never loaded."""
    try:
        return spark.read.schema(ENTRIES).parquet(f"{raw}/ledger")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ENTRIES)


def append(spark: SparkSession, raw: str, entries: list[tuple]) -> None:
    """Add entries, all columns but `judged_at`. Written after what they tell of, so that a load that is cut off
    judges and loads again."""
    if entries:
        kinds = ENTRIES.removesuffix(", judged_at timestamp")
        rows = spark.createDataFrame(entries, kinds).withColumn("judged_at", F.current_timestamp())
        rows.coalesce(1).write.mode("append").parquet(f"{raw}/ledger")


def newest_valid(entries: DataFrame) -> DataFrame:
    """The valid publication of each (dataset, year_key) that was published last."""
    entry = F.struct("published", "judged_at", "folder", "n_files", "bytes", "n_rows")
    newest = entries.where("reason is null").groupBy("dataset", "year_key").agg(F.max(entry).alias("entry"))
    return newest.select("dataset", "year_key", "entry.*")


def loaded(entries: DataFrame) -> DataFrame:
    """What the store holds: the publication of each (dataset, year_key) that was loaded last."""
    entry = F.struct("judged_at", "published", "folder", "n_files", "bytes", "n_rows")
    last = entries.where("reason is null").groupBy("dataset", "year_key").agg(F.max(entry).alias("entry"))
    return last.select("dataset", "year_key", "entry.*")


def partition_sources(entries: DataFrame) -> DataFrame:
    """(list_type, source_year_key, source): a hash of the publications each warehouse partition is made from."""
    said = F.to_json(F.struct("dataset", "folder", "n_files", "bytes", "judged_at"))
    return loaded(entries).groupBy(
        list_type_of(F.col("dataset")).alias("list_type"), F.col("year_key").alias("source_year_key")
    ).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(said)), "\n"), 256).alias("source"))


def verdicts(entries: DataFrame, allow_bad_rows: bool, multi_line: bool) -> DataFrame:
    """The last verdict on each publication as it lies there, read the same way: a reason, or null of a valid one."""
    same = (F.col("allow_bad_rows") == allow_bad_rows) & (F.col("multi_line") == multi_line)
    verdict = F.max_by(F.struct("reason", "detail"), "judged_at").alias("verdict")
    return entries.where(same).groupBy("folder", "n_files", "bytes").agg(verdict).select(
        "folder", "n_files", "bytes", "verdict.*"
    )
