"""Raw store: one Parquet table per shape family, partitioned by dataset and year.

Cells stay as published. Loading a dataset's year again replaces that year and nothing else. `ledger` beside the
families says which publications were looked at and what became of them.
"""

from __future__ import annotations

import itertools
import uuid
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..fixed_values import LONG, LONG_EARLY, WIDE, WIDE_SPECIALTY
from ..schemas import LINEAGE_COLUMNS, PARTITIONS, RAW
from . import landing as landed
from . import ledger

FAMILIES = (WIDE, LONG, LONG_EARLY, WIDE_SPECIALTY)


def write_raw(rows: DataFrame, raw: str, family: str) -> None:
    """Replace the dataset-years present in `rows`.

    Nothing is shuffled: the files a task reads belong to one year or a few, and it writes those.
    A year with most of the rows has most of the tasks. `spark.sql.files.maxPartitionBytes` sets how
    much one task reads, and with it the size of the files written.
    """
    (
        rows.drop("published")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "year_key")
        .parquet(f"{raw}/{family}")
    )


def read_raw(spark: SparkSession, raw: str, family: str, lineage: bool = False) -> DataFrame:
    """A family's raw rows, published spellings that a year lacks read as null."""
    schema = StructType([*RAW[family].fields, *PARTITIONS])
    rows = spark.read.schema(schema).parquet(f"{raw}/{family}")
    return rows if lineage else rows.drop(*LINEAGE_COLUMNS)


def loaded_years(spark: SparkSession, raw: str) -> DataFrame:
    """Rows per loaded (family, dataset, year_key)."""
    counts = [
        read_raw(spark, raw, family)
        .groupBy("dataset", "year_key")
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(family).alias("family"), "dataset", "year_key", "n_rows")
        for family in families_present(spark, raw)
    ]
    empty = "family string, dataset string, year_key string, n_rows bigint"
    frame = spark.createDataFrame([], empty)
    for other in counts:
        frame = frame.unionByName(other)
    return frame


def families_present(spark: SparkSession, raw: str) -> list[str]:
    """Families that have been loaded; a folder listing, no data is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(raw)
        .select(F.regexp_extract("path", "/([^/]+)/dataset=[^/]*/year_key=[^/]*/[^/]+$", 1).alias("f"))
    )
    found = {row.f for row in listing.distinct().collect()}
    return [family for family in FAMILIES if family in found]


def _publish(spark: SparkSession, staged: str, raw: str, row) -> None:
    """Put a staged dataset-year in the place of the one before: the folder is moved, no row is written again."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(f"{raw}/{row.family}/dataset={row.dataset}/year_key={row.year_key}")
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    store.delete(target, True)
    if not store.rename(hadoop.Path(staged), target):
        raise OSError(f"{staged} could not be moved to {target}")


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ingest(
    spark: SparkSession,
    landing: str,
    raw: str,
    wanted: DataFrame | None = None,
    allow_bad_rows: bool = False,
    multi_line: bool = False,
    **families,
) -> DataFrame:
    """Load the newest valid publication of each dataset's year, or of the `wanted` ones.

    Publications are looked at from the newest on until one is valid, and entered in the ledger. One that
    was judged before is not read again while its files are the same, nor is one that the store
    already holds. Rows are written to a staging folder and moved once they are judged.

    Returns the publications that were left out, as rows of `landing.REJECTS` with the reason. Nothing is
    replaced by them, and they keep no other publication from being loaded.
    """
    files = landed.list_files(spark, landing)
    every, latest = landed.publications(files), landed.latest_publications(files)
    if wanted is not None:
        every, latest = (p.join(wanted, ["dataset", "year_key"], "left_semi") for p in (every, latest))
    known, _ = landed.dispatch(every, **families)
    _, unknown = landed.dispatch(latest, **families)
    entries = ledger.read_ledger(spark, raw)
    # As many rows as the landing folder has publications.
    as_lies = lambda r: (r.folder, r.n_files, r.bytes)
    judged = {as_lies(r): r for r in ledger.verdicts(entries, allow_bad_rows, multi_line).collect()}
    held = {(r.dataset, r.year_key): as_lies(r) for r in ledger.loaded(entries).collect()}
    queues = defaultdict(list)
    for row in known.orderBy("dataset", "year_key", F.desc("published")).collect():
        queues[row.dataset, row.year_key].append(row)
    rejects, staging = [], f"{raw}/_staging/{uuid.uuid4().hex}"
    for attempt in itertools.count():
        for key, rows in list(queues.items()):
            while rows and as_lies(rows[0]) in judged and judged[as_lies(rows[0])].reason is not None:
                row = rows.pop(0)
                before = judged[as_lies(row)]
                rejects.append((*key, row.published, row.folder, before.reason, before.detail))
            if not rows or as_lies(rows[0]) == held.get(key):
                del queues[key]
        if not queues:
            break
        newest = [rows.pop(0) for rows in queues.values()]
        staged, bad = landed.stage_publications(
            spark, landing, newest, f"{staging}/{attempt}", allow_bad_rows, multi_line
        )
        for row, folder, _ in staged:
            _publish(spark, folder, raw, row)
            del queues[row.dataset, row.year_key]
        rejects += bad
        found = {(r.dataset, r.year_key): r for r in newest}
        verdict = {(r.dataset, r.year_key): (n, None, None) for r, _, n in staged}
        verdict |= {(d, y): (None, reason, detail) for d, y, _, _, reason, detail in bad}
        ledger.append(spark, raw, [
            (*key, found[key].published, *as_lies(found[key]), allow_bad_rows, multi_line, *told)
            for key, told in verdict.items()
        ])
    _remove(spark, staging)
    left_out = unknown.select(
        "dataset", "year_key", "published", "folder",
        F.lit(landed.UNKNOWN).alias("reason"),
        F.lit(None).cast("string").alias("detail"),
    )
    return left_out.unionByName(spark.createDataFrame(rejects, landed.REJECTS))
