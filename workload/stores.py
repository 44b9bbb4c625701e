"""Joined lines, landing folder, raw store and warehouse made from the benchmark tables, once per session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stocktide.operators.star import Star
from stocktide.plans.harmonise import unify_store
from stocktide.plans.warehouse import rebuild
from stocktide.shared_dir import new_folder
from stocktide.sources.raw_store import ingest
from stocktide.sources.warehouse_store import read_star

from . import tables

LINES_PER_FILE = 500_000

_roots: dict[tuple[str, str], str] = {}
_done: set[str] = set()


def _root(spark: SparkSession, sf_dir: str) -> str:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _roots:
        _roots[key] = new_folder(spark, "stores")
    return _roots[key]


def _once(folder: str, make) -> str:
    if folder not in _done:
        make(folder)
        _done.add(folder)
    return folder


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined order lines that publications are printed from, in files that a task reads one or two of."""

    def make(folder):
        tables.base(spark, sf_dir).write.option("maxRecordsPerFile", LINES_PER_FILE).parquet(folder)

    return spark.read.parquet(_once(f"{_root(spark, sf_dir)}/lines", make))


def kept(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows that several steps of a query read, written for it, so that their joins are made once."""
    folder = new_folder(spark, "kept")
    rows.write.option("maxRecordsPerFile", LINES_PER_FILE).parquet(folder)
    return spark.read.parquet(folder)


def landing(spark: SparkSession, sf_dir: str) -> str:
    def make(folder):
        tables.write_all_publications(lines(spark, sf_dir), folder)

    return _once(f"{_root(spark, sf_dir)}/landing", make)


def raw(spark: SparkSession, sf_dir: str) -> str:
    def make(folder):
        ingest(spark, landing(spark, sf_dir), folder, years_of_family=tables.YEARS)

    return _once(f"{_root(spark, sf_dir)}/raw", make)


def loaded_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified rows that went through files: published, landed, loaded and harmonised."""
    return unify_store(spark, raw(spark, sf_dir), tables.aliases(spark, sf_dir))


def warehouse(spark: SparkSession, sf_dir: str) -> str:
    def make(folder):
        rebuild(spark, raw(spark, sf_dir), folder, tables.aliases(spark, sf_dir))

    return _once(f"{_root(spark, sf_dir)}/warehouse", make)


def star(spark: SparkSession, sf_dir: str) -> Star:
    return read_star(spark, warehouse(spark, sf_dir))
