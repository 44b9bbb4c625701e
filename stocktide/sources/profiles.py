"""Column profiles that add up: `<profiles>/dataset=D/year_key=Y` holds counts and a distinct sketch of each raw column.

A sketch is of bounded size, and the sketches of several years or datasets merge into that of all their rows. So a
profile of any of them reads these few rows, and a new month costs a scan of the years it changed. Distinct counts
are estimates; `operators.quality.column_profile` has the exact ones, at the price of a scan.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DoubleType, FloatType, StructType

from ..schemas import LINEAGE_COLUMNS, PARTITIONS
from . import ledger, raw_store

#: 2 to this power are a sketch's registers: 16 KB at most, a standard error of 0.8 per cent.
SKETCH_BITS = 14
SKETCHES = (
    "column_name string, column_type string, n_rows bigint, n_present bigint, sketch binary, source string, "
    "dataset string, year_key string"
)


def _sketched(cell: Column, kind: DataType) -> Column:
    """A cell as bytes, equal where cells are. Sketches pass over what has no bytes, so one is put before."""
    if isinstance(kind, BinaryType):
        return F.concat(F.lit(b"="), cell)
    if isinstance(kind, (FloatType, DoubleType)):
        cell = cell + F.lit(0).cast(kind)  # the two zeros are one value
    elif isinstance(kind, (ArrayType, StructType)):
        cell = F.when(cell.isNotNull(), F.to_json(F.struct(cell), {"ignoreNullFields": "false"}))
    return F.concat(F.lit("="), cell.cast("string"))


def column_sketches(rows: DataFrame, *keys: str) -> DataFrame:
    """(*keys, column_name, column_type, n_rows, n_present, sketch) of every other column, in one aggregation whose
    partial results are bounded: a sketch for each key and column, whatever the rows. Nulls are not counted as values."""
    cells = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.count("*").alias("n_rows"),
            F.count(F.col(f"`{field.name}`")).alias("n_present"),
            F.hll_sketch_agg(_sketched(F.col(f"`{field.name}`"), field.dataType), SKETCH_BITS).alias("sketch"),
        )
        for field in rows.schema
        if field.name not in keys
    ]
    return rows.groupBy(*keys).agg(F.array(*cells).alias("columns")).select(*keys, F.inline("columns"))


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """(*keys, column_name, column_type, n_rows, n_present, n_distinct) of all rows behind the sketches of a key; of
    all there are, without keys. A column of two types has a row for each."""
    return sketches.groupBy(*keys, "column_name", "column_type").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_present").alias("n_present"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"),
    )


def read_sketches(spark: SparkSession, profiles: str) -> DataFrame:
    """All rows of a profile store; none of one that was never written."""
    try:
        return spark.read.schema(SKETCHES).parquet(profiles)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SKETCHES)


def _years(keys: list[tuple[str, str]]) -> Column:
    """The condition of being one of some dataset-years; on partition columns, so that no others are listed or read."""
    of = defaultdict(list)
    for dataset, year in keys:
        of[dataset].append(year)
    return reduce(or_, ((F.col("dataset") == d) & F.col("year_key").isin(*years) for d, years in of.items()))


def refresh(spark: SparkSession, raw: str, profiles: str) -> list[tuple[str, str]]:
    """Profile the dataset-years of a raw store whose publication is another than when they were profiled last.

    Returns them, as (dataset, year_key). What the store holds is taken from its ledger; each row here says of which
    entry it was made, so that a run that is cut off is made up for by the next. Years without rows are not there.
    """
    said = F.to_json(F.struct("folder", "n_files", "bytes", "judged_at"))
    loaded = ledger.loaded(ledger.read_ledger(spark, raw)).select("dataset", "year_key", F.sha2(said, 256).alias("source"))
    held = read_sketches(spark, profiles).select("dataset", "year_key", "source").distinct()
    # As many rows as the catalogue has entries.
    changed = loaded.join(held, ["dataset", "year_key", "source"], "left_anti").orderBy("dataset", "year_key").collect()
    if not changed:
        return []
    keys = [field.name for field in PARTITIONS]
    chosen = _years([(row.dataset, row.year_key) for row in changed])
    parts = [
        column_sketches(raw_store.read_raw(spark, raw, family).drop(*LINEAGE_COLUMNS).where(chosen), *keys)
        for family in raw_store.families_present(spark, raw)
    ]
    sources = spark.createDataFrame(changed, loaded.schema)
    # The names of a catalogue; `refresh` has just had them all on the driver.
    found = reduce(DataFrame.unionByName, parts).join(F.broadcast(sources), keys)
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(profiles)
    return [(row.dataset, row.year_key) for row in changed]


def profile(spark: SparkSession, profiles: str, *keys: str) -> DataFrame:
    """The profile of the whole store, or by `dataset` or `year_key`, from its sketches alone."""
    return merged(read_sketches(spark, profiles), *keys)
