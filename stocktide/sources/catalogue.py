"""Which datasets and years exist, what shape their files have and where they come from."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import (
    DATASET_LIST_TYPE,
    IPDC_HOSPITAL,
    IPDC_SPECIALTY,
    OP_HOSPITAL,
    OP_SPECIALTY,
    PUBLISHED_FILES,
    TABLE_PREFIXES,
    UPLOADS,
    WIDE_SPECIALTY,
    YEARS_OF_FAMILY,
)

HOSPITAL_DATASETS = (IPDC_HOSPITAL, OP_HOSPITAL)
SPECIALTY_DATASETS = (IPDC_SPECIALTY, OP_SPECIALTY)


def family_of(dataset: Column, year_key: Column, years_of_family=YEARS_OF_FAMILY) -> Column:
    """Shape family. Specialty files have one shape; a hospital file's depends on its year.

    Null for an unknown dataset or, in the hospital files, an unknown year.
    """
    family = F.when(dataset.isin(*SPECIALTY_DATASETS), F.lit(WIDE_SPECIALTY))
    for name, years in years_of_family.items():
        family = family.when(dataset.isin(*HOSPITAL_DATASETS) & year_key.isin(*years), F.lit(name))
    return family


def list_type_of(dataset: Column) -> Column:
    pairs = chain.from_iterable(DATASET_LIST_TYPE.items())
    return F.try_element_at(F.create_map(*[F.lit(text) for text in pairs]), dataset)


def source_url_of(dataset: Column, year_key: Column, files=PUBLISHED_FILES) -> Column:
    """Published address of a dataset's year; null when it is not in the catalogue."""
    pairs = [
        (f"{name}/{year}", UPLOADS + path)
        for name, years in files.items()
        for year, path in years.items()
    ]
    table = F.create_map(*[F.lit(text) for pair in pairs for text in pair])
    return F.try_element_at(table, F.concat_ws("/", dataset, year_key))


def catalogue(spark: SparkSession, files=PUBLISHED_FILES) -> DataFrame:
    """One row per known (dataset, year_key)."""
    rows = [(name, year) for name, years in files.items() for year in years]
    keys = spark.createDataFrame(rows, "dataset string, year_key string")
    dataset, year_key = F.col("dataset"), F.col("year_key")
    return keys.select(
        dataset,
        year_key,
        family_of(dataset, year_key).alias("family"),
        list_type_of(dataset).alias("list_type"),
        source_url_of(dataset, year_key, files).alias("source_url"),
    )


def select_sources(known: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(catalogue rows asked for, requests the catalogue does not know)."""
    keys = ["dataset", "year_key"]
    return known.join(wanted, keys, "left_semi"), wanted.join(known, keys, "left_anti")


def discover_tables(tables: DataFrame, prefixes=TABLE_PREFIXES) -> DataFrame:
    """Raw tables by name: the rest of the name after a known prefix is the year key.

    `tables` has a `table_name` column, such as one made from `spark.catalog.listTables()`. Names are
    compared with `startswith`, since '_' is a wildcard to LIKE.
    """
    name = F.col("table_name")
    # Longest prefix first, should one prefix start with another.
    by_length = sorted(prefixes.items(), key=lambda pair: -len(pair[0]))
    dataset = F.lit(None).cast("string")
    year_key = F.lit(None).cast("string")
    for prefix, found in reversed(by_length):
        starts = name.startswith(prefix)
        dataset = F.when(starts, found).otherwise(dataset)
        year_key = F.when(starts, F.expr(f"substring(table_name, {len(prefix) + 1})")).otherwise(
            year_key
        )
    return (
        tables.select(name, dataset.alias("dataset"), year_key.alias("year_key"))
        .where(F.col("dataset").isNotNull())
        .withColumn("list_type", list_type_of(F.col("dataset")))
        .withColumn("is_specialty_file", F.col("dataset").isin(*SPECIALTY_DATASETS))
    )
