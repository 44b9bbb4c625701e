"""Wide and long publications -> one long shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    DATASET_LIST_TYPE,
    HEADER_NAMES,
    HOSPITAL,
    HOSPITAL_SPECIALTY,
    NATIONAL_SPECIALTY,
    WIDE_BANDS,
)
from ..functions.cells import parse_count
from ..sources.catalogue import list_type_of
from .clean import conform, merge_headers


def unpivot_bands(df: DataFrame, ids, bands=WIDE_BANDS) -> DataFrame:
    """One row per row and band column present, as `time_band` and `count`."""
    there = [band for band in bands if band in df.columns]
    long = df.select(*ids, *[F.col(f"`{b}`") for b in there]).unpivot(
        list(ids), there, "time_band", "_cell"
    )
    return long.withColumn("count", parse_count(F.col("_cell"))).drop("_cell")


def _tagged(df: DataFrame, granularity: str) -> DataFrame:
    return df.withColumns(
        {
            "granularity": F.lit(granularity),
            "list_type": list_type_of(F.col("dataset")),
            "source_year_key": F.col("year_key"),
        }
    )


def _wide_ids(df: DataFrame, names) -> DataFrame:
    merged = {n: HEADER_NAMES[n] for n in names}
    bands = [F.col(f"`{b}`") for b in WIDE_BANDS if b in df.columns]
    return merge_headers(df, merged, keep=[*bands, "dataset", "year_key"])


def wide_to_long(df: DataFrame) -> DataFrame:
    """Wide hospital files; the published total is dropped."""
    names = ("archive_date", "adult_child", "hospital_name")
    long = unpivot_bands(_wide_ids(df, names), [*names, "dataset", "year_key"])
    return conform(_tagged(long, HOSPITAL))


def wide_attributes(df: DataFrame) -> DataFrame:
    """What `wide_to_long` says of each published row besides its bands and counts."""
    return conform(_tagged(_wide_ids(df, ("archive_date", "adult_child", "hospital_name")), HOSPITAL))


def wide_specialty_attributes(df: DataFrame, summed_list_types=("op",)) -> DataFrame:
    """What `wide_specialty_to_long` says of each published row besides its bands and counts."""
    names = ("archive_date", "adult_child", "specialty_name")
    in_parts = [d for d, list_type in DATASET_LIST_TYPE.items() if list_type in summed_list_types]
    # Parts are added up only where all of these are known; other rows of such a dataset are left out.
    whole = reduce(lambda a, b: a & b, [F.col(name).isNotNull() for name in names])
    doubled = F.coalesce(F.col("dataset").isin(*in_parts), F.lit(False))
    return conform(_tagged(_wide_ids(df, names).where(~doubled | whole), NATIONAL_SPECIALTY))


def long_attributes(df: DataFrame) -> DataFrame:
    """What `long_rows` says of each published row besides its band and count."""
    return conform(_tagged(merge_headers(df, keep=["dataset", "year_key"]).drop("count", "time_band"), HOSPITAL_SPECIALTY))


def sum_duplicates(df: DataFrame, keys, no_null=None) -> DataFrame:
    """Rows that share a key become one: their sum, 0 when all are missing.

    Rows that lack one of `no_null` (by default: of the keys) are dropped.
    """
    return (
        df.dropna(subset=list(no_null or keys))
        .groupBy(*keys)
        .agg(F.coalesce(F.sum("count"), F.lit(0).cast("bigint")).alias("count"))
    )


def wide_specialty_to_long(df: DataFrame, summed_list_types=("op",)) -> DataFrame:
    """National specialty files. Where a list type publishes unlabelled parts of one key, add them.

    Both parts of the union filter on the dataset, by which the raw table is partitioned, so each
    file is read once.
    """
    names = ("archive_date", "adult_child", "specialty_name")

    def long(part: DataFrame) -> DataFrame:
        bands = unpivot_bands(_wide_ids(part, names), [*names, "dataset", "year_key"])
        return _tagged(bands, NATIONAL_SPECIALTY)

    in_parts = [d for d, list_type in DATASET_LIST_TYPE.items() if list_type in summed_list_types]
    doubled = F.coalesce(F.col("dataset").isin(*in_parts), F.lit(False))
    single, parts = long(df.where(~doubled)), long(df.where(doubled))
    keys = [c for c in parts.columns if c != "count"]
    summed = sum_duplicates(parts, keys, no_null=[*names, "time_band"])
    return conform(single.unionByName(summed))


def long_rows(df: DataFrame) -> DataFrame:
    """Files that are long already: header variants merged, counts read, other columns dropped."""
    merged = merge_headers(df, keep=["dataset", "year_key"])
    counted = merged.withColumn("count", parse_count(F.col("count")))
    return conform(_tagged(counted, HOSPITAL_SPECIALTY))


def union_all(frames) -> DataFrame:
    """All rows, by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
