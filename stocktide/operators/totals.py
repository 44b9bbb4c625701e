"""Sums over comparable buckets.

Facts come in two forms and every function takes either: with names and dates on each row
(`NAMES`), or with the ids of the star schema (`IDS`), where the names are joined on after the sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    BUCKET_COLUMNS,
    BUCKETS,
    LIST_TYPES,
    POPULATIONS,
    UNKNOWN_BUCKET,
)
from ..functions.bands import band_digits, bucket_of_digits, classify_band


@dataclass(frozen=True)
class Keys:
    date: str
    hospital: str
    specialty: str


NAMES = Keys("archive_date", "hospital_name", "specialty_name")
IDS = Keys("date_id", "hospital_id", "specialty_id")


def eligible(facts: DataFrame, entity: str, keys: Keys = NAMES) -> DataFrame:
    """Unsuppressed, dated rows of one entity level.

    A null hospital is what keeps national specialty rows, which count the same people again, out of
    hospital sums.
    """
    return facts.where(
        ~F.col("is_suppressed_bucket") & F.col(keys.date).isNotNull() & F.col(entity).isNotNull()
    )


def known_domain() -> Column:
    return F.col("list_type").isin(*LIST_TYPES) & F.col("adult_child").isin(*POPULATIONS)


def with_bucket(facts: DataFrame) -> DataFrame:
    """Facts with their band's bucket. The digits get a projection of their own, so that the pattern
    is matched once per row and not once per branch."""
    digits = facts.withColumn("_digits", band_digits(F.col("time_band")))
    return digits.withColumn("bucket", bucket_of_digits(F.col("_digits"))).drop("_digits")


def bucket_sums() -> list[Column]:
    """The three bucket sums, 0 where a bucket has no rows. Needs a `bucket` column."""
    return [
        F.coalesce(F.sum(F.when(F.col("bucket") == label, F.col("count"))), F.lit(0))
        .cast("bigint")
        .alias(name)
        for name, label in zip(BUCKET_COLUMNS, BUCKETS)
    ]


def row_total() -> Column:
    return sum((F.col(name) for name in BUCKET_COLUMNS[1:]), F.col(BUCKET_COLUMNS[0]))


def bucket_totals(facts: DataFrame, by) -> DataFrame:
    """Per key: the three buckets side by side and their total.

    Conditional sums need one shuffle of partial sums; a pivot would take two. Keys whose rows all
    have unknown bands give no row.
    """
    known = F.count_if(F.col("bucket") != UNKNOWN_BUCKET).alias("_known")
    return (
        with_bucket(facts)
        .groupBy(*by)
        .agg(*bucket_sums(), known)
        .where("_known > 0")
        .drop("_known")
        .withColumn("total", row_total())
    )


def sums(facts: DataFrame, by) -> DataFrame:
    """Per key: the sum of all bands, unknown ones too; null when every count is missing."""
    return facts.groupBy(*by).agg(F.sum("count").alias("total_waiting"))


def unknown_bands(facts: DataFrame) -> DataFrame:
    """Band labels no bucket can be read from, with their number of rows."""
    return (
        facts.groupBy("time_band")
        .agg(F.count("*").alias("n_rows"))
        .where(classify_band(F.col("time_band")) == UNKNOWN_BUCKET)
    )


def bucket_pivot(facts: DataFrame, by) -> DataFrame:
    """Long -> wide as a pivot over the fixed bucket list; absent combinations are 0."""
    wide = (
        with_bucket(facts)
        .where(F.col("bucket") != UNKNOWN_BUCKET)
        .groupBy(*by)
        .pivot("bucket", list(BUCKETS))
        .agg(F.sum("count"))
    )
    return wide.fillna(0, list(BUCKETS))
