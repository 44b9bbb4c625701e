"""Findings read off a series: records, turning points, growth, inversions, ratios.

The inputs are aggregated series, at most one row per entity and snapshot date, so a window over one
entity is as long as its calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def record_high(series: DataFrame, by, value: str = "total") -> DataFrame:
    """Per entity: the latest value, the highest earlier one with its date, and whether it is beaten."""
    newest = Window.partitionBy(*by).orderBy(F.desc("archive_date"))
    marked = series.withColumn("_from_last", F.row_number().over(newest))
    is_last, amount = F.col("_from_last") == 1, F.col(value)
    # Among equal peaks the first by date counts.
    peak_order = F.struct(amount, -F.unix_date("archive_date"))
    earlier = F.when(~is_last, peak_order)
    return marked.groupBy(*by).agg(
        F.max("archive_date").alias("latest_date"),
        F.max(F.when(is_last, amount)).alias("latest_value"),
        F.max(F.when(~is_last, amount)).alias("previous_peak"),
        F.max_by("archive_date", earlier).alias("previous_peak_date"),
    ).withColumn(
        "is_record",
        F.coalesce(F.col("latest_value") > F.col("previous_peak"), F.lit(True)),
    )


def turning_points(series: DataFrame, by, value: str = "total") -> DataFrame:
    """Dates whose value is above (peak) or below (trough) both neighbouring snapshots."""
    in_time = Window.partitionBy(*by).orderBy("archive_date")
    before, after = F.lag(value).over(in_time), F.lead(value).over(in_time)
    here = F.col(value)
    kind = F.when((here > before) & (here > after), "peak").when(
        (here < before) & (here < after), "trough"
    )
    return (
        series.withColumn("kind", kind)
        .where("kind is not null")
        .select(*by, "archive_date", value, "kind")
    )


def growth(series: DataFrame, by, value: str = "total") -> DataFrame:
    """First and last value with their multiple in percent, rounded down, and the range between."""
    return (
        series.groupBy(*by)
        .agg(
            F.min_by(value, "archive_date").alias("first_value"),
            F.max_by(value, "archive_date").alias("last_value"),
            F.min(value).alias("lowest"),
            F.max(value).alias("highest"),
        )
        .withColumn("percent_of_first", F.expr("if(first_value > 0, last_value * 100 div first_value, null)"))
    )


def inversions(series: DataFrame, by) -> DataFrame:
    """Per entity: the dates on which more wait over 12 months than under 6."""
    return (
        series.where("twelve_plus > under_6")
        .groupBy(*by)
        .agg(
            F.min("archive_date").alias("first_date"),
            F.max("archive_date").alias("last_date"),
            F.count("*").alias("n_dates"),
        )
    )


def list_type_ratio(series: DataFrame, by, value: str = "total") -> DataFrame:
    """Outpatient total as a percentage of the inpatient one on the same date, rounded down."""
    sums = series.groupBy(*by).agg(
        F.sum(F.when(F.col("list_type") == "ipdc", F.col(value))).alias("ipdc_total"),
        F.sum(F.when(F.col("list_type") == "op", F.col(value))).alias("op_total"),
    )
    both = sums.where("ipdc_total is not null and op_total is not null")
    return both.withColumn("op_percent_of_ipdc", F.expr("if(ipdc_total > 0, op_total * 100 div ipdc_total, null)"))
