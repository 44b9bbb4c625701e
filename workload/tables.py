"""Benchmark tables seen as snapshot data.

Each order line is a group of people waiting: the supplier is the hospital, the brand the specialty,
the order's quarter the snapshot. Years before 1997 are published long with early headers, years
before 2000 long, later ones wide by hospital and, a second cut of the same people, wide by specialty.
Some suppliers are known under an earlier name, some are a small-volume bucket; so are some brands.
"""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.fixed_values import (
    HOSPITAL,
    HOSPITAL_SPECIALTY,
    LONG,
    LONG_EARLY,
    NATIONAL_SPECIALTY,
    SUPPRESSED_HOSPITAL_LABEL,
    SUPPRESSED_SPECIALTY_LABELS,
    WIDE,
    WIDE_BANDS,
    WIDE_SPECIALTY,
)
from stocktide.functions.cells import grouped_digits
from stocktide.operators.clean import canonical_names, flag_suppressed
from stocktide.operators.star import observations as as_observations
from stocktide.shared_dir import small_reads

YEARS = {WIDE: ("2000", "2001"), LONG: ("1997", "1998", "1999"), LONG_EARLY: ("1995", "1996")}
FIRST_PUBLICATION = "2002-01-15"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers of three nations are an earlier name of the supplier numbered before them."""
    supplier = table(spark, sf_dir, "supplier").where("s_nationkey between 5 and 7 and s_suppkey > 0")
    current = F.concat(
        F.lit("Supplier#"), F.lpad((F.col("s_suppkey") - 1).cast("string"), 9, "0")
    )
    return supplier.select(F.col("s_name").alias("alias"), current.alias("canonical"))


def published_hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers under the name they are published with."""
    small = F.col("s_nationkey").isin(9, 10)
    name = F.when(small, SUPPRESSED_HOSPITAL_LABEL).otherwise(F.col("s_name"))
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        name.alias("hospital_name"),
        F.concat(F.lit("Group "), F.col("s_nationkey").cast("string")).alias("hospital_group"),
        F.lpad(F.col("s_suppkey").cast("string"), 4, "0").alias("hospital_hipe"),
    )


def specialties(spark: SparkSession, sf_dir: str) -> DataFrame:
    promo = F.col("p_type") == "PROMO"
    first, second = SUPPRESSED_SPECIALTY_LABELS
    name = (
        F.when(promo & (F.col("p_size") <= 10), first)
        .when(promo & (F.col("p_size") > 40), second)
        .otherwise(F.col("p_brand"))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        "p_size",
        name.alias("specialty_name"),
        F.regexp_extract("p_brand", "#(.*)$", 1).alias("specialty_hipe"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order -> year and snapshot date; the dates are not the same day of each quarter."""
    quarter, year = F.quarter("o_orderdate"), F.year("o_orderdate")
    day = F.when(quarter == 1, 9).otherwise(24 + quarter)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        year.alias("year"),
        F.make_date(year, 3 * quarter - 2, day).alias("archive_date_parsed"),
    )


def base(spark: SparkSession, sf_dir: str, hospitals: DataFrame | None = None) -> DataFrame:
    """One row per order line, before it is cut by hospital or specialty.

    The three joins are left to Spark, which broadcasts a side by its measured size only.
    """
    hospitals = published_hospitals(spark, sf_dir) if hospitals is None else hospitals
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
        "l_linestatus",
    )
    rows = (
        lines.join(snapshots(spark, sf_dir), "l_orderkey")
        .join(specialties(spark, sf_dir), "l_partkey")
        .join(hospitals, "l_suppkey")
    )
    size = F.col("p_size")
    wide_band = (
        F.when(size <= 12, WIDE_BANDS[0])
        .when(size <= 25, WIDE_BANDS[1])
        .when(size <= 38, WIDE_BANDS[2])
        .otherwise(WIDE_BANDS[3])
    )
    long_band = (
        F.when(size <= 10, "0-3 Months")
        .when(size <= 20, "3-6 Months")
        .when(size <= 30, " 6-9 Months")
        .when(size <= 40, "9-12 Months")
        .when(size <= 48, "12+ Months")
        .otherwise("Over a year")
    )
    list_type = F.when(F.col("l_returnflag") == "N", "ipdc").otherwise("op")
    is_wide = F.col("year") >= 2000
    stay = F.when(F.col("l_linenumber") % 2 == 1, "Inpatient").otherwise("Day Case")
    return rows.select(
        "archive_date_parsed",
        "year",
        "hospital_group",
        "hospital_hipe",
        "hospital_name",
        "specialty_hipe",
        "specialty_name",
        F.when(~is_wide & (list_type == "ipdc"), stay).alias("case_type"),
        F.when(F.col("l_linestatus") == "O", "Adult").otherwise("Child").alias("adult_child"),
        F.when(is_wide, wide_band).otherwise(long_band).alias("time_band"),
        F.col("l_quantity").cast("bigint").alias("count"),
        list_type.alias("list_type"),
        F.col("year").cast("string").alias("source_year_key"),
        (F.col("l_linenumber") % 2).alias("part_no"),
    )


def date_text(day, year):
    """The date as that year's files print it."""
    return (
        F.when(year < 1997, F.date_format(day, "yyyy-MM-dd"))
        .when(year < 2000, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "d/M/yyyy"))
    )


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified rows straight from the tables, as ingesting their publications would give them.

    Names are brought up to date on the suppliers, before they meet the lines. A line of a wide year
    is counted by hospital and again by specialty; both cuts come from one pass.
    """
    hospitals = canonical_names(published_hospitals(spark, sf_dir), aliases(spark, sf_dir))
    rows = base(spark, sf_dir, hospitals)
    cuts = F.when(F.col("year") >= 2000, F.array(F.lit(HOSPITAL), F.lit(NATIONAL_SPECIALTY))).otherwise(
        F.array(F.lit(HOSPITAL_SPECIALTY))
    )
    cut = rows.withColumn("granularity", F.explode(cuts))
    long, by_hospital = (
        F.col("granularity") == HOSPITAL_SPECIALTY,
        F.col("granularity") == HOSPITAL,
    )
    shown = {
        "archive_date": date_text(F.col("archive_date_parsed"), F.col("year")),
        "hospital_group": F.when(long, F.col("hospital_group")),
        "hospital_hipe": F.when(long, F.col("hospital_hipe")),
        "hospital_name": F.when(long | by_hospital, F.col("hospital_name")),
        "specialty_hipe": F.when(long, F.col("specialty_hipe")),
        "specialty_name": F.when(~by_hospital, F.col("specialty_name")),
    }
    return flag_suppressed(cut.withColumns(shown)).drop("year", "part_no")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_observations(unified(spark, sf_dir))


# ---- the same as published files ------------------------------------------------------------


def _tags(rows: DataFrame, cut: str) -> DataFrame:
    dataset = F.concat_ws("_", F.col("list_type"), F.lit(cut))
    return rows.withColumns({"dataset": dataset, "year_key": F.col("source_year_key")}).withColumn(
        "ArchiveDate", date_text(F.col("archive_date_parsed"), F.col("year"))
    )


def _bands():
    return [
        grouped_digits(F.sum(F.when(F.col("time_band") == band, F.col("count")))).alias(band)
        for band in WIDE_BANDS
    ]


def _total():
    """The published total, which differs from the sum of its bands by one now and then."""
    total = F.sum("count")
    return grouped_digits(total + F.when(total % 7 == 0, 1).otherwise(0)).alias("Total")


def published_wide(lines: DataFrame) -> DataFrame:
    rows = _tags(lines.where("year >= 2000"), "hospital")
    keys = ["dataset", "year_key", "ArchiveDate", "adult_child", "hospital_name"]
    wide = rows.groupBy(*keys).agg(*_bands(), _total())
    return wide.withColumnsRenamed({"adult_child": "Adult_Child", "hospital_name": "HospitalName"})


def published_wide_specialty(lines: DataFrame) -> DataFrame:
    """Outpatient files print two unlabelled rows per key."""
    rows = _tags(lines.where("year >= 2000"), "specialty")
    part = F.when(F.col("list_type") == "op", F.col("part_no")).alias("_part")
    keys = ["dataset", "year_key", "ArchiveDate", "adult_child", "specialty_name"]
    wide = rows.groupBy(*keys, part).agg(*_bands(), _total()).drop("_part")
    return wide.withColumnsRenamed({"adult_child": "Adult_Child", "specialty_name": "Speciality"})


_LONG_KEYS = ["hospital_group", "hospital_hipe", "hospital_name", "specialty_hipe", "specialty_name",
              "case_type", "adult_child", "time_band"]


def _long(lines: DataFrame, years: str) -> DataFrame:
    rows = _tags(lines.where(years), "hospital")
    ages = F.when(F.col("adult_child") == "Adult", "16-64").otherwise("0-15")
    return (
        rows.groupBy("dataset", "year_key", "ArchiveDate", *_LONG_KEYS)
        .agg(grouped_digits(F.sum("count")).alias("n"))
        .withColumn("Age_Profile", ages)
    )


def published_long(lines: DataFrame) -> DataFrame:
    """Years 1997 to 1999; outpatient files of 1999 spell one column differently."""
    rows = _long(lines, "year between 1997 and 1999")
    odd = (F.col("dataset") == "op_hospital") & (F.col("year_key") == "1999")
    return rows.select(
        "dataset",
        "year_key",
        F.col("ArchiveDate").alias("Archive_Date"),
        F.col("hospital_group").alias("Hospital_Group"),
        F.col("hospital_hipe").alias("Hospital_HIPE"),
        F.col("hospital_name").alias("Hospital_Name"),
        F.when(~odd, F.col("specialty_hipe")).alias("Specialty_HIPE"),
        F.when(odd, F.col("specialty_hipe")).alias("Specialty_HIPE1"),
        F.col("specialty_name").alias("Specialty_Name"),
        F.col("case_type").alias("Case_Type"),
        F.col("adult_child").alias("Adult_Child"),
        "Age_Profile",
        F.col("time_band").alias("Time_Bands"),
        F.col("n").alias("Total"),
    )


def published_long_early(lines: DataFrame) -> DataFrame:
    """Years before 1997; 1996 spells two columns differently."""
    rows = _long(lines, "year < 1997")
    odd = F.col("year_key") == "1996"
    return rows.select(
        "dataset",
        "year_key",
        F.col("ArchiveDate").alias("Archive Date"),
        F.col("hospital_group").alias("Group"),
        F.col("hospital_hipe").alias("Hospital HIPE"),
        F.col("hospital_name").alias("Hospital"),
        F.col("specialty_hipe").alias("Specialty HIPE"),
        F.when(~odd, F.col("specialty_name")).alias("Specialty"),
        F.when(odd, F.col("specialty_name")).alias("Speciality"),
        F.col("case_type").alias("Case Type"),
        F.col("adult_child").alias("Adult/Child"),
        F.col("time_band").alias("Time Bands"),
        F.when(~odd, F.col("n")).alias("Count"),
        F.when(odd, F.col("n")).alias("Total"),
    )


def published(lines: DataFrame) -> dict[str, DataFrame]:
    """{family: rows as published} of the rows of `base`."""
    return {
        WIDE: published_wide(lines),
        LONG: published_long(lines),
        LONG_EARLY: published_long_early(lines),
        WIDE_SPECIALTY: published_wide_specialty(lines),
    }


def write_publication(rows: DataFrame, landing: str, stamp: str = FIRST_PUBLICATION) -> None:
    """Land rows as CSV files. Spaces at the ends of cells are part of the data.

    Dynamic overwriting stages each write in a folder of its own, so several may run at once. Rows are not shuffled
    again to be written: each task that has them writes a file for each year it has, a few of each dataset.
    """
    (
        rows.withColumn("published", F.lit(stamp))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .partitionBy("dataset", "year_key", "published")
        .csv(landing)
    )


def write_all_publications(lines: DataFrame, landing: str) -> None:
    """Every family, each file with the header its dataset and year really have.

    The lines are so small in Parquet that a task which read as much as usual would hold the sums of tens of millions
    of them, and spill: it reads little.
    """
    frames = published(lines)
    long, early = frames[LONG], frames[LONG_EARLY]
    is_op, odd_long = F.col("dataset") == "op_hospital", F.col("year_key") == "1999"
    odd_early = F.col("year_key") == "1996"
    parts = (
        frames[WIDE],
        frames[WIDE_SPECIALTY],
        long.where(~is_op).drop("Specialty_HIPE1"),
        long.where(is_op & ~odd_long).drop("Specialty_HIPE1", "Case_Type"),
        long.where(is_op & odd_long).drop("Specialty_HIPE", "Case_Type"),
        early.where(~odd_early).drop("Speciality", "Total"),
        early.where(odd_early).drop("Specialty", "Count"),
    )
    with small_reads(lines.sparkSession), ThreadPool(len(parts)) as pool:
        pool.map(lambda part: write_publication(part, landing), parts)
