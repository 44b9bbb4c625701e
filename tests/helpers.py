"""Small inline frames for tests."""

from pyspark.sql import functions as F

from stocktide.operators.clean import flag_suppressed
from stocktide.operators.star import observations

FACT_SCHEMA = (
    "archive_date_parsed date, hospital_name string, specialty_name string, adult_child string, "
    "time_band string, count long, granularity string, list_type string, source_year_key string, "
    "hospital_group string, hospital_hipe string, specialty_hipe string, case_type string"
)


def unified(spark, rows):
    """(date, hospital, specialty, population, band, count, granularity, list type) -> unified rows."""
    from datetime import date

    full = []
    for day, hospital, specialty, population, band, count, granularity, list_type in rows:
        parsed = date.fromisoformat(day) if day else None
        year = day[:4] if day else "2026"
        full.append(
            (parsed, hospital, specialty, population, band, count, granularity, list_type, year,
             None, None, None, None)
        )
    frame = spark.createDataFrame(full, FACT_SCHEMA)
    text = F.date_format("archive_date_parsed", "dd/MM/yyyy")
    return flag_suppressed(frame).withColumn("archive_date", text)


def facts(spark, rows):
    return observations(unified(spark, rows))


def as_set(df, *columns):
    return {tuple(row) for row in (df.select(*columns) if columns else df).collect()}


def column(df, name="out"):
    return [row[name] for row in df.select(name).collect()]
