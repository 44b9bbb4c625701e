"""Declared schemas. Published cells are text; only harmonised frames carry types."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from .fixed_values import HEADER_NAMES, WIDE_BANDS


def text_schema(names) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


UNIFIED_TYPES = {
    "archive_date": StringType(),
    "hospital_group": StringType(),
    "hospital_hipe": StringType(),
    "hospital_name": StringType(),
    "specialty_hipe": StringType(),
    "specialty_name": StringType(),
    "case_type": StringType(),
    "adult_child": StringType(),
    "time_band": StringType(),
    "count": LongType(),
    "granularity": StringType(),
    "list_type": StringType(),
    "source_year_key": StringType(),
}
UNIFIED = StructType([StructField(n, t) for n, t in UNIFIED_TYPES.items()])

LINEAGE_COLUMNS = ("_source_year_key", "_source_url", "_source_file", "_loaded_date")

# Raw tables hold the published text columns. Every published spelling is declared, so a table that
# mixes spellings over the years reads back by name with the absent ones null.
_DATE, _NAME, _POPULATION = (
    HEADER_NAMES["archive_date"],
    HEADER_NAMES["hospital_name"],
    HEADER_NAMES["adult_child"],
)
_LINEAGE = [
    StructField("_source_year_key", StringType()),
    StructField("_source_url", StringType()),
    StructField("_source_file", StringType()),
    StructField("_loaded_date", DateType()),
]
_LONG_NAMES = [name for names in HEADER_NAMES.values() for name in names]
RAW = {
    "wide": StructType(
        text_schema([_DATE[0], _POPULATION[0], _NAME[0], *WIDE_BANDS, "Total"]).fields + _LINEAGE
    ),
    "wide_specialty": StructType(
        text_schema([_DATE[0], _POPULATION[0], "Speciality", *WIDE_BANDS, "Total"]).fields + _LINEAGE
    ),
    "long": StructType(text_schema(_LONG_NAMES).fields + _LINEAGE),
    "long_early": StructType(text_schema(_LONG_NAMES).fields + _LINEAGE),
}
PARTITIONS = [StructField("dataset", StringType()), StructField("year_key", StringType())]

DIM_DATE = StructType(
    [
        StructField("date_id", LongType()),
        StructField("archive_date", DateType()),
        StructField("year", IntegerType()),
        StructField("month", IntegerType()),
    ]
)
DIM_HOSPITAL = StructType(
    [
        StructField("hospital_id", LongType()),
        StructField("hospital_name", StringType()),
        StructField("hospital_group", StringType()),
        StructField("hospital_hipe", StringType()),
    ]
)
DIM_SPECIALTY = StructType(
    [
        StructField("specialty_id", LongType()),
        StructField("specialty_name", StringType()),
        StructField("specialty_hipe", StringType()),
    ]
)
FACT = StructType(
    [
        StructField("fact_id", LongType()),
        StructField("date_id", LongType()),
        StructField("hospital_id", LongType()),
        StructField("specialty_id", LongType()),
        StructField("case_type", StringType()),
        StructField("adult_child", StringType()),
        StructField("time_band", StringType()),
        StructField("count", LongType()),
        StructField("granularity", StringType()),
        StructField("list_type", StringType()),
        StructField("source_year_key", StringType()),
        StructField("is_suppressed_bucket", BooleanType()),
    ]
)
ATTRIBUTE = StructType(
    [
        StructField("archive_date_parsed", DateType()),
        StructField("hospital_name", StringType()),
        StructField("hospital_group", StringType()),
        StructField("hospital_hipe", StringType()),
        StructField("specialty_name", StringType()),
        StructField("specialty_hipe", StringType()),
        StructField("list_type", StringType()),
        StructField("source_year_key", StringType()),
        StructField("is_suppressed_bucket", BooleanType()),
    ]
)
