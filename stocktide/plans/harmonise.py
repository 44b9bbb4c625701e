"""Raw tables of every shape -> one long frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import HOSPITAL_ALIASES, LONG, LONG_EARLY, WIDE, WIDE_SPECIALTY
from ..functions.dates import parse_archive_date
from ..operators.clean import canonical_names, flag_suppressed
from ..operators.reshape import (
    long_attributes,
    long_rows,
    union_all,
    wide_attributes,
    wide_specialty_attributes,
    wide_specialty_to_long,
    wide_to_long,
)
from ..operators.star import ATTRIBUTES, by_entity
from ..sources.raw_store import families_present, read_raw

NORMALISERS = {
    WIDE: wide_to_long,
    LONG: long_rows,
    LONG_EARLY: long_rows,
    WIDE_SPECIALTY: wide_specialty_to_long,
}


ATTRIBUTES_OF = {
    WIDE: wide_attributes,
    LONG: long_attributes,
    LONG_EARLY: long_attributes,
    WIDE_SPECIALTY: wide_specialty_attributes,
}


def unify(raw_tables: dict[str, DataFrame], aliases=HOSPITAL_ALIASES) -> DataFrame:
    """{family: raw rows} -> unified rows: one union branch per family, however many years it has.

    Names are brought up to date before anything is built on them, suppressed buckets are flagged and
    kept, and the date is parsed next to the published text.
    """
    return _named([NORMALISERS[family](raw) for family, raw in raw_tables.items()], aliases)


def _named(parts: list[DataFrame], aliases) -> DataFrame:
    rows = union_all(parts)
    flagged = flag_suppressed(canonical_names(rows, aliases))
    return flagged.withColumn("archive_date_parsed", parse_archive_date(F.col("archive_date")))


def attribute_rows(raw_tables: dict[str, DataFrame], aliases=HOSPITAL_ALIASES) -> DataFrame:
    """The ATTRIBUTES of `unify`, from published rows as they are: a row is not copied for each band."""
    before = [c for c in ATTRIBUTES if c not in ("archive_date_parsed", "is_suppressed_bucket")]
    parts = [ATTRIBUTES_OF[family](raw).select("archive_date", *before) for family, raw in raw_tables.items()]
    return _named(parts, aliases).select(*ATTRIBUTES)


def unify_attributes(raw_tables: dict[str, DataFrame], aliases=HOSPITAL_ALIASES) -> DataFrame:
    """The distinct ATTRIBUTES of `unify`.

    Rows are made distinct once, when names are looked up and dates parsed, which are lookups in each task: most
    published rows are an entity and snapshot of their own, so that a shuffle before would move all of them twice.
    """
    return attribute_rows(raw_tables, aliases).distinct()


def unify_entities(raw_tables: dict[str, DataFrame], aliases=HOSPITAL_ALIASES) -> DataFrame:
    """`by_entity` of the ATTRIBUTES of `unify`."""
    return by_entity(attribute_rows(raw_tables, aliases))


def store_tables(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    """{family: raw rows} of all that has been loaded."""
    tables = {family: read_raw(spark, raw, family) for family in families_present(spark, raw)}
    if not tables:
        raise ValueError(f"nothing has been loaded in {raw}")
    return tables


def unify_store(spark: SparkSession, raw: str, aliases=HOSPITAL_ALIASES) -> DataFrame:
    """Unified rows of all that has been loaded."""
    return unify(store_tables(spark, raw), aliases)
