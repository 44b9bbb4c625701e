"""Dimensions, surrogate keys and the fact table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared_dir import fixed
from .joins import lookup_join

FIRST_SEEN = ("list_type", "source_year_key", "archive_date_parsed")
#: What the dimensions are made from.
ATTRIBUTES = (
    "archive_date_parsed", "hospital_name", "hospital_group", "hospital_hipe", "specialty_name", "specialty_hipe",
    "list_type", "source_year_key", "is_suppressed_bucket",
)
_LOW_33_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_hospital: DataFrame
    dim_specialty: DataFrame
    fact: DataFrame


def dense_ids(df: DataFrame, order: str, name: str) -> DataFrame:
    """Number the rows 1..N in the order of a unique column, without moving them to one task.

    The rows are sorted by range over many partitions and fixed there, so both uses below see the
    same partitions. Each partition numbers its own rows; what is added up across partitions is one
    row count per partition.
    """
    rows = fixed(df.orderBy(order)).withColumn("_at", F.monotonically_increasing_id())
    placed = rows.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    # One row per partition of the sort, which the session's partition count bounds.
    numbered = placed.join(F.broadcast(starts), "_part")
    position = F.col("_at").bitwiseAND(F.lit(_LOW_33_BITS))
    return numbered.select(
        (F.col("_start") + position + 1).cast("bigint").alias(name), *[df[c] for c in df.columns]
    )


def stable_ids(names: DataFrame, known: DataFrame, key: str, name: str) -> DataFrame:
    """(id, key): the ids of `known` (id, key) as they are, and the next ones for names it lacks, in their order.

    An id is never moved or given out again, so that facts which hold it need not be written again.
    """
    fresh = names.select(key).distinct().join(known, key, "left_anti")
    last = F.coalesce(known.agg(F.max(name)).scalar(), F.lit(0).cast("bigint"))
    numbered = dense_ids(fresh, key, name).select((F.col(name) + last).alias(name), key)
    return known.select(name, key).unionByName(numbered)


def _numbered(rows: DataFrame, key: str, name: str, ids: DataFrame | None) -> DataFrame:
    """Rows with dense ids, or with those of a registry (id, key) that has all their keys."""
    if ids is None:
        return dense_ids(rows, key, name)
    return rows.join(ids, key).select(name, *rows.columns)


def first_per_key(
    df: DataFrame, key: str, values, order=FIRST_SEEN, skip_nulls: bool = False
) -> DataFrame:
    """One row per non-null key with the values of its first row.

    Rows are made distinct first, which hashes them away before the shuffle: what is left per key is
    at most one row per snapshot and set of values. The first of those is a minimum over an ordering
    struct. With `skip_nulls` each value is the first non-null one.
    """
    sequence = F.struct(*order, *values)
    known = df.where(F.col(key).isNotNull())
    columns = list(dict.fromkeys([key, *order, *values]))
    known = known.select(*columns).distinct()
    if skip_nulls:
        firsts = [
            F.min_by(F.col(v), F.when(F.col(v).isNotNull(), sequence)).alias(v) for v in values
        ]
        return known.groupBy(key).agg(*firsts)
    first = F.min(sequence).alias("_first")
    return known.groupBy(key).agg(first).select(key, *[F.col(f"_first.{v}") for v in values])


def by_entity(attributes: DataFrame) -> DataFrame:
    """Distinct ATTRIBUTES, those of a row's hospital and those of its specialty in rows of their own.

    No dimension looks at a hospital together with a specialty. Their pairs are nearly as many as the published rows;
    apart, they are a row per entity and snapshot, which partial sums find before the shuffle.
    """
    hospital, specialty = F.lit(True), F.lit(False)
    sides = (
        F.when(F.col("specialty_name").isNull(), F.array(hospital))
        .when(F.col("hospital_name").isNull(), F.array(specialty))
        .otherwise(F.array(hospital, specialty))
    )
    split = attributes.withColumn("_hospital", F.explode(sides))
    of_hospital = {c: F.when(F.col("_hospital"), F.col(c)) for c in ATTRIBUTES if c.startswith("hospital_")}
    of_specialty = {c: F.when(~F.col("_hospital"), F.col(c)) for c in ATTRIBUTES if c.startswith("specialty_")}
    return split.withColumns(of_hospital | of_specialty).select(*ATTRIBUTES).distinct()


def distinct_dates(unified: DataFrame) -> DataFrame:
    day = F.col("archive_date_parsed").alias("archive_date")
    return unified.where("archive_date_parsed is not null").select(day).distinct()


def build_dim_date(unified: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    dated = _numbered(distinct_dates(unified), "archive_date", "date_id", ids)
    return dated.select(
        "date_id", "archive_date", F.year("archive_date").alias("year"), F.month("archive_date").alias("month")
    )


def build_dim_hospital(unified: DataFrame, skip_nulls: bool = False, ids: DataFrame | None = None) -> DataFrame:
    """Hospitals of unsuppressed rows."""
    rows = unified.where("not is_suppressed_bucket")
    values = ("hospital_group", "hospital_hipe")
    first = first_per_key(rows, "hospital_name", values, skip_nulls=skip_nulls)
    return _numbered(first, "hospital_name", "hospital_id", ids)


def build_dim_specialty(unified: DataFrame, skip_nulls: bool = False, ids: DataFrame | None = None) -> DataFrame:
    """Specialties of unsuppressed rows."""
    rows = unified.where("not is_suppressed_bucket")
    first = first_per_key(rows, "specialty_name", ("specialty_hipe",), skip_nulls=skip_nulls)
    return _numbered(first, "specialty_name", "specialty_id", ids)


def build_fact(
    unified: DataFrame, dim_date: DataFrame, dim_hospital: DataFrame, dim_specialty: DataFrame
) -> DataFrame:
    """Names and dates -> ids by left joins; a row with no match keeps a null id.

    Fact ids are unique but not dense: numbering every row 1..N would need one global order, and
    nothing reads them.
    """
    dates = dim_date.select("date_id", F.col("archive_date").alias("archive_date_parsed"))
    hospitals = dim_hospital.select("hospital_id", "hospital_name")
    specialties = dim_specialty.select("specialty_id", "specialty_name")
    # One row per snapshot date: calendar days bound it, whatever the number of facts.
    rows = unified.join(F.broadcast(dates), "archive_date_parsed", "left")
    rows = lookup_join(rows, hospitals, "hospital_name")
    rows = lookup_join(rows, specialties, "specialty_name")
    return rows.select(
        F.monotonically_increasing_id().alias("fact_id"),
        "date_id",
        "hospital_id",
        "specialty_id",
        "case_type",
        "adult_child",
        "time_band",
        "count",
        "granularity",
        "list_type",
        "source_year_key",
        "is_suppressed_bucket",
    )


def named(frame: DataFrame, star: Star) -> DataFrame:
    """Replace the ids in an aggregated frame by names and dates (inner joins)."""
    for key, dim, name in (
        ("date_id", star.dim_date, "archive_date"),
        ("hospital_id", star.dim_hospital, "hospital_name"),
        ("specialty_id", star.dim_specialty, "specialty_name"),
    ):
        if key in frame.columns:
            frame = frame.join(dim.select(key, name), key).drop(key)
    return frame


def observations(unified: DataFrame) -> DataFrame:
    """Unified rows as facts with names: the parsed date takes the place of the published text."""
    return unified.drop("archive_date").withColumnRenamed("archive_date_parsed", "archive_date")


def star_observations(star: Star) -> DataFrame:
    """Facts of a star schema with names and dates on each row, unmatched ones with nulls."""
    facts = star.fact
    for key, dim, name in (
        ("date_id", star.dim_date, "archive_date"),
        ("hospital_id", star.dim_hospital, "hospital_name"),
        ("specialty_id", star.dim_specialty, "specialty_name"),
    ):
        facts = lookup_join(facts, dim.select(key, name), key).drop(key)
    return facts
