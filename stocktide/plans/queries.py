"""Questions users ask of the data.

`facts` is a frame with names on each row, or the fact table of a star schema with `keys=IDS`; in
the second case the result carries ids, and `star.named` puts names to the few aggregated rows.
Questions that the caller would ask once per hospital, list type and population are answered for all
of them by one aggregation; a caller who wants one filters the result, or the facts beforehand.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import (
    BUCKET_COLUMNS,
    SPECIALTY_GRANULARITIES,
    TOP_SPECIALTIES,
    UNKNOWN_BUCKET,
)
from ..operators.star import Star, named
from ..shared_dir import fixed
from ..operators.totals import (
    IDS,
    NAMES,
    Keys,
    bucket_sums,
    bucket_totals,
    eligible,
    known_domain,
    row_total,
    sums,
    unknown_bands,
    with_bucket,
)

COMBINATION = ("list_type", "adult_child")


def restrict(
    facts: DataFrame,
    hospital=None,
    specialty=None,
    adult_child=None,
    list_type=None,
    archive_date=None,
    granularities=None,
) -> DataFrame:
    """All given conditions at once; those left out do not filter."""
    for column, value in (
        ("hospital_name", hospital),
        ("specialty_name", specialty),
        ("adult_child", adult_child),
        ("list_type", list_type),
        ("archive_date", archive_date),
    ):
        if value is not None:
            facts = facts.where(F.col(column) == F.lit(value))
    if granularities is not None:
        facts = facts.where(F.col("granularity").isin(*granularities))
    return facts


def restrict_star(
    star: Star, hospital=None, specialty=None, adult_child=None, list_type=None, archive_date=None
) -> Star:
    """The star schema with its facts limited to the given names.

    A name or date has one row in its dimension, so its id is looked up first and becomes a plain
    condition on the facts, which the scan uses to skip row groups.
    """
    facts = restrict(star.fact, adult_child=adult_child, list_type=list_type)
    for dim, name, value, key in (
        (star.dim_hospital, "hospital_name", hospital, "hospital_id"),
        (star.dim_specialty, "specialty_name", specialty, "specialty_id"),
        (star.dim_date, "archive_date", archive_date, "date_id"),
    ):
        if value is not None:
            found = dim.where(F.col(name) == F.lit(value)).select(key).first()
            facts = facts.where(F.col(key) == found[0]) if found else facts.where(F.lit(False))
    return replace(star, fact=facts)


# ---- totals of all bands ----------------------------------------------------------------------


def hospital_total_trend(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    """Total per hospital, list type, population and date; bands of unknown length included."""
    rows = eligible(facts, keys.hospital, keys)
    return sums(rows, [keys.hospital, *COMBINATION, keys.date])


def national_total_trend(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    """Total over all hospitals per list type, population and date."""
    return sums(eligible(facts, keys.hospital, keys), [*COMBINATION, keys.date])


def latest_by_list_type(facts: DataFrame, adult_child: str = "Adult") -> DataFrame:
    """Total per list type at the one latest date of the whole data.

    A list type with no rows on that date is absent. The facts are read once: sums per list type and
    date come first, and the latest date is taken over those few rows, at most one per list type and
    calendar day.
    """
    in_total = (
        ~F.col("is_suppressed_bucket")
        & F.col("hospital_name").isNotNull()
        & (F.col("adult_child") == adult_child)
    )
    per_date = (
        facts.where("archive_date is not null")
        .groupBy("list_type", "archive_date")
        .agg(
            F.sum(F.when(in_total, F.col("count"))).alias("total_waiting"),
            F.count_if(in_total).alias("_rows"),
        )
    )
    latest = F.max("archive_date").over(Window.partitionBy())
    return (
        per_date.withColumn("_latest", latest)
        .where("archive_date = _latest and _rows > 0")
        .select("list_type", "archive_date", "total_waiting")
    )


def latest_totals(star: Star, adult_child: str = "Adult") -> DataFrame:
    """`latest_by_list_type` on a star schema.

    The newest date and its id are scalar subqueries of the dimension: the id is a condition that Spark looks up
    before it scans the facts, and nothing runs until the result does. A fact with a hospital id has a
    hospital, so none is joined.
    """
    dated = star.dim_date.where("archive_date is not null")
    newest = dated.agg(F.max_by("date_id", "archive_date")).scalar()
    counted = star.fact.where(
        F.col("hospital_id").isNotNull()
        & ~F.col("is_suppressed_bucket")
        & (F.col("adult_child") == adult_child)
        & (F.col("date_id") == newest)
    )
    sums_ = counted.groupBy("list_type").agg(F.sum("count").alias("total_waiting"))
    date = dated.agg(F.max("archive_date")).scalar()
    return sums_.select("list_type", date.alias("archive_date"), "total_waiting")


# ---- totals by bucket -------------------------------------------------------------------------


def hospital_series(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    """Three buckets and their total per hospital, list type, population and date."""
    rows = eligible(facts, keys.hospital, keys)
    return bucket_totals(rows, [keys.hospital, *COMBINATION, keys.date])


def national_series(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    """Three buckets and their total over all hospitals per list type, population and date."""
    return bucket_totals(eligible(facts, keys.hospital, keys), [*COMBINATION, keys.date])


def specialty_trend(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    """Three buckets per specialty, list type, population and date, from hospital and national rows."""
    rows = eligible(facts, keys.specialty, keys).where(
        F.col("granularity").isin(*SPECIALTY_GRANULARITIES)
    )
    return bucket_totals(rows, [keys.specialty, *COMBINATION, keys.date])


def band_breakdown(
    facts: DataFrame, hospital: str, adult_child: str = "Adult", list_type: str = "ipdc"
) -> tuple[DataFrame, DataFrame]:
    """(buckets by date of one hospital, its band labels that were left out)."""
    rows = eligible(
        restrict(facts, hospital=hospital, adult_child=adult_child, list_type=list_type),
        "hospital_name",
    )
    series = bucket_totals(rows, ["archive_date"]).drop("total").orderBy("archive_date")
    return series, unknown_bands(rows)


def hospital_names(facts: DataFrame) -> DataFrame:
    """Hospitals with any unsuppressed row, dated or not, sorted."""
    rows = facts.where("not is_suppressed_bucket and hospital_name is not null")
    return rows.select("hospital_name").distinct().orderBy("hospital_name")


def published_hospitals(star: Star) -> DataFrame:
    """`hospital_names` on a star schema: dimension rows that occur in an unsuppressed fact."""
    seen = star.fact.where("not is_suppressed_bucket and hospital_id is not null")
    # Distinct ids first: partial aggregation leaves a handful per task to shuffle.
    ids = seen.select("hospital_id").distinct()
    return star.dim_hospital.join(ids, "hospital_id", "left_semi").orderBy("hospital_name")


# ---- rankings ---------------------------------------------------------------------------------


def latest_dates(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    """Latest date with specialty rows per list type and population, suppressed rows included."""
    rows = facts.where(
        F.col("granularity").isin(*SPECIALTY_GRANULARITIES)
        & F.col(keys.date).isNotNull()
        & known_domain()
    )
    return rows.groupBy(*COMBINATION).agg(F.max(keys.date).alias("last_updated"))


def at_dates(facts: DataFrame, dates, keys: Keys = NAMES) -> DataFrame:
    """Rows at the given date of their list type and population.

    `dates` are rows of `latest_dates`, at most one per list type and population, both from fixed
    lists. As plain conditions they reach the scan, which then skips all other snapshots.
    """
    here = F.lit(False)
    for row in dates:
        here = here | (
            (F.col("list_type") == row.list_type)
            & (F.col("adult_child") == row.adult_child)
            & (F.col(keys.date) == F.lit(row.last_updated))
        )
    return facts.where(here)


def specialty_breakdown(facts: DataFrame, keys: Keys = NAMES, dates=None) -> DataFrame:
    """Buckets of every specialty at the latest date of its list type and population.

    Facts with names on each row are read once: sums by date come first, and of those the ones at the latest
    date stay. In the fact table of a star schema, whose scan skips all other snapshots, the latest dates
    are looked up first, unless given.
    """
    if dates is None and keys == NAMES:
        return _at_latest(facts)
    dates = latest_dates(facts, keys).collect() if dates is None else dates
    rows = at_dates(eligible(facts, keys.specialty, keys), dates, keys)
    totals = bucket_totals(rows, [*COMBINATION, keys.date, keys.specialty])
    return totals.withColumnRenamed(NAMES.date, "last_updated")


def _at_latest(facts: DataFrame) -> DataFrame:
    """`specialty_breakdown` in one pass. What the window sees is a row per date and specialty."""
    dating = F.col("granularity").isin(*SPECIALTY_GRANULARITIES)
    counted = ~F.col("is_suppressed_bucket") & F.col("specialty_name").isNotNull()
    rows = with_bucket(facts.where(F.col("archive_date").isNotNull() & known_domain() & (dating | counted)))
    rows = rows.withColumn("bucket", F.when(counted, F.col("bucket")).otherwise(F.lit(UNKNOWN_BUCKET)))
    per_date = rows.groupBy(*COMBINATION, "archive_date", "specialty_name").agg(
        *bucket_sums(),
        F.count_if(F.col("bucket") != UNKNOWN_BUCKET).alias("_known"),
        F.max(F.when(dating, F.col("archive_date"))).alias("_dated"),
    )
    latest = F.max("_dated").over(Window.partitionBy(*COMBINATION))
    at_latest = per_date.withColumn("last_updated", latest).where("archive_date = last_updated and _known > 0")
    return at_latest.select(*COMBINATION, "last_updated", "specialty_name", *BUCKET_COLUMNS, row_total().alias("total"))


def ranked(breakdown: DataFrame, k: int = TOP_SPECIALTIES) -> DataFrame:
    """The k largest specialties per list type and population, ties by name, and how many there are.

    Spark limits each task to its own k rows per group before the shuffle, so a group is never
    gathered whole; the number of specialties is a count of its own for the same reason. The
    breakdown, a row per specialty, is fixed so that both read it and not the facts.
    """
    breakdown = fixed(breakdown)
    by_size = Window.partitionBy(*COMBINATION).orderBy(F.desc("total"), F.asc("specialty_name"))
    top = breakdown.withColumn("rank", F.row_number().over(by_size)).where(F.col("rank") <= k)
    tracked = breakdown.groupBy(*COMBINATION).agg(F.count("*").alias("n_tracked"))
    return top.join(tracked, list(COMBINATION))


def top_specialties(facts: DataFrame, k: int = TOP_SPECIALTIES, dates=None) -> DataFrame:
    return ranked(specialty_breakdown(facts, dates=dates), k)


# ---- the same on a star schema: sums by id first, names on the sums ------------------------------


def star_hospital_series(star: Star) -> DataFrame:
    return named(hospital_series(star.fact, IDS), star)


def star_national_series(star: Star) -> DataFrame:
    return named(national_series(star.fact, IDS), star)


def star_hospital_total_trend(star: Star) -> DataFrame:
    return named(hospital_total_trend(star.fact, IDS), star)


def star_national_total_trend(star: Star) -> DataFrame:
    return named(national_total_trend(star.fact, IDS), star)


def star_specialty_trend(star: Star) -> DataFrame:
    return named(specialty_trend(star.fact, IDS), star)


def star_top_specialties(star: Star, k: int = TOP_SPECIALTIES, dates=None) -> DataFrame:
    """`top_specialties` on a star schema.

    Date ids follow the calendar, so the latest date is the largest id, and only ids meet the facts.
    """
    breakdown = named(specialty_breakdown(star.fact, IDS, dates), star)
    return ranked(breakdown.withColumnRenamed("archive_date", "last_updated"), k)
