"""Documents for publication: one per hospital, one national, one of specialty rankings.

A document nests list types, populations and a date-ordered series. Its arrays are built from
aggregated rows, one element per snapshot date, so no group grows with the number of facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    BUCKET_COLUMNS,
    DEFAULT_SLUG,
    EMPTY_RANKING_NOTE,
    LIST_TYPES,
    METHODOLOGY_NOTES,
    NATIONAL_NAME,
    NATIONAL_NOTE,
    NATIONAL_SLUG,
    POPULATIONS,
    RANKING_NOTE,
    SERIES_LIMITATIONS,
    SOURCE,
    SPECIALTY_NOTES,
    TOP_SPECIALTIES,
    UNKNOWN_BUCKET,
)
from ..functions.dates import iso_label, month_label
from ..functions.names import slug
from ..operators.joins import lookup_join
from ..operators.quality import suppress_points
from ..operators.star import Star, named
from ..operators.totals import IDS, NAMES, Keys, bucket_sums, row_total, with_bucket
from ..shared_dir import fixed
from .queries import COMBINATION, latest_dates, published_hospitals, star_top_specialties, top_specialties

POINT = ("total", *BUCKET_COLUMNS)


def _is_combination(list_type: str, population: str) -> Column:
    return (F.col("list_type") == list_type) & (F.col("adult_child") == population)


def _series_of(list_type: str, population: str) -> Column:
    """Date-ordered points of one combination; an empty array when it has none."""
    point = F.struct(iso_label(F.col("archive_date")).alias("date"), *POINT)
    mine = _is_combination(list_type, population) & F.col("_has_point")
    return F.array_sort(F.collect_list(F.when(mine, point)))


def _combinations():
    return [(lt, pop, f"_{lt}_{pop}") for lt in LIST_TYPES for pop in POPULATIONS]


def _collected(points: DataFrame, by) -> DataFrame:
    """One row per key with an array per combination. Every combination is there, empty or not."""
    arrays = [_series_of(lt, pop).alias(name) for lt, pop, name in _combinations()]
    return points.groupBy(*by).agg(*arrays)


def _points(rows: DataFrame, by, date: str = NAMES.date) -> DataFrame:
    """Bucket sums per key; `_has_point` tells the keys that make a point in a series.

    Keys without a date, or with unknown bands only, stay: their hospital is published all the same.
    """
    known = F.count_if(F.col("bucket") != UNKNOWN_BUCKET) > 0
    return (
        with_bucket(rows)
        .groupBy(*by, date)
        .agg(*bucket_sums(), known.alias("_known"))
        .withColumn("total", row_total())
        .withColumn("_has_point", F.col("_known") & F.col(date).isNotNull())
    )


def _published(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    return facts.where(~F.col("is_suppressed_bucket") & F.col(keys.hospital).isNotNull())


def hospital_points(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    rows = _published(facts, keys)
    return _points(rows, [keys.hospital, *COMBINATION], keys.date)


def national_points(facts: DataFrame, keys: Keys = NAMES) -> DataFrame:
    return _points(_published(facts, keys), COMBINATION, keys.date)


def _shown(points: DataFrame, minimum: int | None) -> DataFrame:
    """Points as they may be published: with a `minimum`, smaller cells are hidden."""
    return points if minimum is None else suppress_points(points, BUCKET_COLUMNS, "total", minimum)


def _dated(points: DataFrame, star: Star) -> DataFrame:
    """Points by date id -> by date, those without one kept."""
    return lookup_join(points, star.dim_date.select("date_id", "archive_date"), "date_id")


def _population(series: Column) -> Column:
    last = F.when(F.size(series) > 0, F.element_at(series, -1)["date"])
    return F.struct(last.alias("last_updated"), series.alias("series"))


def _list_types(notes: dict[str, str], limitations: str) -> Column:
    def one(list_type: str) -> Column:
        populations = F.struct(
            *[_population(F.col(f"_{list_type}_{pop}")).alias(pop) for pop in POPULATIONS]
        )
        return F.struct(
            F.lit(notes[list_type]).alias("methodology_note"),
            F.lit(limitations).alias("known_limitations"),
            populations.alias("populations"),
        ).alias(list_type)

    return F.struct(*[one(lt) for lt in LIST_TYPES])


def _hospital_documents(points: DataFrame, notes, limitations: str, source: str) -> DataFrame:
    name = F.col("hospital_name")
    return _collected(points, ["hospital_name"]).select(
        name,
        slug(name).alias("slug"),
        F.lit(source).alias("source"),
        _list_types(notes, limitations).alias("list_types"),
    )


def hospital_documents(
    facts: DataFrame,
    notes=METHODOLOGY_NOTES,
    limitations: str = SERIES_LIMITATIONS,
    source: str = SOURCE,
) -> DataFrame:
    """One document per hospital with any unsuppressed row."""
    return _hospital_documents(hospital_points(facts), notes, limitations, source)


def star_hospital_documents(
    star: Star,
    notes=METHODOLOGY_NOTES,
    limitations: str = SERIES_LIMITATIONS,
    source: str = SOURCE,
    minimum: int | None = None,
) -> DataFrame:
    """The same from a star schema: sums by id, then dates and names on the sums."""
    points = _dated(_shown(hospital_points(star.fact, IDS), minimum), star)
    names = star.dim_hospital.select("hospital_id", "hospital_name")
    return _hospital_documents(points.join(names, "hospital_id"), notes, limitations, source)


def _national_document(points: DataFrame, notes, limitations: str, source: str) -> DataFrame:
    noted = {lt: note + NATIONAL_NOTE for lt, note in notes.items()}
    return _collected(points, []).select(
        F.lit(NATIONAL_NAME).alias("hospital_name"),
        F.lit(NATIONAL_SLUG).alias("slug"),
        F.lit(source).alias("source"),
        _list_types(noted, limitations).alias("list_types"),
    )


def national_document(
    facts: DataFrame,
    notes=METHODOLOGY_NOTES,
    limitations: str = SERIES_LIMITATIONS,
    source: str = SOURCE,
) -> DataFrame:
    """One row: the document of all hospitals together, a point per combination and date."""
    return _national_document(national_points(facts), notes, limitations, source)


def star_national_document(
    star: Star,
    notes=METHODOLOGY_NOTES,
    limitations: str = SERIES_LIMITATIONS,
    source: str = SOURCE,
    minimum: int | None = None,
) -> DataFrame:
    points = _dated(_shown(national_points(star.fact, IDS), minimum), star)
    return _national_document(points, notes, limitations, source)


def specialty_document(
    facts: DataFrame, notes=SPECIALTY_NOTES, k: int = TOP_SPECIALTIES, source: str = SOURCE
) -> DataFrame:
    """One row: the k largest specialties of each list type and population."""
    return _specialty_document(latest_dates(facts), top_specialties(facts, k), notes, source)


def star_specialty_document(
    star: Star, notes=SPECIALTY_NOTES, k: int = TOP_SPECIALTIES, source: str = SOURCE, minimum: int | None = None
) -> DataFrame:
    latest = fixed(latest_dates(star.fact, IDS))
    top = _shown(star_top_specialties(star, k, latest.collect()), minimum)
    dated = named(latest.withColumnRenamed("last_updated", "date_id"), star)
    return _specialty_document(
        dated.withColumnRenamed("archive_date", "last_updated"), top, notes, source
    )


def _specialty_document(latest: DataFrame, top: DataFrame, notes, source: str) -> DataFrame:
    """From at most one latest date and k items per list type and population."""
    item = F.struct("rank", F.struct("specialty_name", *POINT).alias("item"))
    items = top.groupBy(*COMBINATION).agg(
        F.transform(F.array_sort(F.collect_list(item)), lambda e: e["item"]).alias("items"),
        F.max("n_tracked").alias("n_tracked"),
    )
    # A combination may have a latest date and yet no specialty left after suppression.
    rows = latest.join(F.broadcast(items), list(COMBINATION), "left")
    n_items = F.coalesce(F.size("items"), F.lit(0))
    entry = F.struct(
        iso_label(F.col("last_updated")).alias("last_updated"),
        F.when(n_items > 0, F.format_string(RANKING_NOTE, n_items, F.col("n_tracked")))
        .otherwise(F.lit(EMPTY_RANKING_NOTE))
        .alias("known_limitations"),
        "items",
    )
    by_combination = rows.agg(
        *[F.max_by(entry, F.when(_is_combination(lt, pop), 1)).alias(n) for lt, pop, n in _combinations()]
    )

    def population(name: str) -> Column:
        found = F.col(name)
        kind = "array<struct<specialty_name:string,total:bigint,under_6:bigint,six_to_12:bigint,twelve_plus:bigint>>"
        return F.struct(
            found["last_updated"].alias("last_updated"),
            F.coalesce(found["known_limitations"], F.lit(EMPTY_RANKING_NOTE)).alias("known_limitations"),
            F.coalesce(found["items"], F.array().cast(kind)).alias("items"),
        )

    def one(list_type: str) -> Column:
        populations = F.struct(*[population(f"_{list_type}_{p}").alias(p) for p in POPULATIONS])
        return F.struct(
            F.lit(notes[list_type]).alias("methodology_note"), populations.alias("populations")
        ).alias(list_type)

    return by_combination.select(
        F.lit(source).alias("source"), F.struct(*[one(lt) for lt in LIST_TYPES]).alias("list_types")
    )


def index(facts: DataFrame) -> DataFrame:
    """Slug and name of every published hospital, sorted by name."""
    name = F.col("hospital_name")
    names = _published(facts).select(name).distinct()
    return names.select(slug(name).alias("slug"), name).orderBy("hospital_name")


def star_index(star: Star) -> DataFrame:
    names = published_hospitals(star).select("hospital_name")
    return names.select(slug(F.col("hospital_name")).alias("slug"), "hospital_name")


def dense_grid(entities: DataFrame, series: DataFrame, key: str) -> DataFrame:
    """Every entity x list type x population with its points; missing ones get an empty array."""
    cells = F.array(
        *[F.struct(F.lit(lt).alias("list_type"), F.lit(pop).alias("adult_child")) for lt, pop, _ in _combinations()]
    )
    grid = entities.select(key, F.inline(cells))
    point = F.struct(iso_label(F.col("archive_date")).alias("date"), *POINT)
    arrays = series.groupBy(key, *COMBINATION).agg(
        F.array_sort(F.collect_list(point)).alias("series")
    )
    joined = grid.join(arrays, [key, *COMBINATION], "left")
    kind = dict(arrays.dtypes)["series"]
    return joined.withColumn("series", F.coalesce("series", F.array().cast(kind)))


# ---- reading documents -------------------------------------------------------------------------


def flatten_documents(documents: DataFrame) -> DataFrame:
    """Documents -> one row per point; empty series give none."""
    entries = [
        F.struct(
            F.lit(lt).alias("list_type"),
            F.lit(pop).alias("adult_child"),
            F.col(f"list_types.{lt}.populations.{pop}.series").alias("series"),
        )
        for lt, pop, _ in _combinations()
    ]
    series = documents.select("hospital_name", "slug", F.inline(F.array(*entries)))
    return series.select(
        "hospital_name", "slug", "list_type", "adult_child", F.inline("series")
    )


def flatten_ranking(document: DataFrame) -> DataFrame:
    """Specialty document -> one row per combination: date, note and items."""
    entries = [
        F.struct(
            F.lit(lt).alias("list_type"),
            F.lit(pop).alias("adult_child"),
            F.col(f"list_types.{lt}.populations.{pop}.last_updated").alias("last_updated"),
            F.col(f"list_types.{lt}.populations.{pop}.known_limitations").alias("known_limitations"),
            F.col(f"list_types.{lt}.populations.{pop}.items").alias("items"),
        )
        for lt, pop, _ in _combinations()
    ]
    return document.select(F.inline(F.array(*entries)))


def display_order(items: Column) -> Column:
    """Items smallest first, the order a horizontal bar chart draws them in."""
    return F.reverse(items)


def chosen_document(documents: DataFrame, wanted: str = DEFAULT_SLUG) -> DataFrame:
    """The document with that slug, or else the first by name."""
    return documents.orderBy(F.col("slug") != wanted, "hospital_name").limit(1)


def dashboard_slice(
    documents: DataFrame,
    list_type: str = "ipdc",
    adult_child: str = "Adult",
    wanted: str = DEFAULT_SLUG,
) -> DataFrame:
    """Points of one hospital, list type and population with their month label."""
    chosen = flatten_documents(chosen_document(documents, wanted))
    points = chosen.where(_is_combination(list_type, adult_child))
    return points.withColumn("label", month_label(F.to_date("date"))).orderBy("date")


def footer(
    national: DataFrame, specialties: DataFrame, list_type: str = "ipdc", adult_child: str = "Adult"
) -> DataFrame:
    """One row: source, last update and the notes shown under the charts of one combination."""
    here = f"list_types.{list_type}"
    trend = national.select(
        "source",
        F.coalesce(f"{here}.populations.{adult_child}.last_updated", F.lit("n/a")).alias("last_updated"),
        F.col(f"{here}.methodology_note").alias("trend_note"),
        F.col(f"{here}.known_limitations").alias("_limits"),
    )
    ranking = specialties.select(
        F.col(f"{here}.methodology_note").alias("specialty_note"),
        F.col(f"{here}.populations.{adult_child}.known_limitations").alias("_more"),
    )
    # One row each, by construction.
    both = trend.withColumn("_one", F.lit(1)).join(ranking.withColumn("_one", F.lit(1)), "_one")
    limits = F.concat_ws(" ", "_limits", F.when(F.col("_more") != "", F.col("_more")))
    return both.withColumn("known_limitations", limits).drop("_one", "_limits", "_more")


# ---- spans -----------------------------------------------------------------------------------


def spans(series: DataFrame, by) -> DataFrame:
    """First and last date of each series."""
    return series.groupBy(*by).agg(
        F.min("archive_date").alias("first_date"),
        F.max("archive_date").alias("last_updated"),
        F.count("*").alias("n_points"),
    )
