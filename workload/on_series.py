"""Trends, series, rankings, documents and findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktide.fixed_values import BUCKET_COLUMNS, BUCKETS, DATASET_LIST_TYPE, METADATA_REQUIRED
from stocktide.functions.dates import long_month_label, month_label
from stocktide.operators import analysis, governance, totals
from stocktide.plans import export, publish, queries
from stocktide.shared_dir import new_folder
from stocktide.sources import documents, warehouse_store
from stocktide.sources.published_documents import read_published

from . import stores
from .registry import query
from .sql import (
    COMBINATION,
    HOSPITAL_SERIES,
    IN_HOSPITAL,
    IN_SPECIALTY,
    NATIONAL_SERIES,
    iso,
    series,
    with_breakdown,
    with_unified,
)
from .tables import observations

DAY = iso("archive_date") + " AS archive_date"
BUCKETS_AND_TOTAL = "under_6, six_to_12, twelve_plus, total"
ONE_HOSPITAL = "Supplier#000000004"
ONE_SPECIALTY = "Brand#7"
SUM_ALL = "CAST(sum(count) AS BIGINT) AS total_waiting"

# ---- totals of all bands ----------------------------------------------------------------------


@query(
    with_unified(
        f"SELECT hospital_name, {COMBINATION}, {DAY}, {SUM_ALL} FROM unified"
        f" WHERE {IN_HOSPITAL} GROUP BY ALL"
    )
)
def hospital_total_trend(spark, sf_dir):
    return queries.hospital_total_trend(observations(spark, sf_dir))


@query(
    with_unified(
        f"SELECT {COMBINATION}, {DAY}, {SUM_ALL} FROM unified WHERE {IN_HOSPITAL} GROUP BY ALL"
    )
)
def national_total_trend(spark, sf_dir):
    return queries.national_total_trend(observations(spark, sf_dir))


_LATEST_TOTALS = with_unified(
    f"""SELECT list_type, {DAY}, {SUM_ALL} FROM unified
    WHERE {IN_HOSPITAL} AND adult_child = 'Adult'
      AND archive_date = (SELECT max(archive_date) FROM unified)
    GROUP BY list_type, archive_date"""
)


@query(_LATEST_TOTALS)
def latest_by_list_type(spark, sf_dir):
    return queries.latest_by_list_type(observations(spark, sf_dir))


# ---- totals by bucket -------------------------------------------------------------------------

_HOSPITAL_SERIES = with_unified(
    f"SELECT hospital_name, {COMBINATION}, {DAY}, {BUCKETS_AND_TOTAL} FROM ({HOSPITAL_SERIES})"
)
_NATIONAL_SERIES = with_unified(
    f"SELECT {COMBINATION}, {DAY}, {BUCKETS_AND_TOTAL} FROM ({NATIONAL_SERIES})"
)


@query(_HOSPITAL_SERIES)
def hospital_series(spark, sf_dir):
    return queries.hospital_series(observations(spark, sf_dir))


@query(_NATIONAL_SERIES)
def national_series(spark, sf_dir):
    return queries.national_series(observations(spark, sf_dir)).orderBy("archive_date")


@query(
    with_unified(
        f"SELECT {DAY}, under_6, six_to_12, twelve_plus FROM ({HOSPITAL_SERIES})"
        f" WHERE hospital_name = '{ONE_HOSPITAL}' AND adult_child = 'Adult' AND list_type = 'ipdc'"
    )
)
def band_breakdown(spark, sf_dir):
    return queries.band_breakdown(observations(spark, sf_dir), ONE_HOSPITAL)[0]


@query(
    with_unified(
        f"SELECT time_band, count(*) AS n_rows FROM unified WHERE {IN_HOSPITAL}"
        " AND bucket = 'Unknown' GROUP BY time_band"
    )
)
def unknown_bands(spark, sf_dir):
    return totals.unknown_bands(totals.eligible(observations(spark, sf_dir), "hospital_name"))


_SPECIALTY_TREND = series(
    f"specialty_name, {COMBINATION}",
    IN_SPECIALTY + " AND granularity IN ('hospital_specialty', 'national_specialty')",
)


@query(
    with_unified(
        f"SELECT specialty_name, {COMBINATION}, {DAY}, {BUCKETS_AND_TOTAL} FROM ({_SPECIALTY_TREND})"
    )
)
def specialty_trend(spark, sf_dir):
    return queries.specialty_trend(observations(spark, sf_dir))


@query(
    with_unified(
        f"SELECT {DAY}, {BUCKETS_AND_TOTAL} FROM ({_SPECIALTY_TREND}) WHERE"
        f" specialty_name = '{ONE_SPECIALTY}' AND adult_child = 'Adult' AND list_type = 'ipdc'"
    )
)
def one_specialty_trend(spark, sf_dir):
    facts = queries.restrict(
        observations(spark, sf_dir),
        specialty=ONE_SPECIALTY,
        adult_child="Adult",
        list_type="ipdc",
    )
    trend = queries.specialty_trend(facts).orderBy("archive_date")
    return trend.drop("specialty_name", "list_type", "adult_child")


@query(
    with_unified(
        f"""SELECT hospital_name, list_type, adult_child, {DAY},
    CAST(coalesce(sum(CASE WHEN bucket = 'Under 6 Months' THEN count END), 0) AS BIGINT) AS bucket_1,
    CAST(coalesce(sum(CASE WHEN bucket = '6-12 Months' THEN count END), 0) AS BIGINT) AS bucket_2,
    CAST(coalesce(sum(CASE WHEN bucket = '12+ Months' THEN count END), 0) AS BIGINT) AS bucket_3
  FROM unified WHERE {IN_HOSPITAL} AND bucket <> 'Unknown' GROUP BY ALL"""
    )
)
def long_to_wide(spark, sf_dir):
    rows = totals.eligible(observations(spark, sf_dir), "hospital_name")
    wide = totals.bucket_pivot(rows, ["hospital_name", "list_type", "adult_child", "archive_date"])
    return wide.withColumnsRenamed({b: f"bucket_{i}" for i, b in enumerate(BUCKETS, 1)})


@query(
    with_unified(
        f"SELECT hospital_name FROM unified WHERE {IN_HOSPITAL} GROUP BY 1 ORDER BY hospital_name"
    )
)
def hospital_names(spark, sf_dir):
    return queries.hospital_names(observations(spark, sf_dir))


@query(
    with_unified(
        f"SELECT {COMBINATION}, hospital_name, {iso('min(archive_date)')} AS first_date,"
        f" {iso('max(archive_date)')} AS last_updated, count(*) AS n_points"
        f" FROM ({HOSPITAL_SERIES}) GROUP BY ALL"
    )
)
def series_spans(spark, sf_dir):
    points = queries.hospital_series(observations(spark, sf_dir))
    return publish.spans(points, ["hospital_name", "list_type", "adult_child"])


# ---- rankings ---------------------------------------------------------------------------------

_RANKING = with_breakdown(
    f"""SELECT {COMBINATION}, {iso('last_updated')} AS last_updated, specialty_name,
    {BUCKETS_AND_TOTAL}, CAST(rank AS INTEGER) AS rank, n_tracked FROM ranked WHERE rank <= 15"""
)


@query(
    with_unified(
        f"""SELECT {COMBINATION}, {iso('max(archive_date)')} AS last_updated FROM unified
    WHERE granularity IN ('hospital_specialty', 'national_specialty') GROUP BY list_type, adult_child"""
    )
)
def latest_specialty_dates(spark, sf_dir):
    return queries.latest_dates(observations(spark, sf_dir))


@query(
    with_breakdown(
        f"SELECT {COMBINATION}, {iso('last_updated')} AS last_updated, specialty_name,"
        f" {BUCKETS_AND_TOTAL} FROM breakdown"
    )
)
def specialty_breakdown(spark, sf_dir):
    return queries.specialty_breakdown(observations(spark, sf_dir))


@query(_RANKING)
def specialty_top15(spark, sf_dir):
    return queries.top_specialties(observations(spark, sf_dir))


# ---- the same on the written star schema ----------------------------------------------------------


@query(_HOSPITAL_SERIES)
def star_hospital_series(spark, sf_dir):
    return queries.star_hospital_series(stores.star(spark, sf_dir))


@query(_NATIONAL_SERIES)
def star_national_series(spark, sf_dir):
    return queries.star_national_series(stores.star(spark, sf_dir))


@query(
    with_unified(
        f"SELECT {COMBINATION}, {DAY}, {SUM_ALL} FROM unified WHERE {IN_HOSPITAL} GROUP BY ALL"
    )
)
def star_national_total_trend(spark, sf_dir):
    return queries.star_national_total_trend(stores.star(spark, sf_dir))


@query(
    with_unified(
        f"SELECT specialty_name, {COMBINATION}, {DAY}, {BUCKETS_AND_TOTAL} FROM ({_SPECIALTY_TREND})"
    )
)
def star_specialty_trend(spark, sf_dir):
    return queries.star_specialty_trend(stores.star(spark, sf_dir))


_ONE = f"hospital_name = '{ONE_HOSPITAL}' AND adult_child = 'Adult' AND list_type = 'ipdc'"


@query(
    with_unified(
        f"SELECT {DAY}, {SUM_ALL} FROM unified WHERE {IN_HOSPITAL} AND {_ONE} GROUP BY archive_date"
    )
)
def star_one_hospital_trend(spark, sf_dir):
    """Total trend of one hospital, its id looked up before the facts are read."""
    one = queries.restrict_star(
        stores.star(spark, sf_dir), hospital=ONE_HOSPITAL, adult_child="Adult", list_type="ipdc"
    )
    trend = queries.star_hospital_total_trend(one).orderBy("archive_date")
    return trend.select("archive_date", "total_waiting")


@query(
    with_unified(f"SELECT {DAY}, under_6, six_to_12, twelve_plus FROM ({HOSPITAL_SERIES}) WHERE {_ONE}")
)
def star_band_breakdown(spark, sf_dir):
    one = queries.restrict_star(
        stores.star(spark, sf_dir), hospital=ONE_HOSPITAL, adult_child="Adult", list_type="ipdc"
    )
    series = queries.star_hospital_series(one).orderBy("archive_date")
    return series.select("archive_date", "under_6", "six_to_12", "twelve_plus")


@query(_RANKING)
def star_specialty_top15(spark, sf_dir):
    return queries.star_top_specialties(stores.star(spark, sf_dir))


@query(_LATEST_TOTALS)
def star_latest_totals(spark, sf_dir):
    return queries.latest_totals(stores.star(spark, sf_dir))


@query(
    with_unified(
        f"""SELECT row_number() OVER (ORDER BY hospital_name) AS hospital_id, hospital_name
    FROM (SELECT DISTINCT hospital_name FROM unified WHERE {IN_HOSPITAL})"""
    )
)
def star_published_hospitals(spark, sf_dir):
    found = queries.published_hospitals(stores.star(spark, sf_dir))
    return found.select("hospital_id", "hospital_name")


@query(
    with_unified(
        f"""SELECT hospital_name, year, waiting, CAST(rank() OVER (PARTITION BY year ORDER BY waiting DESC) AS INTEGER) AS place
  FROM (SELECT hospital_name, CAST(year(archive_date) AS INTEGER) AS year, CAST(max(total) AS BIGINT) AS waiting FROM (
    SELECT hospital_name, archive_date, sum(count) AS total FROM unified
    WHERE {IN_HOSPITAL} AND adult_child = 'Child' AND list_type = 'op'
      AND granularity IN ('hospital', 'hospital_specialty') GROUP BY ALL) GROUP BY ALL)
  QUALIFY place <= 3"""
    )
)
def sql_views(spark, sf_dir):
    """The star schema as SQL views: each year's three hospitals with the longest queue of any snapshot."""
    warehouse_store.register_star(stores.star(spark, sf_dir))
    return spark.sql(
        """WITH queue AS (
          SELECT hospital_id, date_id, sum(count) AS waiting FROM fact_waiting_list
          WHERE hospital_id IS NOT NULL AND NOT is_suppressed_bucket
            AND list_type = :list_type AND adult_child = :population
          GROUP BY ALL
        ), longest AS (
          SELECT hospital_id, year(archive_date) AS year, max(waiting) AS waiting
          FROM queue NATURAL JOIN dim_date GROUP BY ALL
        )
        SELECT hospital_name, year, waiting, place
        FROM (SELECT *, rank() OVER (PARTITION BY year ORDER BY waiting DESC) AS place FROM longest)
        NATURAL JOIN dim_hospital WHERE place <= :places""",
        args={"population": "Child", "list_type": "op", "places": 3},
    )


# ---- documents -------------------------------------------------------------------------------

_POINTS = f"{COMBINATION}, {iso('archive_date')} AS date, {BUCKETS_AND_TOTAL}"
_SLUG = "replace(replace(lower(hospital_name), ' ', '-'), '''', '')"


@query(
    with_unified(f"SELECT hospital_name, {_SLUG} AS slug, {_POINTS} FROM ({HOSPITAL_SERIES})")
)
def hospital_documents(spark, sf_dir):
    return publish.flatten_documents(publish.hospital_documents(observations(spark, sf_dir)))


@query(
    with_unified(
        f"SELECT 'National' AS hospital_name, 'national' AS slug, {_POINTS} FROM ({NATIONAL_SERIES})"
    )
)
def national_document(spark, sf_dir):
    return publish.flatten_documents(publish.national_document(observations(spark, sf_dir)))


@query(
    with_breakdown(
        f"""SELECT {COMBINATION}, {iso('last_updated')} AS last_updated,
    'Showing the ' || least(n_tracked, 15) || ' largest specialties by current waiting list volume, out of '
      || n_tracked || ' specialties tracked for this combination.' AS known_limitations,
    CAST(rank AS INTEGER) AS position, specialty_name, {BUCKETS_AND_TOTAL} FROM ranked WHERE rank <= 15"""
    )
)
def specialty_document(spark, sf_dir):
    document = publish.specialty_document(observations(spark, sf_dir))
    flat = publish.flatten_ranking(document)
    items = flat.select(
        "list_type", "adult_child", "last_updated", "known_limitations", F.posexplode("items")
    )
    return items.select(
        "list_type",
        "adult_child",
        "last_updated",
        "known_limitations",
        (F.col("pos") + 1).alias("position"),
        "col.*",
    )


@query(
    with_breakdown(
        f"""SELECT {COMBINATION}, CAST(row_number() OVER (PARTITION BY list_type, adult_child
      ORDER BY rank DESC) AS INTEGER) AS position, specialty_name, total FROM ranked WHERE rank <= 15"""
    )
)
def display_order(spark, sf_dir):
    document = publish.specialty_document(observations(spark, sf_dir))
    shown = publish.flatten_ranking(document).select(
        "list_type", "adult_child", F.posexplode(publish.display_order(F.col("items")))
    )
    return shown.select(
        "list_type",
        "adult_child",
        (F.col("pos") + 1).alias("position"),
        "col.specialty_name",
        "col.total",
    )


@query(
    with_unified(
        f"""SELECT DISTINCT {_SLUG} AS slug, hospital_name FROM unified WHERE {IN_HOSPITAL}"""
    )
)
def hospital_index(spark, sf_dir):
    folder = new_folder(spark, "index")
    documents.write_lines(publish.index(observations(spark, sf_dir)), folder)
    return documents.read_documents(spark, folder, "slug string, hospital_name string")


_EXPORTED = f"""SELECT 'hospitals' AS part, {COMBINATION}, hospital_name AS name, {iso('archive_date')} AS date,
    total FROM ({HOSPITAL_SERIES})
  UNION ALL SELECT 'national', {COMBINATION}, 'National', {iso('archive_date')}, total FROM ({NATIONAL_SERIES})
  UNION ALL SELECT 'national_by_specialty', {COMBINATION}, specialty_name, {iso('last_updated')}, total
    FROM ranked WHERE rank <= 15
  UNION ALL SELECT DISTINCT 'index', NULL, NULL, hospital_name, {_SLUG}, NULL FROM unified WHERE {IN_HOSPITAL}"""


@query(with_breakdown(_EXPORTED))
def document_readback(spark, sf_dir):
    """Everything exported from the written warehouse as JSON, read again."""
    warehouse = stores.star(spark, sf_dir)
    folder = new_folder(spark, "site")
    export.export(warehouse, folder)
    hospital_schema = publish.star_hospital_documents(warehouse).schema

    def read(part, schema):
        return documents.read_documents(spark, f"{folder}/{part}", schema)

    def points(part):
        flat = publish.flatten_documents(read(part, hospital_schema))
        return flat.select(
            F.lit(part).alias("part"), "list_type", "adult_child",
            F.col("hospital_name").alias("name"), "date", "total",
        )

    ranking = read(export.BY_SPECIALTY, publish.star_specialty_document(warehouse).schema)
    items = publish.flatten_ranking(ranking).select(
        "list_type", "adult_child", "last_updated", F.inline("items")
    )
    ranked = items.select(
        F.lit(export.BY_SPECIALTY).alias("part"), "list_type", "adult_child",
        F.col("specialty_name").alias("name"), F.col("last_updated").alias("date"), "total",
    )
    none = F.lit(None).cast("string")
    names = read(export.INDEX, "slug string, hospital_name string").select(
        F.lit(export.INDEX).alias("part"), none.alias("list_type"), none.alias("adult_child"),
        F.col("hospital_name").alias("name"), F.col("slug").alias("date"),
        F.lit(None).cast("bigint").alias("total"),
    )
    found = points(export.HOSPITALS).unionByName(points(export.NATIONAL))
    return found.unionByName(ranked).unionByName(names)


_SMALL = 40
_HIDDEN = ", ".join(f"CASE WHEN {c} NOT BETWEEN 1 AND {_SMALL - 1} THEN {c} END AS {c}" for c in BUCKET_COLUMNS)
_ANY_SMALL = " OR ".join(f"{c} BETWEEN 1 AND {_SMALL - 1}" for c in BUCKET_COLUMNS)


@query(
    with_unified(
        f"""SELECT hospital_name, {COMBINATION}, {iso('archive_date')} AS date, {_HIDDEN},
    CASE WHEN NOT ({_ANY_SMALL}) THEN total END AS total,
    (SELECT count(DISTINCT hospital_name) FROM unified WHERE {IN_HOSPITAL}) AS n_written, CAST(0 AS BIGINT) AS n_again
  FROM ({HOSPITAL_SERIES}) WHERE list_type = 'ipdc'"""
    )
)
def export_changed(spark, sf_dir):
    """Published by content: the hospitals' documents that a first export writes, what a second one writes without new
    data, and the points that can be read once one dataset lacks its record and small cells are hidden."""
    warehouse, folder = stores.star(spark, sf_dir), new_folder(spark, "published")
    written = export.export_changed(warehouse, folder)[export.HOSPITALS]
    again = sum(export.export_changed(warehouse, folder).values())
    ids = F.array(*[F.lit(export.dataset_id(name)) for name in DATASET_LIST_TYPE])
    datasets = spark.range(1).select(F.explode(ids).alias("dataset_id"))
    fields = [F.when(F.col("dataset_id") != "op-hospital", "x").alias(name) for name in METADATA_REQUIRED]
    records = datasets.select("dataset_id", F.to_json(F.struct(*fields)).alias("record"))
    allowed, _ = governance.publishable(datasets, governance.check_metadata(records), datasets)
    export.export_changed(warehouse, folder, allowed, minimum=_SMALL)
    schema = publish.star_hospital_documents(warehouse).schema
    points = publish.flatten_documents(read_published(spark, folder, export.HOSPITALS, schema))
    return points.drop("slug").withColumns({"n_written": F.lit(written).cast("bigint"), "n_again": F.lit(again).cast("bigint")})


@query(
    with_unified(
        f"""SELECT hospital_name, list_type, adult_child, CAST(count(archive_date) AS INTEGER) AS n_points,
    {iso('max(archive_date)')} AS last_updated
  FROM (SELECT DISTINCT hospital_name FROM unified WHERE {IN_HOSPITAL})
  CROSS JOIN (VALUES ('ipdc'), ('op')) AS l(list_type)
  CROSS JOIN (VALUES ('Adult'), ('Child')) AS p(adult_child)
  LEFT JOIN ({HOSPITAL_SERIES}) USING (hospital_name, list_type, adult_child) GROUP BY ALL"""
    )
)
def dense_grid(spark, sf_dir):
    facts = observations(spark, sf_dir)
    points = queries.hospital_series(facts)
    grid = publish.dense_grid(queries.hospital_names(facts), points, "hospital_name")
    return grid.select(
        "hospital_name",
        "list_type",
        "adult_child",
        F.size("series").alias("n_points"),
        F.array_max("series.date").alias("last_updated"),
    )


@query(
    with_unified(
        f"""SELECT hospital_name, {_SLUG} AS slug, {_POINTS},
    strftime(archive_date, '%b %Y') AS label FROM ({HOSPITAL_SERIES})
  WHERE hospital_name = (SELECT min(hospital_name) FROM unified WHERE {IN_HOSPITAL})
    AND list_type = 'ipdc' AND adult_child = 'Adult'"""
    )
)
def dashboard_slice(spark, sf_dir):
    """The default hospital is not in this data, so the first by name is shown."""
    made = publish.hospital_documents(observations(spark, sf_dir))
    return publish.dashboard_slice(made)


@query(
    with_breakdown(
        f"""SELECT (SELECT {iso('max(archive_date)')} FROM ({NATIONAL_SERIES})
     WHERE list_type = 'op' AND adult_child = 'Child') AS last_updated,
    (SELECT ' Showing the ' || least(max(n_tracked), 15) || ' largest' FROM ranked
     WHERE list_type = 'op' AND adult_child = 'Child') AS note_part"""
    )
)
def dashboard_footer(spark, sf_dir):
    facts = observations(spark, sf_dir)
    line = publish.footer(
        publish.national_document(facts), publish.specialty_document(facts), "op", "Child"
    )
    return line.select(
        "last_updated",
        F.regexp_extract("known_limitations", "( Showing the [0-9]+ largest)", 1).alias("note_part"),
    )


@query(
    with_unified(
        """SELECT DISTINCT strftime(archive_date, '%Y-%m-%d') AS iso,
    strftime(archive_date, '%b %Y') AS month_label, strftime(archive_date, '%B %Y') AS long_label,
    CAST(year(archive_date) AS INTEGER) AS year, CAST(month(archive_date) AS INTEGER) AS month
  FROM unified"""
    )
)
def date_labels(spark, sf_dir):
    days = observations(spark, sf_dir).select("archive_date").distinct()
    day = F.col("archive_date")
    return days.select(
        day.alias("iso"),
        month_label(day).alias("month_label"),
        long_month_label(day).alias("long_label"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
    )


# ---- findings -------------------------------------------------------------------------------

_ENTITY = ["hospital_name", "list_type", "adult_child"]
_ENTITIES = ", ".join(_ENTITY)


@query(
    with_unified(
        f"""SELECT {_ENTITIES}, {iso('latest_date')} AS latest_date, latest_value, previous_peak,
    {iso('previous_peak_date')} AS previous_peak_date,
    coalesce(latest_value > previous_peak, true) AS is_record
  FROM (
    SELECT {_ENTITIES}, max(archive_date) AS latest_date,
      max(CASE WHEN r = 1 THEN total END) AS latest_value,
      max(CASE WHEN r > 1 THEN total END) AS previous_peak,
      arg_max(CASE WHEN r > 1 THEN archive_date END,
        CASE WHEN r > 1 THEN total * 1000000 - date_diff('day', DATE '1970-01-01', archive_date) END)
        AS previous_peak_date
    FROM (SELECT *, row_number() OVER (PARTITION BY {_ENTITIES} ORDER BY archive_date DESC) AS r
          FROM ({HOSPITAL_SERIES})) GROUP BY {_ENTITIES})"""
    )
)
def record_high(spark, sf_dir):
    return analysis.record_high(queries.hospital_series(observations(spark, sf_dir)), _ENTITY)


@query(
    with_unified(
        f"""SELECT {_ENTITIES}, {DAY}, total, kind FROM (
    SELECT *, CASE WHEN total > b AND total > a THEN 'peak' WHEN total < b AND total < a THEN 'trough' END
      AS kind
    FROM (SELECT *, lag(total) OVER w AS b, lead(total) OVER w AS a FROM ({HOSPITAL_SERIES})
          WINDOW w AS (PARTITION BY {_ENTITIES} ORDER BY archive_date)))
  WHERE kind IS NOT NULL"""
    )
)
def turning_points(spark, sf_dir):
    return analysis.turning_points(queries.hospital_series(observations(spark, sf_dir)), _ENTITY)


@query(
    with_unified(
        f"""SELECT *, CASE WHEN first_value > 0 THEN last_value * 100 // first_value END AS percent_of_first
  FROM (SELECT {_ENTITIES}, arg_min(total, archive_date) AS first_value,
    arg_max(total, archive_date) AS last_value, min(total) AS lowest, max(total) AS highest
    FROM ({HOSPITAL_SERIES}) GROUP BY {_ENTITIES})"""
    )
)
def growth_multiple(spark, sf_dir):
    return analysis.growth(queries.hospital_series(observations(spark, sf_dir)), _ENTITY)


@query(
    with_unified(
        f"""SELECT {_ENTITIES}, {iso('min(archive_date)')} AS first_date,
    {iso('max(archive_date)')} AS last_date, count(*) AS n_dates
  FROM ({HOSPITAL_SERIES}) WHERE twelve_plus > under_6 GROUP BY {_ENTITIES}"""
    )
)
def inversions(spark, sf_dir):
    return analysis.inversions(queries.hospital_series(observations(spark, sf_dir)), _ENTITY)


@query(
    with_unified(
        f"""SELECT *, CASE WHEN ipdc_total > 0 THEN op_total * 100 // ipdc_total END AS op_percent_of_ipdc
  FROM (SELECT adult_child, {DAY}, CAST(sum(CASE WHEN list_type = 'ipdc' THEN total END) AS BIGINT) AS ipdc_total,
    CAST(sum(CASE WHEN list_type = 'op' THEN total END) AS BIGINT) AS op_total
    FROM ({NATIONAL_SERIES}) GROUP BY adult_child, archive_date)
  WHERE ipdc_total IS NOT NULL AND op_total IS NOT NULL"""
    )
)
def op_ipdc_ratio(spark, sf_dir):
    national = queries.national_series(observations(spark, sf_dir))
    return analysis.list_type_ratio(national, ["adult_child", "archive_date"])
