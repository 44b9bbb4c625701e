"""Cells, headers, names, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktide.fixed_values import LONG, LONG_EARLY, WIDE, WIDE_SPECIALTY
from stocktide.functions.bands import classify_band
from stocktide.functions.cells import grouped_digits, parse_count, parse_number, present
from stocktide.functions.dates import parse_archive_date, parse_day_first
from stocktide.functions.names import slug, specialty_slug
from stocktide.operators import clean, quality, reshape
from stocktide.plans import queries
from stocktide.plans.harmonise import NORMALISERS, unify

from . import stores, tables
from .on_sources import _DATE_TEXT, _WIDE_SUMS
from .registry import query
from .sql import BUCKET, iso, with_base, with_unified


@query(
    with_base(
        f"""SELECT strftime(day, '%Y-%m-%d') AS archive_date, adult_child, hospital_name, list_type || '_hospital' AS dataset,
    CAST(yr AS VARCHAR) AS year_key, b1 AS months_0_6, b2 AS months_6_12, b3 AS months_12_18,
    b4 AS months_18_plus, CASE WHEN t % 7 = 0 THEN t + 1 ELSE t END AS total
  FROM (SELECT list_type, yr, day, adult_child, published_name AS hospital_name, {_WIDE_SUMS}
    FROM base WHERE yr >= 2000 GROUP BY ALL)"""
    )
)
def wide_table(spark, sf_dir):
    """A wide publication on its own: headers in snake case, counts and date parsed."""
    return clean.wide_table(tables.published_wide(stores.lines(spark, sf_dir)))


@query(
    with_base(
        """SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key, specialty_hipe,
    specialty_name, count(*) AS n_rows FROM (
    SELECT list_type, yr, day, hospital_group, hospital_hipe, published_name, specialty_hipe,
      specialty_name, case_type, adult_child, time_band FROM base WHERE yr < 2000 GROUP BY ALL)
  GROUP BY ALL"""
    )
)
def header_variants(spark, sf_dir):
    """Two spellings of a header in one table feed one column."""
    frames = [tables.published_long(stores.lines(spark, sf_dir)), tables.published_long_early(stores.lines(spark, sf_dir))]
    merged = [clean.merge_headers(f, keep=["dataset", "year_key"]) for f in frames]
    rows = reshape.union_all(merged)
    return rows.groupBy("dataset", "year_key", "specialty_hipe", "specialty_name").agg(
        F.count("*").alias("n_rows")
    )


_NUMBER_TEXT = """CASE o_orderkey % 8
    WHEN 0 THEN format('{:,}', o_custkey * 1000 + 7) WHEN 1 THEN ' ' || o_custkey || ' '
    WHEN 2 THEN '<5' WHEN 3 THEN o_custkey || 'd' WHEN 4 THEN 'nan' WHEN 5 THEN o_custkey || '.0'
    WHEN 6 THEN '-' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END"""


def _number_text():
    key, customer = F.col("o_orderkey") % 8, F.col("o_custkey")
    text = customer.cast("string")
    return (
        F.when(key == 0, grouped_digits(customer * 1000 + 7))
        .when(key == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(key == 2, "<5")
        .when(key == 3, F.concat(text, F.lit("d")))
        .when(key == 4, "nan")
        .when(key == 5, F.concat(text, F.lit(".0")))
        .when(key == 6, F.concat(F.lit("-"), text))
        .otherwise(text)
    )


@query(
    f"""SELECT o_orderkey, {_NUMBER_TEXT} AS cell, CASE o_orderkey % 8
    WHEN 0 THEN o_custkey * 1000 + 7 WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 4 THEN NULL
    WHEN 6 THEN -o_custkey ELSE o_custkey END AS parsed FROM orders"""
)
def parse_counts(spark, sf_dir):
    cells = tables.table(spark, sf_dir, "orders").select("o_orderkey", _number_text().alias("cell"))
    return cells.withColumn("parsed", parse_count(F.col("cell")))


def _mixed_columns(spark, sf_dir):
    key = F.col("o_orderkey")
    text = key.cast("string")
    return tables.table(spark, sf_dir, "orders").select(
        F.when(key % 10 != 0, text).otherwise("x").alias("nine_in_ten"),
        F.when(key % 20 != 0, grouped_digits(key)).otherwise("x").alias("most"),
        F.when(key % 2 == 0, text).alias("sparse"),
        F.when(key % 2 == 0, grouped_digits(key + 1000)).alias("sparse_grouped"),
        F.concat(text, F.lit(".5")).alias("halves"),
        "o_orderpriority",
    )


@query(
    """SELECT column_name, n_rows, n_present, n_numbers, is_numeric, cells_lost, all_whole FROM (
    SELECT count(*) AS n_rows, count(*) FILTER (o_orderkey % 10 <> 0) AS n9,
      count(*) FILTER (o_orderkey % 20 <> 0) AS n19, count(*) FILTER (o_orderkey % 2 = 0) AS n2
    FROM orders) AS c CROSS JOIN LATERAL (VALUES
    ('nine_in_ten', n_rows, n9, n9 / n_rows > 0.9, CASE WHEN n9 / n_rows > 0.9 THEN n_rows - n9 ELSE 0 END, true),
    ('most', n_rows, n19, n19 / n_rows > 0.9, CASE WHEN n19 / n_rows > 0.9 THEN n_rows - n19 ELSE 0 END, true),
    ('sparse', n2, n2, true, 0, true), ('sparse_grouped', n2, n2, false, 0, true),
    ('halves', n_rows, n_rows, true, 0, false), ('o_orderpriority', n_rows, 0, false, 0, true))
    AS v(column_name, n_present, n_numbers, is_numeric, cells_lost, all_whole)"""
)
def numeric_detect(spark, sf_dir):
    """A column at exactly nine in ten stays text; one just above is numeric and loses the rest."""
    return clean.numeric_report(_mixed_columns(spark, sf_dir))


@query(
    """SELECT CAST(sum(CASE WHEN o_orderkey % 20 <> 0 THEN o_orderkey END) AS BIGINT) AS most,
    CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey END) AS BIGINT) AS sparse,
    CAST(2 * sum(o_orderkey) + count(*) AS BIGINT) AS halves_doubled,
    count(*) FILTER (o_orderkey % 10 <> 0 AND length(CAST(o_orderkey AS VARCHAR)) > 0) AS nine_in_ten_digits,
    count(DISTINCT o_orderpriority) AS priorities FROM orders"""
)
def numeric_convert(spark, sf_dir):
    rows = clean.auto_numeric(_mixed_columns(spark, sf_dir))
    return rows.agg(
        F.sum("most").alias("most"),
        F.sum("sparse").alias("sparse"),
        F.sum((2 * F.col("halves")).cast("bigint")).alias("halves_doubled"),
        F.count_if(F.col("nine_in_ten").rlike("^[0-9]+$")).alias("nine_in_ten_digits"),
        F.count_distinct("o_orderpriority").alias("priorities"),
    )


_DATE_CELL = """CASE o_orderkey % 7
    WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN 2 THEN day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate)
    WHEN 3 THEN '31/02/' || year(o_orderdate) WHEN 4 THEN strftime(o_orderdate, '%d/%m/%Y') || ' '
    WHEN 5 THEN strftime(o_orderdate, '%d/%m/%y') END"""


@query(
    f"""SELECT o_orderkey, {_DATE_CELL} AS cell,
    CASE WHEN o_orderkey % 7 IN (0, 2) THEN strftime(o_orderdate, '%Y-%m-%d') END AS day_first,
    CASE WHEN o_orderkey % 7 IN (0, 1, 2) THEN strftime(o_orderdate, '%Y-%m-%d') END AS either FROM orders"""
)
def parse_dates(spark, sf_dir):
    kind, day = F.col("o_orderkey") % 7, F.col("o_orderdate")
    cell = (
        F.when(kind == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(kind == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 2, F.date_format(day, "d/M/yyyy"))
        .when(kind == 3, F.concat(F.lit("31/02/"), F.year(day).cast("string")))
        .when(kind == 4, F.date_format(day, "dd/MM/yyyy "))
        .when(kind == 5, F.date_format(day, "dd/MM/yy"))
    )
    cells = tables.table(spark, sf_dir, "orders").select("o_orderkey", cell.alias("cell"))
    return cells.withColumns(
        {
            "day_first": parse_day_first(F.col("cell")),
            "either": parse_archive_date(F.col("cell")),
        }
    )


@query(
    """SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING') THEN NULL WHEN c_custkey % 5 = 0 THEN NULL
    ELSE c_mktsegment END AS segment FROM customer"""
)
def null_tokens(spark, sf_dir):
    """Cells that hold a marker for a missing value."""
    markers = F.array(*[F.lit(t) for t in ("", "N/A", "null", "-nan", "#NA")])
    which = F.get(markers, (F.col("c_custkey") % 5).cast("int"))
    cell = (
        F.when(F.col("c_mktsegment") == "BUILDING", which)
        .when(F.col("c_custkey") % 5 == 0, "NaN")
        .otherwise(F.col("c_mktsegment"))
    )
    return tables.table(spark, sf_dir, "customer").select("c_custkey", present(cell).alias("segment"))


@query(
    """SELECT s_name AS hospital_name, CAST(NULL AS VARCHAR) AS specialty_name, CAST(s_nationkey AS BIGINT) AS count,
    CAST(NULL AS VARCHAR) AS case_type, 'hospital' AS granularity, 14 AS n_columns FROM supplier"""
)
def conform_columns(spark, sf_dir):
    """Columns that are missing become typed nulls, others are dropped, constants are tagged."""
    rows = tables.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("hospital_name"), F.col("s_nationkey").alias("count"), "s_acctbal"
    )
    made = clean.conform(rows.withColumn("granularity", F.lit("hospital")))
    wanted = ["hospital_name", "specialty_name", "count", "case_type", "granularity"]
    return made.select(*wanted, F.lit(len(made.columns) + 1).alias("n_columns"))


@query(
    """SELECT s_suppkey, CASE WHEN s_nationkey BETWEEN 5 AND 7 AND s_suppkey > 0
    THEN 'Supplier#' || lpad(CAST(s_suppkey - 1 AS VARCHAR), 9, '0') ELSE s_name END AS hospital_name
  FROM supplier"""
)
def canonical_names(spark, sf_dir):
    names = tables.table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_name").alias("hospital_name")
    )
    return clean.canonical_names(names, tables.aliases(spark, sf_dir))


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 4 = 0 THEN 'University Hospital Kerry'
    WHEN s_suppkey % 4 = 1 THEN 'Cork University Maternity Hospital'
    WHEN s_suppkey % 4 = 2 THEN ' Connolly Hospital' END AS hospital_name FROM supplier"""
)
def fixed_aliases(spark, sf_dir):
    """The fixed table of earlier names: exact, so a leading space keeps a name as it is."""
    name = (
        F.when(F.col("s_suppkey") % 4 == 0, "Kerry General Hospital")
        .when(F.col("s_suppkey") % 4 == 1, "Cork University Maternity Hospital ")
        .when(F.col("s_suppkey") % 4 == 2, " Connolly Hospital")
    )
    return clean.canonical_names(
        tables.table(spark, sf_dir, "supplier").select("s_suppkey", name.alias("hospital_name"))
    )


@query(
    with_unified(
        """SELECT hospital_name, specialty_name, is_suppressed_bucket, count(*) AS n_rows FROM unified
  GROUP BY ALL"""
    )
)
def suppression_flag(spark, sf_dir):
    rows = clean.flag_suppressed(tables.unified(spark, sf_dir).drop("is_suppressed_bucket"))
    return rows.groupBy("hospital_name", "specialty_name", "is_suppressed_bucket").agg(
        F.count("*").alias("n_rows")
    )


@query(
    with_unified(
        """SELECT list_type, granularity, count(*) FILTER (is_suppressed_bucket) AS n_suppressed,
    count(*) AS n_rows FROM unified GROUP BY ALL"""
    )
)
def suppressed_count(spark, sf_dir):
    return quality.suppressed_count(tables.unified(spark, sf_dir), ["list_type", "granularity"])


_BAND_LABEL = """CASE p_partkey % 6 WHEN 0 THEN p_size || '-99 Months' WHEN 1 THEN '  ' || p_size || ' Months +'
    WHEN 2 THEN '> ' || p_size WHEN 3 THEN 'Over a year' WHEN 4 THEN '' END"""


@query(
    f"""SELECT time_band, {BUCKET} AS bucket, count(*) AS n_rows
  FROM (SELECT {_BAND_LABEL} AS time_band FROM part) GROUP BY ALL"""
)
def classify_bands(spark, sf_dir):
    size, kind = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    label = (
        F.when(kind == 0, F.concat(size, F.lit("-99 Months")))
        .when(kind == 1, F.concat(F.lit("  "), size, F.lit(" Months +")))
        .when(kind == 2, F.concat(F.lit("> "), size))
        .when(kind == 3, "Over a year")
        .when(kind == 4, "")
    )
    labels = tables.table(spark, sf_dir, "part").select(label.alias("time_band"))
    counted = labels.groupBy("time_band").agg(F.count("*").alias("n_rows"))
    return counted.withColumn("bucket", classify_band(F.col("time_band")))


@query(
    """SELECT p_partkey, replace(replace(lower(name), ' ', '-'), '''', '') AS hospital_slug,
    replace(lower(name), ' ', '-') AS specialty_slug
  FROM (SELECT p_partkey, 'St. ' || p_name || '''s Hospital (' || p_type || ')' AS name FROM part)"""
)
def slugs(spark, sf_dir):
    name = F.concat(
        F.lit("St. "), "p_name", F.lit("'s Hospital ("), "p_type", F.lit(")")
    )
    return tables.table(spark, sf_dir, "part").select(
        "p_partkey", slug(name).alias("hospital_slug"), specialty_slug(name).alias("specialty_slug")
    )


@query(
    with_unified(
        f"""SELECT {iso('archive_date')} AS archive_date, time_band, CAST(sum(count) AS BIGINT) AS count FROM unified
  WHERE hospital_name = 'Supplier#000000004' AND specialty_name = 'Brand#7' AND adult_child = 'Child'
    AND list_type = 'op' AND granularity IN ('hospital', 'hospital_specialty') AND NOT is_suppressed_bucket
  GROUP BY ALL"""
    )
)
def restricted_facts(spark, sf_dir):
    facts = queries.restrict(
        tables.observations(spark, sf_dir),
        hospital="Supplier#000000004",
        specialty="Brand#7",
        adult_child="Child",
        list_type="op",
        granularities=("hospital", "hospital_specialty"),
    )
    rows = facts.where("not is_suppressed_bucket")
    return rows.groupBy("archive_date", "time_band").agg(F.sum("count").alias("count"))


# ---- reshaping ------------------------------------------------------------------------------

_LONG_KEYS = "archive_date, adult_child, time_band, granularity, list_type, source_year_key"


@query(
    with_base(
        f"""SELECT {_DATE_TEXT} AS archive_date, adult_child, published_name AS hospital_name, b AS time_band,
    CAST(sum(CASE WHEN time_band = b THEN n END) AS BIGINT) AS count, 'hospital' AS granularity, list_type,
    CAST(yr AS VARCHAR) AS source_year_key
  FROM base CROSS JOIN (VALUES ('0-6 Months'), ('6-12 Months'), ('12-18 Months'), ('18 Months +')) AS v(b)
  WHERE yr >= 2000 GROUP BY ALL"""
    )
)
def wide_to_long(spark, sf_dir):
    long = reshape.wide_to_long(tables.published_wide(stores.lines(spark, sf_dir)))
    return long.select("hospital_name", "count", *_LONG_KEYS.split(", "))


@query(
    with_base(
        f"""SELECT archive_date, adult_child, specialty_name, time_band,
    CASE WHEN list_type = 'op' THEN coalesce(total, 0) ELSE total END AS count,
    'national_specialty' AS granularity, list_type, source_year_key
  FROM (SELECT {_DATE_TEXT} AS archive_date, adult_child, specialty_name, b AS time_band, list_type,
      CAST(yr AS VARCHAR) AS source_year_key,
      CAST(sum(CASE WHEN time_band = b THEN n END) AS BIGINT) AS total
    FROM base CROSS JOIN (VALUES ('0-6 Months'), ('6-12 Months'), ('12-18 Months'), ('18 Months +')) AS v(b)
    WHERE yr >= 2000 GROUP BY ALL)"""
    )
)
def wide_specialty_to_long(spark, sf_dir):
    """Outpatient rows come in two unlabelled parts, which are added up."""
    long = reshape.wide_specialty_to_long(tables.published_wide_specialty(stores.lines(spark, sf_dir)))
    return long.select("specialty_name", "count", *_LONG_KEYS.split(", "))


@query(
    with_base(
        f"""SELECT {_DATE_TEXT} AS archive_date, adult_child, time_band, 'hospital_specialty' AS granularity,
    list_type, CAST(yr AS VARCHAR) AS source_year_key, hospital_group, hospital_hipe,
    published_name AS hospital_name, specialty_hipe, specialty_name, case_type,
    CAST(sum(n) AS BIGINT) AS count FROM base WHERE yr < 2000 GROUP BY ALL"""
    )
)
def long_rows(spark, sf_dir):
    """Files of both long families, their headers merged."""
    frames = [tables.published_long(stores.lines(spark, sf_dir)), tables.published_long_early(stores.lines(spark, sf_dir))]
    return reshape.union_all([reshape.long_rows(frame) for frame in frames])


_FAMILY_OF_YEAR = "CASE WHEN yr >= 2000 THEN 'wide' WHEN yr >= 1997 THEN 'long' ELSE 'long_early' END"


@query(
    with_base(
        f"""SELECT family, CAST(sum(k) AS BIGINT) AS n_rows, CAST(sum(t) AS BIGINT) AS total FROM (
    SELECT {_FAMILY_OF_YEAR} AS family, CASE WHEN yr >= 2000 THEN 4 ELSE 1 END AS k, sum(n) AS t FROM base
    GROUP BY yr, list_type, day, adult_child, published_name,
      CASE WHEN yr < 2000 THEN (hospital_group, hospital_hipe, specialty_hipe, specialty_name, case_type, time_band) END
    UNION ALL SELECT 'wide_specialty', 4, sum(n) FROM base WHERE yr >= 2000
    GROUP BY list_type, day, adult_child, specialty_name)
  GROUP BY family"""
    )
)
def union_families(spark, sf_dir):
    """Rows and sums of each family are those of its part of the union."""
    frames = {
        family: NORMALISERS[family](rows).withColumn("family", F.lit(family))
        for family, rows in tables.published(stores.lines(spark, sf_dir)).items()
    }
    rows = reshape.union_all([frames[f] for f in (WIDE, LONG, LONG_EARLY, WIDE_SPECIALTY)])
    return rows.groupBy("family").agg(F.count("*").alias("n_rows"), F.sum("count").alias("total"))


@query(
    with_unified(
        f"""SELECT {iso('archive_date')} AS archive_date, hospital_name, specialty_name, list_type, granularity, bucket,
    is_suppressed_bucket, CAST(sum(count) AS BIGINT) AS total FROM unified GROUP BY ALL"""
    )
)
def unified_rows(spark, sf_dir):
    """Published frames of all families, harmonised, against the lines they were printed from."""
    rows = unify(tables.published(stores.lines(spark, sf_dir)), tables.aliases(spark, sf_dir))
    bucketed = rows.withColumns(
        {"bucket": classify_band(F.col("time_band")), "archive_date": F.col("archive_date_parsed")}
    )
    keys = ["archive_date", "hospital_name", "specialty_name", "list_type", "granularity", "bucket", "is_suppressed_bucket"]
    # Wide files print an empty cell for a band nobody waits in; such a bucket has no lines.
    return bucketed.groupBy(*keys).agg(F.sum("count").alias("total")).where("total > 0")


@query(
    """SELECT count(*) AS n, CAST(sum(CASE WHEN l_quantity > 0 THEN 1 ELSE 0 END) AS BIGINT) AS parsed,
    CAST(sum(round(l_extendedprice * 100)) AS BIGINT) AS cents FROM lineitem"""
)
def parse_numbers(spark, sf_dir):
    cells = tables.table(spark, sf_dir, "lineitem").select(
        parse_number(F.col("l_extendedprice").cast("string")).alias("v")
    )
    cents = F.sum(F.round(F.col("v") * 100).cast("bigint"))
    return cells.agg(F.count("*").alias("n"), F.count("v").alias("parsed"), cents.alias("cents"))


@query(
    """SELECT l_linenumber, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS trimmed,
    CAST(max(9007199254740993 + l_orderkey) AS BIGINT) AS largest,
    CAST(max(l_linenumber) * 10000000000000000 AS BIGINT) AS power, 0 AS fractions
  FROM lineitem GROUP BY l_linenumber"""
)
def parse_odd_counts(spark, sf_dir):
    """Counts between tabs, line feeds and no-break spaces, and decimal forms from 2^53 on."""
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    big = (F.lit(9007199254740993) + key).cast("string")
    cells = tables.table(spark, sf_dir, "lineitem").select(
        "l_linenumber",
        parse_count(F.concat(F.lit("\t\u00a0"), key.cast("string"), F.lit("\u2003\n"))).alias("trimmed"),
        parse_count(F.concat(big, F.lit(".0"))).alias("large"),
        parse_count(F.concat(line.cast("string"), F.lit("e16"))).alias("power"),
        parse_count(F.concat(big, F.lit(".5"))).alias("fraction"),
    )
    return cells.groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.sum("trimmed").alias("trimmed"), F.max("large").alias("largest"),
        F.max("power").alias("power"), F.count("fraction").cast("int").alias("fractions"),
    )
