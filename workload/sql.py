"""SQL for the benchmark tables seen as snapshot data; the counterpart of `tables`."""

BASE = """
base AS (
  SELECT make_date(year(o_orderdate), 3 * quarter(o_orderdate) - 2,
                   CASE WHEN quarter(o_orderdate) = 1 THEN 9 ELSE 24 + quarter(o_orderdate) END) AS day,
    year(o_orderdate) AS yr,
    'Group ' || s_nationkey AS hospital_group,
    lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS hospital_hipe,
    CASE WHEN s_nationkey IN (9, 10) THEN 'Small Volume Hospitals' ELSE s_name END AS published_name,
    CASE WHEN s_nationkey IN (9, 10) THEN 'Small Volume Hospitals'
         WHEN s_nationkey BETWEEN 5 AND 7 AND s_suppkey > 0 THEN 'Supplier#' || lpad(CAST(s_suppkey - 1 AS VARCHAR), 9, '0')
         ELSE s_name END AS current_name,
    replace(p_brand, 'Brand#', '') AS specialty_hipe,
    CASE WHEN p_type = 'PROMO' AND p_size <= 10 THEN 'Small Volume Specialities'
         WHEN p_type = 'PROMO' AND p_size > 40 THEN 'Small Volume Specialties'
         ELSE p_brand END AS specialty_name,
    CASE WHEN l_returnflag = 'N' THEN 'ipdc' ELSE 'op' END AS list_type,
    CASE WHEN l_linestatus = 'O' THEN 'Adult' ELSE 'Child' END AS adult_child,
    CASE WHEN year(o_orderdate) < 2000 AND l_returnflag = 'N' THEN
      CASE WHEN l_linenumber % 2 = 1 THEN 'Inpatient' ELSE 'Day Case' END END AS case_type,
    CASE WHEN year(o_orderdate) >= 2000 THEN
      CASE WHEN p_size <= 12 THEN '0-6 Months' WHEN p_size <= 25 THEN '6-12 Months'
           WHEN p_size <= 38 THEN '12-18 Months' ELSE '18 Months +' END
    ELSE CASE WHEN p_size <= 10 THEN '0-3 Months' WHEN p_size <= 20 THEN '3-6 Months'
           WHEN p_size <= 30 THEN ' 6-9 Months' WHEN p_size <= 40 THEN '9-12 Months'
           WHEN p_size <= 48 THEN '12+ Months' ELSE 'Over a year' END END AS time_band,
    l_linenumber % 2 AS part_no,
    CAST(l_quantity AS BIGINT) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
)"""

_UNIFIED_COLUMNS = """day AS archive_date, {group} AS hospital_group, {hipe} AS hospital_hipe,
    {hospital} AS hospital_name, {shipe} AS specialty_hipe, {specialty} AS specialty_name, case_type,
    adult_child, time_band, n AS count, '{granularity}' AS granularity, list_type,
    CAST(yr AS VARCHAR) AS source_year_key"""

BUCKET = r"""CASE WHEN TRY_CAST(nullif(regexp_extract(time_band, '^\s*(\d+)', 1), '') AS BIGINT) < 6
      THEN 'Under 6 Months'
    WHEN TRY_CAST(nullif(regexp_extract(time_band, '^\s*(\d+)', 1), '') AS BIGINT) < 12
      THEN '6-12 Months'
    WHEN TRY_CAST(nullif(regexp_extract(time_band, '^\s*(\d+)', 1), '') AS BIGINT) >= 12
      THEN '12+ Months'
    ELSE 'Unknown' END"""

UNIFIED = (
    BASE
    + ",\ncuts AS (\n  SELECT "
    + _UNIFIED_COLUMNS.format(
        group="hospital_group", hipe="hospital_hipe", hospital="current_name",
        shipe="specialty_hipe", specialty="specialty_name", granularity="hospital_specialty",
    )
    + "\n  FROM base WHERE yr < 2000\n  UNION ALL\n  SELECT "
    + _UNIFIED_COLUMNS.format(
        group="NULL", hipe="NULL", hospital="current_name", shipe="NULL", specialty="NULL",
        granularity="hospital",
    )
    + "\n  FROM base WHERE yr >= 2000\n  UNION ALL\n  SELECT "
    + _UNIFIED_COLUMNS.format(
        group="NULL", hipe="NULL", hospital="NULL", shipe="NULL", specialty="specialty_name",
        granularity="national_specialty",
    )
    + f"""
  FROM base WHERE yr >= 2000
),
unified AS (
  SELECT *, {BUCKET} AS bucket,
    coalesce(hospital_name = 'Small Volume Hospitals', false)
      OR coalesce(specialty_name IN ('Small Volume Specialities', 'Small Volume Specialties'), false)
      AS is_suppressed_bucket
  FROM cuts
)"""
)

BUCKET_SUMS = """
  CAST(coalesce(sum(CASE WHEN bucket = 'Under 6 Months' THEN count END), 0) AS BIGINT) AS under_6,
  CAST(coalesce(sum(CASE WHEN bucket = '6-12 Months' THEN count END), 0) AS BIGINT) AS six_to_12,
  CAST(coalesce(sum(CASE WHEN bucket = '12+ Months' THEN count END), 0) AS BIGINT) AS twelve_plus,
  CAST(coalesce(sum(count), 0) AS BIGINT) AS total"""

IN_HOSPITAL = "NOT is_suppressed_bucket AND hospital_name IS NOT NULL"
IN_SPECIALTY = "NOT is_suppressed_bucket AND specialty_name IS NOT NULL"
COMBINATION = "list_type, adult_child"


def iso(day: str) -> str:
    return f"strftime({day}, '%Y-%m-%d')"


def with_unified(query: str) -> str:
    return f"WITH {UNIFIED}\n{query}"


def with_base(query: str) -> str:
    return f"WITH {BASE}\n{query}"


def series(by: str, where: str) -> str:
    """Common table text: bucket sums by key and date over known bands."""
    return f"""SELECT {by}, archive_date, {BUCKET_SUMS}
  FROM unified WHERE {where} AND bucket <> 'Unknown' GROUP BY {by}, archive_date"""


HOSPITAL_SERIES = series(f"hospital_name, {COMBINATION}", IN_HOSPITAL)
NATIONAL_SERIES = series(COMBINATION, IN_HOSPITAL)

BREAKDOWN = f"""latest AS (
  SELECT list_type, adult_child, max(archive_date) AS last_updated FROM unified
  WHERE granularity IN ('hospital_specialty', 'national_specialty') GROUP BY list_type, adult_child
),
breakdown AS (
  SELECT u.list_type, u.adult_child, l.last_updated, specialty_name, {BUCKET_SUMS}
  FROM unified u JOIN latest l
    ON u.list_type = l.list_type AND u.adult_child = l.adult_child AND archive_date = last_updated
  WHERE {IN_SPECIALTY} AND bucket <> 'Unknown'
  GROUP BY u.list_type, u.adult_child, l.last_updated, specialty_name
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY list_type, adult_child
                               ORDER BY total DESC, specialty_name) AS rank,
    count(*) OVER (PARTITION BY list_type, adult_child) AS n_tracked
  FROM breakdown
)"""


def with_breakdown(query: str) -> str:
    return f"WITH {UNIFIED},\n{BREAKDOWN}\n{query}"
