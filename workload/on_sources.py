"""Landing, raw store, incremental loading, tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktide.fixed_values import LONG, WIDE
from stocktide.functions.cells import grouped_digits, parse_count
from stocktide.operators.clean import rename_known
from stocktide.shared_dir import new_folder
from stocktide.sources import catalogue, landing, ledger, raw_store, warehouse_store
from stocktide.streaming.ingest import ingest_arrivals

from . import stores, tables
from .registry import query
from .sql import IN_HOSPITAL, with_base, with_unified

_DATE_TEXT = """CASE WHEN yr < 1997 THEN strftime(day, '%Y-%m-%d')
    WHEN yr < 2000 THEN strftime(day, '%d/%m/%Y')
    ELSE day(day) || '/' || month(day) || '/' || yr END"""


def _grouped(band: str | None = None) -> str:
    part = f"CASE WHEN time_band = '{band}' THEN n END" if band else "n"
    return f"CAST(sum({part}) AS BIGINT)"


_WIDE_SUMS = f"""{_grouped('0-6 Months')} AS b1, {_grouped('6-12 Months')} AS b2,
    {_grouped('12-18 Months')} AS b3, {_grouped('18 Months +')} AS b4, {_grouped()} AS t"""
_WIDE_TEXT = """format('{:,}', b1) AS months_0_6, format('{:,}', b2) AS months_6_12,
    format('{:,}', b3) AS months_12_18, format('{:,}', b4) AS months_18_plus,
    format('{:,}', CASE WHEN t % 7 = 0 THEN t + 1 ELSE t END) AS total"""


@query(
    with_base(
        f"""SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key, archive_date,
    adult_child, hospital_name, {_WIDE_TEXT}
  FROM (SELECT list_type, yr, {_DATE_TEXT} AS archive_date, adult_child,
      published_name AS hospital_name, {_WIDE_SUMS}
    FROM base WHERE yr >= 2000 GROUP BY ALL)"""
    )
)
def csv_scan(spark, sf_dir):
    """Wide CSV files as text cells, headers in snake case."""
    folder = stores.landing(spark, sf_dir)
    wanted = F.col("dataset").isin(*catalogue.HOSPITAL_DATASETS) & F.col("year_key").isin(
        *tables.YEARS[WIDE]
    )
    found = landing.latest_publications(landing.list_files(spark, folder).where(wanted))
    placed, _ = landing.dispatch(found, years_of_family=tables.YEARS)
    ((_, rows),), _ = landing.read_publications(spark, folder, placed)
    return rename_known(rows.drop("published", "_source_file"))


@query()
def archive_manifest(spark, sf_dir):
    """SHA-256 of the landed files; SQL has no view of their bytes."""
    entries = landing.manifest(spark, stores.landing(spark, sf_dir))
    return entries.groupBy("dataset", "year_key").agg(
        F.count("*").alias("n_files"),
        F.count_distinct("sha256").alias("n_contents"),
        F.sum("length").alias("n_bytes"),
    )


_PRINTED = ("ArchiveDate", "Adult_Child", "HospitalName", "0-6 Months", "6-12 Months", "12-18 Months", "18 Months +",
            "Total")
_PRINTED_LINE = " || ',' || ".join(
    f"""'"' || coalesce({name}, '-') || '"'"""
    for name in ("archive_date", "adult_child", "hospital_name", "months_0_6", "months_6_12", "months_12_18",
                 "months_18_plus", "total")
)


@query(
    with_base(
        f"""SELECT dataset, year_key, published, sha256(printed) AS sha256, strlen(printed) AS length,
    CASE WHEN year_key = '2001' THEN 2 ELSE 1 END AS copies
  FROM (SELECT dataset, year_key, '{','.join(f'"{name}"' for name in _PRINTED)}' || chr(10)
        || string_agg(line, chr(10) ORDER BY encode(line)) || chr(10) AS printed
      FROM (SELECT dataset, year_key, {_PRINTED_LINE} AS line
        FROM (SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key, archive_date,
            adult_child, hospital_name, {_WIDE_TEXT}
          FROM (SELECT list_type, yr, {_DATE_TEXT} AS archive_date, adult_child,
              published_name AS hospital_name, {_WIDE_SUMS}
            FROM base WHERE yr >= 2000 GROUP BY ALL))) GROUP BY ALL)
  JOIN (VALUES ('{tables.FIRST_PUBLICATION}'), ('2002-02-15')) AS p(published)
    ON year_key = '2001' OR published = '{tables.FIRST_PUBLICATION}'"""
    )
)
def manifest_hashes(spark, sf_dir):
    """The manifest of wide years printed in order of their lines, every cell quoted; 2001 is published twice."""
    folder = new_folder(spark, "printed")
    wide = raw_store.read_raw(spark, stores.raw(spark, sf_dir), WIDE).fillna("-", _PRINTED)
    line = F.concat_ws('","', *[f"`{name}`" for name in _PRINTED])
    for published, rows in ((tables.FIRST_PUBLICATION, wide), ("2002-02-15", wide.where("year_key = '2001'"))):
        printed = rows.withColumns({"published": F.lit(published), "line": line})
        printed.repartition("dataset", "year_key").sortWithinPartitions("dataset", "year_key", "line").select(
            "dataset", "year_key", "published", *[f"`{name}`" for name in _PRINTED]
        ).write.partitionBy("dataset", "year_key", "published").mode("append").options(
            header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(folder)  # one file for each publication, since its rows are in one task
    entries = landing.manifest(spark, folder)
    copies = landing.duplicate_files(entries).select("sha256", F.col("copies").cast("int").alias("copies"))
    return entries.join(copies, "sha256", "left").select(
        "dataset", "year_key", "published", "sha256", "length", F.coalesce("copies", F.lit(1)).alias("copies")
    )


@query(
    with_base(
        """SELECT dataset, year_key, bool_or(known) AS known FROM (
    SELECT DISTINCT list_type || '_hospital' AS dataset, CAST(yr + 2 AS VARCHAR) AS year_key,
      yr + 2 IN (SELECT DISTINCT yr FROM base) AS known FROM base) GROUP BY ALL"""
    )
)
def source_catalogue(spark, sf_dir):
    """Asking for every year two later than the data's: some are in the catalogue, some are not."""
    years = stores.loaded_unified(spark, sf_dir).select(
        F.concat("list_type", F.lit("_hospital")).alias("dataset"),
        F.col("source_year_key").alias("year_key"),
    )
    known = years.distinct()
    wanted = known.select("dataset", (F.col("year_key").cast("int") + 2).cast("string").alias("year_key"))
    chosen, unknown = catalogue.select_sources(known, wanted.distinct())
    return chosen.withColumn("known", F.lit(True)).unionByName(
        unknown.withColumn("known", F.lit(False))
    )


@query(
    with_base(
        """SELECT DISTINCT list_type || d AS dataset, CAST(yr AS VARCHAR) AS year_key,
    CASE WHEN d = '_specialty' THEN 'wide_specialty' WHEN yr >= 2000 THEN 'wide'
         WHEN yr >= 1997 THEN 'long' WHEN yr = 1996 THEN 'long_early' ELSE 'unknown' END AS family
  FROM base CROSS JOIN (VALUES ('_hospital'), ('_specialty')) AS c(d)
  WHERE d = '_hospital' OR yr >= 2000"""
    )
)
def family_dispatch(spark, sf_dir):
    """Landed years by shape family when 1995 is not a known year."""
    families = {**tables.YEARS, "long_early": ("1996",)}
    files = landing.list_files(spark, stores.landing(spark, sf_dir))
    known, unknown = landing.dispatch(
        landing.latest_publications(files), years_of_family=families
    )
    rows = known.unionByName(unknown.withColumn("family", F.lit("unknown")))
    return rows.select("dataset", "year_key", "family")


_LINEAGE = with_base(
    """SELECT list_type || '_specialty' AS dataset, CAST(yr AS VARCHAR) AS year_key,
    count(*) AS n_rows, true AS same_year, true AS has_file, true AS has_date, false AS has_address
  FROM (SELECT list_type, yr, day, adult_child, specialty_name,
      CASE WHEN list_type = 'op' THEN part_no END AS part FROM base WHERE yr >= 2000 GROUP BY ALL)
  GROUP BY ALL"""
)


@query(_LINEAGE)
def lineage_tags(spark, sf_dir):
    """The catalogue has no address for the benchmark's years, so none is tagged."""
    rows = raw_store.read_raw(spark, stores.raw(spark, sf_dir), "wide_specialty", lineage=True)
    return rows.groupBy("dataset", "year_key").agg(
        F.count("*").alias("n_rows"),
        F.every(F.col("_source_year_key") == F.col("year_key")).alias("same_year"),
        F.every(F.col("_source_file").endswith(".csv")).alias("has_file"),
        F.every(F.col("_loaded_date").isNotNull()).alias("has_date"),
        F.bool_or(F.col("_source_url").isNotNull()).alias("has_address"),
    )


@query(
    with_base(
        """SELECT 'ntpf_ipdc_historical_' || yr AS table_name, 'ipdc_hospital' AS dataset,
    CAST(yr AS VARCHAR) AS year_key, 'ipdc' AS list_type, false AS is_specialty_file FROM base
  UNION SELECT 'ntpf_op_speciality_' || yr || '_apr_dec', 'op_specialty', yr || '_apr_dec', 'op', true
  FROM base"""
    )
)
def discover_tables(spark, sf_dir):
    """Names with another character where the prefix has '_' are not raw tables."""
    years = tables.snapshots(spark, sf_dir).select(F.col("year").cast("string").alias("y")).distinct()
    names = F.array(
        F.concat(F.lit("ntpf_ipdc_historical_"), "y"),
        F.concat(F.lit("ntpf_op_speciality_"), "y", F.lit("_apr_dec")),
        F.concat(F.lit("ntpfXopXspeciality_"), "y"),
        F.concat(F.lit("population_"), "y"),
    )
    return catalogue.discover_tables(years.select(F.explode(names).alias("table_name")))


_LONG_GROUPS = """SELECT list_type, yr, day, hospital_group, hospital_hipe, published_name,
      specialty_hipe, specialty_name, case_type, adult_child, time_band, sum(n) AS n
    FROM base WHERE yr BETWEEN 1997 AND 1999 GROUP BY ALL"""


@query(
    with_base(
        f"""SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key,
    count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS total FROM ({_LONG_GROUPS}) GROUP BY ALL"""
    )
)
def raw_scan(spark, sf_dir):
    """Loaded long files, lineage columns left out."""
    rows = raw_store.read_raw(spark, stores.raw(spark, sf_dir), LONG)
    return rows.groupBy("dataset", "year_key").agg(
        F.count("*").alias("n_rows"), F.sum(parse_count(F.col("Total"))).alias("total")
    )


@query(
    with_base(
        """SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key,
    CAST(sum(CASE WHEN yr = 1998 AND list_type = 'ipdc' THEN 2 * n ELSE n END) AS BIGINT) AS total
  FROM base WHERE yr BETWEEN 1997 AND 1999 GROUP BY ALL"""
    )
)
def replace_year(spark, sf_dir):
    """Writing one dataset's year again, with doubled counts, replaces that year alone."""
    folder = new_folder(spark, "raw")
    rows = raw_store.read_raw(spark, stores.raw(spark, sf_dir), LONG).withColumn("published", F.lit("1"))
    raw_store.write_raw(rows, folder, LONG)
    again = rows.where("dataset = 'ipdc_hospital' and year_key = '1998'").withColumn(
        "Total", grouped_digits(2 * parse_count(F.col("Total")))
    )
    raw_store.write_raw(again, folder, LONG)
    loaded = raw_store.read_raw(spark, folder, LONG)
    return loaded.groupBy("dataset", "year_key").agg(
        F.sum(parse_count(F.col("Total"))).alias("total")
    )


@query(
    with_base(
        """SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key,
    CAST(sum(CASE WHEN time_band = '0-6 Months' THEN n ELSE 0 END) AS BIGINT) AS months_0_6,
    CAST(count(DISTINCT (day, adult_child, published_name)) * CASE WHEN yr = 2001 THEN 2 ELSE 1 END AS BIGINT)
      AS n_rows
  FROM base WHERE yr >= 2000 GROUP BY list_type, yr"""
    )
)
def incremental_ingest(spark, sf_dir):
    """Three runs of the stream: first load, nothing new, a later publication of one year.

    The later publication prints each row of 2001 twice, the copy with empty cells.
    """
    root = new_folder(spark, "incremental")
    landed, raw, checkpoint = f"{root}/landing", f"{root}/raw", f"{root}/checkpoint"

    def run():
        ingest_arrivals(spark, landed, raw, checkpoint, years_of_family=tables.YEARS).awaitTermination()

    wide = raw_store.read_raw(spark, stores.raw(spark, sf_dir), WIDE)
    tables.write_publication(wide, landed)
    run()
    run()
    later = wide.where("year_key = '2001'")
    empty = later.withColumns(
        {c: F.lit(None).cast("string") for c in ("0-6 Months", "6-12 Months", "12-18 Months", "18 Months +", "Total")}
    )
    tables.write_publication(later.unionByName(empty), landed, "2002-02-15")
    run()
    loaded = raw_store.read_raw(spark, raw, WIDE)
    return loaded.groupBy("dataset", "year_key").agg(
        F.coalesce(F.sum(parse_count(F.col("0-6 Months"))), F.lit(0)).alias("months_0_6"),
        F.count("*").alias("n_rows"),
    )


@query(
    with_base(
        """SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key,
    CASE WHEN yr = 2001 THEN 'bad rows' WHEN list_type = 'ipdc' THEN 'no rows'
      ELSE 'header does not fit' END AS reason,
    CAST(count(DISTINCT (day, adult_child, published_name)) AS BIGINT) AS n_rows
  FROM base WHERE yr >= 2000 GROUP BY list_type, yr"""
    )
)
def ingest_rejects(spark, sf_dir):
    """Corrections of every wide year with a fault each: no rows, a header of another shape, rows with a cell
    too many, line breaks inside quotes. None is loaded, and what was loaded before stays."""
    root = new_folder(spark, "rejects")
    landed, raw = f"{root}/landing", f"{root}/raw"
    wide = raw_store.read_raw(spark, stores.raw(spark, sf_dir), WIDE)
    tables.write_publication(wide, landed)
    raw_store.ingest(spark, landed, raw, years_of_family=tables.YEARS)

    def faulty(dataset, year, rows, **options):
        folder = f"{landed}/dataset={dataset}/year_key={year}/published=2002-03-15"
        of_year = rows.where((F.col("dataset") == dataset) & (F.col("year_key") == year))
        of_year.drop("dataset", "year_key").write.options(header=True, **options).csv(folder)

    faulty("ipdc_hospital", "2000", wide.where("false"))
    faulty("op_hospital", "2000", wide.withColumnRenamed("HospitalName", "Place"))
    name = F.col("HospitalName")
    # Printed without quotes, the comma begins another cell.
    faulty("ipdc_hospital", "2001", wide.withColumn("HospitalName", F.concat(name, F.lit(", A"))), quote="")
    faulty("op_hospital", "2001", wide.withColumn("HospitalName", F.concat(name, F.lit("\nA"))))
    left_out = raw_store.ingest(spark, landed, raw, years_of_family=tables.YEARS)
    loaded = raw_store.loaded_years(spark, raw)
    return left_out.join(loaded, ["dataset", "year_key"]).select("dataset", "year_key", "reason", "n_rows")


@query(
    with_base(
        f"""SELECT list_type || '_hospital' AS dataset, CAST(yr AS VARCHAR) AS year_key,
    CASE WHEN yr = 2001 THEN '2002-02-15' ELSE '{tables.FIRST_PUBLICATION}' END AS published,
    CAST(count(DISTINCT (day, adult_child, published_name)) * CASE WHEN yr = 2001 THEN 2 ELSE 1 END AS BIGINT)
      AS n_rows,
    CAST(count(DISTINCT (day, adult_child, published_name)) * CASE WHEN yr = 2001 THEN 2 ELSE 1 END AS BIGINT)
      AS n_rows_fresh,
    CAST(0 AS BIGINT) AS n_differ
  FROM base WHERE yr >= 2000 GROUP BY list_type, yr"""
    )
)
def fresh_load(spark, sf_dir):
    """A landing folder loaded as publications arrive, and loaded afresh in the end: the same store.

    Every wide year is published; 2001 again with each row twice; last come an empty correction of 2000 and
    one of 2001 whose rows have a cell too many, which the publication before stands in for.
    """
    root = new_folder(spark, "fresh")
    landed, stepwise, fresh = f"{root}/landing", f"{root}/stepwise", f"{root}/fresh"
    wide = raw_store.read_raw(spark, stores.raw(spark, sf_dir), WIDE)

    def load(into):
        raw_store.ingest(spark, landed, into, years_of_family=tables.YEARS)

    tables.write_publication(wide, landed)
    load(stepwise)
    later = wide.where("year_key = '2001'")
    tables.write_publication(later.union(later), landed, "2002-02-15")
    load(stepwise)
    for dataset in catalogue.HOSPITAL_DATASETS:
        for year, rows, options in (
            ("2000", wide.where("false"), {}),
            ("2001", later.withColumn("HospitalName", F.concat("HospitalName", F.lit(", A"))), {"quote": ""}),
        ):
            of_year = rows.where((F.col("dataset") == dataset) & (F.col("year_key") == year))
            folder = f"{landed}/dataset={dataset}/year_key={year}/published=2002-03-15"
            of_year.drop("dataset", "year_key").write.options(header=True, **options).csv(folder)
    load(stepwise)
    load(fresh)
    keys = ["dataset", "year_key"]
    one, other = (raw_store.read_raw(spark, raw, WIDE) for raw in (stepwise, fresh))
    differ = one.exceptAll(other).union(other.exceptAll(one)).groupBy(keys).agg(F.count("*").alias("n_differ"))
    counts = raw_store.loaded_years(spark, fresh).select(*keys, F.col("n_rows").alias("n_rows_fresh"))
    chosen = ledger.newest_valid(ledger.read_ledger(spark, stepwise)).select(*keys, "published", "n_rows")
    told = ledger.newest_valid(ledger.read_ledger(spark, fresh)).select(*keys, "published")
    return chosen.join(told, [*keys, "published"]).join(counts, keys).join(differ, keys, "left").fillna(0, ["n_differ"])


@query(
    """SELECT sha256(text) AS sha256, count(*) AS copies, min(doc_id) AS first_path FROM documents
  WHERE text IS NOT NULL GROUP BY ALL HAVING count(*) > 1"""
)
def duplicate_contents(spark, sf_dir):
    """The manifest's hash and duplicate search, over texts in place of files."""
    texts = tables.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), "text")
    return landing.duplicate_files(landing.hashed(texts, "text"))


@query(
    with_unified(
        f"""SELECT 'dim_date' AS table_name, count(DISTINCT archive_date) AS n_rows FROM unified
  UNION ALL SELECT 'dim_hospital', count(DISTINCT hospital_name) FROM unified WHERE {IN_HOSPITAL}
  UNION ALL SELECT 'dim_specialty', count(DISTINCT specialty_name) FROM unified
    WHERE NOT is_suppressed_bucket
  UNION ALL SELECT 'fact_waiting_list', (SELECT count(*) FROM ({_LONG_GROUPS.replace('yr BETWEEN 1997 AND 1999', 'yr < 2000')}))
    + 4 * (SELECT count(*) FROM (SELECT DISTINCT list_type, day, adult_child, published_name FROM base WHERE yr >= 2000))
    + 4 * (SELECT count(*) FROM (SELECT DISTINCT list_type, day, adult_child, specialty_name FROM base WHERE yr >= 2000))"""
    )
)
def warehouse_counts(spark, sf_dir):
    """Rows of the four tables of the written warehouse."""
    return warehouse_store.table_counts(stores.star(spark, sf_dir))
