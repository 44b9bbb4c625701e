"""Dimensions, fact table, surrogate keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktide.fixed_values import WIDE
from stocktide.operators import joins, quality, reshape, star
from stocktide.plans.warehouse import build_dimensions, rebuild, update
from stocktide.shared_dir import new_folder
from stocktide.sources import raw_store
from stocktide.sources.warehouse_store import new_build, published_build

from . import stores, tables
from .registry import query
from .sql import IN_HOSPITAL, iso, with_unified


@query(
    with_unified(
        f"""SELECT row_number() OVER (ORDER BY archive_date) AS date_id, {iso('archive_date')} AS archive_date,
    CAST(year(archive_date) AS INTEGER) AS year, CAST(month(archive_date) AS INTEGER) AS month
  FROM (SELECT DISTINCT archive_date FROM unified)"""
    )
)
def dim_date(spark, sf_dir):
    return star.build_dim_date(tables.unified(spark, sf_dir))


_HOSPITALS = f"""SELECT row_number() OVER (ORDER BY hospital_name) AS hospital_id, hospital_name,
    hospital_group, hospital_hipe
  FROM (SELECT *, row_number() OVER (PARTITION BY hospital_name ORDER BY list_type, source_year_key,
      archive_date, hospital_group NULLS FIRST, hospital_hipe NULLS FIRST) AS r
    FROM unified WHERE {IN_HOSPITAL}) WHERE r = 1"""


@query(with_unified(_HOSPITALS))
def dim_hospital(spark, sf_dir):
    return star.build_dim_hospital(tables.unified(spark, sf_dir))


@query(with_unified(_HOSPITALS))
def star_dim_hospital(spark, sf_dir):
    """The written dimension, made from loaded files."""
    return stores.star(spark, sf_dir).dim_hospital


@query(
    with_unified(
        """SELECT row_number() OVER (ORDER BY specialty_name) AS specialty_id, specialty_name, specialty_hipe
  FROM (SELECT *, row_number() OVER (PARTITION BY specialty_name ORDER BY list_type, source_year_key,
      archive_date, specialty_hipe NULLS FIRST) AS r
    FROM unified WHERE NOT is_suppressed_bucket AND specialty_name IS NOT NULL) WHERE r = 1"""
    )
)
def dim_specialty(spark, sf_dir):
    return star.build_dim_specialty(tables.unified(spark, sf_dir))


@query(
    with_unified(
        f"""SELECT a.hospital_name, hospital_group, hospital_hipe
  FROM (SELECT DISTINCT hospital_name FROM unified WHERE {IN_HOSPITAL} AND list_type = 'op') a
  LEFT JOIN (SELECT hospital_name, arg_min(hospital_group, (source_year_key, archive_date, hospital_group, hospital_hipe)) AS hospital_group,
      arg_min(hospital_hipe, (source_year_key, archive_date, hospital_group, hospital_hipe)) AS hospital_hipe
    FROM unified WHERE {IN_HOSPITAL} AND list_type = 'op' AND hospital_group IS NOT NULL GROUP BY 1) b
  ON a.hospital_name = b.hospital_name"""
    )
)
def first_values(spark, sf_dir):
    """First non-null group and code per hospital, where wide files, which have none, may come first."""
    rows = tables.unified(spark, sf_dir).where("not is_suppressed_bucket and list_type = 'op'")
    return star.first_per_key(
        rows, "hospital_name", ("hospital_group", "hospital_hipe"), skip_nulls=True
    )


@query(
    with_unified(
        f"""SELECT hospital_name, source_year_key, {iso('archive_date')} AS archive_date, hospital_group
  FROM (SELECT *, row_number() OVER (PARTITION BY hospital_name
      ORDER BY source_year_key DESC, archive_date DESC) AS r
    FROM (SELECT DISTINCT hospital_name, source_year_key, archive_date, NULLIF('', '') AS hospital_group
          FROM unified WHERE {IN_HOSPITAL} AND granularity = 'hospital')) WHERE r = 1"""
    )
)
def keep_first(spark, sf_dir):
    """First row per key by a given order, nulls kept as they are."""
    rows = tables.unified(spark, sf_dir).where("not is_suppressed_bucket and granularity = 'hospital'")
    newest = rows.withColumns(
        {
            "_by_year": -F.col("source_year_key").cast("int"),
            "_by_day": -F.unix_date("archive_date_parsed"),
        }
    )
    kept = star.first_per_key(
        newest,
        "hospital_name",
        ("source_year_key", "archive_date_parsed", "hospital_group"),
        order=("_by_year", "_by_day"),
    )
    return kept.withColumnRenamed("archive_date_parsed", "archive_date")


_FACT_SUMS = """SELECT date_id, hospital_id, specialty_id, granularity, list_type, is_suppressed_bucket,
    CAST(sum(count) AS BIGINT) AS total
  FROM unified
  JOIN (SELECT archive_date, row_number() OVER (ORDER BY archive_date) AS date_id
        FROM (SELECT DISTINCT archive_date FROM unified)) USING (archive_date)
  LEFT JOIN (SELECT hospital_name, row_number() OVER (ORDER BY hospital_name) AS hospital_id
        FROM (SELECT DISTINCT hospital_name FROM unified
              WHERE NOT is_suppressed_bucket AND hospital_name IS NOT NULL)) USING (hospital_name)
  LEFT JOIN (SELECT specialty_name, row_number() OVER (ORDER BY specialty_name) AS specialty_id
        FROM (SELECT DISTINCT specialty_name FROM unified
              WHERE NOT is_suppressed_bucket AND specialty_name IS NOT NULL)) USING (specialty_name)
  GROUP BY ALL"""


def _fact_sums(fact):
    return fact.groupBy(
        "date_id", "hospital_id", "specialty_id", "granularity", "list_type", "is_suppressed_bucket"
    ).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total"))


@query(with_unified(_FACT_SUMS))
def fact_rows(spark, sf_dir):
    """Names and dates replaced by ids; rows of buckets keep the id of a real hospital."""
    rows = stores.kept(spark, tables.unified(spark, sf_dir))
    dims = build_dimensions(rows, new_build(new_folder(spark, "dimensions")))
    return _fact_sums(star.build_fact(rows, *dims))


@query(with_unified(_FACT_SUMS))
def star_fact(spark, sf_dir):
    """The written fact table, made from loaded files."""
    return _fact_sums(stores.star(spark, sf_dir).fact)


@query(with_unified("SELECT true AS all_unique, min(list_type) AS first_list_type FROM unified"))
def fact_ids_unique(spark, sf_dir):
    fact = stores.star(spark, sf_dir).fact
    return fact.agg(
        (F.count("fact_id") == F.count_distinct("fact_id")).alias("all_unique"),
        F.min("list_type").alias("first_list_type"),
    )


@query(
    with_unified(
        """SELECT granularity, list_type, count(*) AS n_rows FROM unified
  WHERE hospital_name IN (SELECT hospital_name FROM unified
    WHERE NOT is_suppressed_bucket AND hospital_name IS NOT NULL) GROUP BY ALL"""
    )
)
def known_hospital_rows(spark, sf_dir):
    """Rows of hospitals in the written dimension, their suppressed rows among them."""
    hospitals = stores.star(spark, sf_dir).dim_hospital
    found = joins.known_only(tables.unified(spark, sf_dir), hospitals, "hospital_name")
    return found.groupBy("granularity", "list_type").agg(F.count("*").alias("n_rows"))


@query(
    """SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity) AS BIGINT) AS count FROM lineitem
  WHERE l_returnflag <> 'R' GROUP BY ALL"""
)
def collapse_duplicates(spark, sf_dir):
    """Rows that share a key become their sum; rows that lack a key part are dropped."""
    rows = tables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")).alias("l_linenumber"),
        F.col("l_quantity").cast("bigint").alias("count"),
    )
    return reshape.sum_duplicates(rows, ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(
        tables.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


@query(
    with_unified(
        """SELECT list_type, source_year_key,
    CAST(sum(count * CASE WHEN source_year_key = '2001' AND granularity = 'hospital' THEN 2 ELSE 1 END) AS BIGINT) AS total,
    CAST(0 AS BIGINT) AS n_differ, source_year_key <> '2001' AS taken_over
  FROM unified GROUP BY ALL"""
    )
)
def warehouse_update(spark, sf_dir):
    """A warehouse brought up to date after 2001 was published again with each hospital row twice: its sums, how many
    rows differ from a warehouse built whole, and whether the facts are files of the first build."""
    root = new_folder(spark, "update")
    landed, raw, at = f"{root}/landing", f"{root}/raw", f"{root}/warehouse"
    aliases = tables.aliases(spark, sf_dir)
    tables.write_all_publications(stores.lines(spark, sf_dir), landed)
    raw_store.ingest(spark, landed, raw, years_of_family=tables.YEARS)
    rebuild(spark, raw, at, aliases)
    first = published_build(spark, at).name
    later = raw_store.read_raw(spark, raw, WIDE).where("year_key = '2001'")
    tables.write_publication(later.union(later), landed, "2002-02-15")
    raw_store.ingest(spark, landed, raw, years_of_family=tables.YEARS)
    updated = update(spark, raw, at, aliases)
    whole = rebuild(spark, raw, f"{root}/whole", aliases)
    keys = ["list_type", "source_year_key"]
    placed = updated.fact.withColumn("of_first", F.contains(F.input_file_name(), F.lit(first)))
    sums = placed.groupBy(keys).agg(F.sum("count").alias("total"), F.bool_and("of_first").alias("taken_over"))
    one, other = (star.star_observations(built).drop("fact_id") for built in (updated, whole))
    differ = one.exceptAll(other).unionByName(other.exceptAll(one)).groupBy(keys).agg(F.count("*").alias("n_differ"))
    return sums.join(differ, keys, "left").fillna(0, ["n_differ"])
