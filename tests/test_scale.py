"""Plans and results that must hold when one key has a third of all rows."""

import random
from collections import defaultdict

import pytest
from helpers import as_set, unified
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocktide.fixed_values import LONG, LONG_EARLY, WIDE, WIDE_SPECIALTY
from stocktide.operators import joins, star
from stocktide.plans import publish, queries
from stocktide.plans.harmonise import unify_attributes
from stocktide.plans.warehouse import build_warehouse
from stocktide.schemas import PARTITIONS, RAW
from workload import tables


def plan(df, kind="simple"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), kind)


@pytest.fixture(scope="module")
def rows():
    """A third of the rows in one hospital, a third in one suppression bucket."""
    pick = random.Random(7)
    bands = ["0-6 Months", "6-12 Months", "12-18 Months", "18 Months +", "Over a year"]
    made = []
    for i in range(3000):
        hospital = ("Hot", "Small Volume Hospitals", f"H{pick.randrange(200)}")[i % 3]
        day = pick.choice(["2026-01-29", "2026-02-26", "2026-06-25"])
        population, list_type = pick.choice(["Adult", "Child"]), pick.choice(["ipdc", "op"])
        band, count = pick.choice(bands), pick.randrange(50)
        made.append((day, hospital, None, population, band, count, "hospital", list_type))
        made.append((day, None, f"S{pick.randrange(40)}", population, band, count, "national_specialty", list_type))
    return made


@pytest.fixture(scope="module")
def skewed(spark, rows):
    return unified(spark, rows).persist()


def brute_force(rows):
    totals = defaultdict(int)
    for day, hospital, _, population, band, count, granularity, list_type in rows:
        if granularity == "hospital" and not hospital.startswith("Small") and band != "Over a year":
            totals[hospital, list_type, population, day] += count
    return {(*key, total) for key, total in totals.items()}


def test_skewed_series_against_brute_force(spark, rows, skewed, tmp_path):
    by = ["hospital_name", "list_type", "adult_child", F.col("archive_date").cast("string"), "total"]
    expected = brute_force(rows)
    assert as_set(queries.hospital_series(star.observations(skewed)), *by) == expected
    built = build_warehouse(skewed, str(tmp_path / "w"))
    assert as_set(queries.star_hospital_series(built), *by) == expected
    flat = publish.flatten_documents(publish.star_hospital_documents(built))
    assert as_set(flat, "hospital_name", "list_type", "adult_child", "date", "total") == expected


def test_ranking_against_brute_force(rows, skewed):
    totals = defaultdict(int)
    for day, _, specialty, population, band, count, granularity, list_type in rows:
        if granularity == "national_specialty" and day == "2026-06-25" and band != "Over a year":
            totals[list_type, population, specialty] += count
    expected = set()
    for list_type in ("ipdc", "op"):
        for population in ("Adult", "Child"):
            mine = sorted((-t, s) for (lt, p, s), t in totals.items() if (lt, p) == (list_type, population))
            expected |= {(list_type, population, s, -t, len(mine)) for t, s in mine[:15]}
    top = queries.top_specialties(star.observations(skewed))
    assert as_set(top, "list_type", "adult_child", "specialty_name", "total", "n_tracked") == expected


def test_series_take_one_shuffle(skewed):
    shown = plan(queries.hospital_series(star.observations(skewed)))
    assert shown.count("Exchange") == 1 and "Window" not in shown


def test_ranking_limits_each_task_before_the_shuffle(skewed):
    shown = plan(queries.ranked(queries.specialty_breakdown(star.observations(skewed))))
    assert shown.count("WindowGroupLimit") == 2


def test_a_ranking_by_name_reads_the_facts_once(skewed, tmp_path):
    path = str(tmp_path / "facts")
    star.observations(skewed).write.parquet(path)
    facts = skewed.sparkSession.read.parquet(path)
    shown = plan(queries.specialty_breakdown(facts))
    assert shown.count("Scan parquet") == 1 and "Join" not in shown
    given = queries.latest_dates(facts).collect()
    columns = queries.specialty_breakdown(facts).columns
    assert as_set(queries.specialty_breakdown(facts), *columns) == as_set(
        queries.specialty_breakdown(facts, dates=given), *columns
    )


def test_the_latest_totals_run_nothing_before_the_action(skewed, tmp_path):
    built = build_warehouse(skewed, str(tmp_path / "w"))
    tracker = skewed.sparkSession._jsparkSession.sharedState().statusStore()
    before = tracker.executionsCount()
    found = queries.latest_totals(built)
    assert tracker.executionsCount() == before and found.columns == ["list_type", "archive_date", "total_waiting"]
    assert "Subquery" in plan(found) and found.count() > 0


def test_the_latest_snapshot_is_picked_in_the_scan(skewed, tmp_path):
    built = build_warehouse(skewed, str(tmp_path / "w"))
    shown = plan(queries.specialty_breakdown(built.fact, queries.IDS), "formatted")
    (pushed,) = [line for line in shown.splitlines() if line.startswith("PushedFilters")]
    assert "EqualTo(date_id,3)" in pushed and "Join" not in shown


def test_star_queries_read_only_their_columns_and_partitions(skewed, tmp_path):
    built = build_warehouse(skewed, str(tmp_path / "w"))
    facts = built.fact.where("list_type = 'ipdc'")
    shown = plan(queries.national_series(facts, queries.IDS), "formatted")
    assert "PartitionFilters: [isnotnull(list_type" in shown
    (pushed,) = [line for line in shown.splitlines() if line.startswith("PushedFilters")]
    for condition in ("EqualTo(is_suppressed_bucket,", "IsNotNull(date_id)", "IsNotNull(hospital_id)"):
        assert condition in pushed
    (read,) = [line for line in shown.splitlines() if line.startswith("ReadSchema")]
    for unused in ("fact_id", "specialty_id", "case_type", "granularity"):
        assert unused not in read


def test_a_hot_key_is_split_in_lookup_joins(spark):
    """With broadcasting off, adaptive execution splits the partition of the hot key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), "id"))
        left = spark.range(0, 60000, 1, 8).select(key.alias("k"), "id")
        keys = spark.range(0, 60000, 1, 8).where("id % 3 = 1 or id = 0").select(key.alias("k"))
        names = keys.withColumn("v", F.upper("k"))
        joined = joins.lookup_join(left, names, "k")
        found = joined.groupBy((F.col("v") == F.upper("k")).alias("hit"), F.col("k").isNull().alias("none")).count()
        assert as_set(found) == {(True, False, 40000), (None, True, 20000)}
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(0, 10000, 1, 4).select(F.lit(None).cast("string").alias("k"), "id")
    right = spark.createDataFrame([("a", 1)], "k string, v int")
    keyed = joins.lookup_join(left, right.hint("merge"), "k")
    assert keyed.where("v is null").count() == 10000
    assert "coalesce(k" in plan(keyed, "extended")


def test_publications_are_written_by_the_tasks_that_have_their_rows(spark, tmp_path):
    rows = spark.range(40).repartition(4).select(
        F.lit("ipdc_hospital").alias("dataset"), F.lit("2001").alias("year_key"), F.col("id").cast("string").alias("Total")
    )
    tables.write_publication(rows, str(tmp_path))
    assert len(list(tmp_path.glob("dataset=ipdc_hospital/year_key=2001/published=*/*.csv"))) == 4


def test_lines_are_read_in_small_tasks_only_while_they_are_published(spark, monkeypatch, tmp_path):
    name, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    monkeypatch.setattr(tables, "published", lambda lines: dict.fromkeys((WIDE, WIDE_SPECIALTY, LONG, LONG_EARLY), lines))
    monkeypatch.setattr(tables, "write_publication", lambda rows, landing: seen.append(spark.conf.get(name)))
    tables.write_all_publications(spark.createDataFrame([], "dataset string, year_key string"), str(tmp_path))
    assert set(seen) == {"8m"} and spark.conf.get(name) == before


def test_attributes_are_moved_once(spark):
    long = spark.createDataFrame([], StructType([*RAW[LONG].fields, *PARTITIONS]))
    wide = spark.createDataFrame([], StructType([*RAW[WIDE].fields, *PARTITIONS]))
    shown = plan(unify_attributes({WIDE: wide, LONG: long}), "extended").split("== Optimized Logical Plan ==")[1]
    assert shown.split("== Physical Plan ==")[0].count("Aggregate [") == 1
