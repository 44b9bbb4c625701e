"""Figures of the archived 2026 publications.

Point STOCKTIDE_ARCHIVE at a landing folder (`dataset=D/year_key=Y/published=P/*.csv`) that holds the
2026 inpatient hospital file, the inpatient specialty files and the outpatient specialty file.
"""

import os
from datetime import date

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from stocktide.fixed_values import WIDE, WIDE_BANDS, WIDE_SPECIALTY
from stocktide.functions.cells import parse_count
from stocktide.operators import clean, quality
from stocktide.operators.reshape import wide_to_long
from stocktide.operators.star import observations
from stocktide.plans import publish, queries
from stocktide.plans.harmonise import unify_store
from stocktide.plans.warehouse import build_warehouse
from stocktide.sources import raw_store

ARCHIVE = os.environ.get("STOCKTIDE_ARCHIVE")
pytestmark = pytest.mark.skipif(not ARCHIVE, reason="STOCKTIDE_ARCHIVE is not set")
LATEST = date(2026, 6, 25)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("archive") / "raw")
    assert raw_store.ingest(spark, ARCHIVE, folder).count() == 0
    return folder


@pytest.fixture(scope="module")
def names(spark, raw):
    return observations(unify_store(spark, raw)).persist()


def test_national_inpatient_adults(names):
    point = queries.national_series(names).where(
        (F.col("archive_date") == F.lit(LATEST)) & (F.col("adult_child") == "Adult")
    )
    assert as_set(point, "list_type", "under_6", "six_to_12", "twelve_plus", "total") == {
        ("ipdc", 62156, 26546, 19485, 108187)
    }


def test_one_hospital(names):
    trend = queries.hospital_total_trend(queries.restrict(names, hospital="Beaumont Hospital", archive_date=LATEST))
    assert ("Adult", 12536) in as_set(trend, "adult_child", "total_waiting")


def test_a_new_hospital_has_one_point(names):
    made = publish.hospital_documents(names).where("slug = 'north-dublin-surgical-hub'").first()
    populations = made.list_types.ipdc.populations
    assert [tuple(p) for p in populations.Adult.series] == [("2026-06-25", 43, 22, 21, 0)]
    assert populations.Child.series == [] and populations.Child.last_updated is None


def test_specialty_ranking(names):
    top = queries.top_specialties(names)
    first = top.where("list_type = 'ipdc' and adult_child = 'Adult' and rank <= 2")
    assert as_set(first, "specialty_name", "total", "under_6", "six_to_12", "twelve_plus") == {
        ("General Surgery", 18100, 10364, 4459, 3277), ("Orthopaedics", 15364, 9504, 3668, 2192),
    }
    assert as_set(top, "list_type", "adult_child", "n_tracked") == {
        ("ipdc", "Adult", 29), ("ipdc", "Child", 19), ("op", "Adult", 41), ("op", "Child", 33),
    }


def test_published_total_and_bands_differ(spark, raw):
    rows = raw_store.read_raw(spark, raw, WIDE_SPECIALTY).where(
        "dataset = 'op_specialty' and ArchiveDate = '29/01/2026' and Adult_Child = 'Adult'"
    )
    counts = clean.parse_counts(rows, [*WIDE_BANDS, "Total"])
    bands = sum((F.col(f"`{b}`") for b in WIDE_BANDS[1:]), F.col(f"`{WIDE_BANDS[0]}`"))
    row = counts.agg(F.sum("Total").alias("t"), F.sum(bands).alias("b")).first()
    assert (row.t, row.b) == (560219, 560213)
    doubled = quality.duplicate_keys(
        raw_store.read_raw(spark, raw, WIDE_SPECIALTY).where("dataset = 'op_specialty'"),
        ["ArchiveDate", "Adult_Child", "Speciality"],
    )
    assert doubled.count() == 28 and as_set(doubled, "ArchiveDate") == {("29/01/2026",)}


def test_unpivot_and_gaps(spark, raw):
    rows = raw_store.read_raw(spark, raw, WIDE)
    assert rows.count() == 437 and wide_to_long(rows).count() == 1748
    counts = clean.parse_counts(rows, [*WIDE_BANDS, "Total"])
    gaps = quality.band_sum_gaps(counts, WIDE_BANDS, "Total")
    assert gaps.where("difference <> 0").agg(F.sum("n_rows")).first()[0] == 102
    assert gaps.where("abs(difference) > 2").count() == 0
    assert counts.agg(F.sum(parse_count(F.col("Total").cast("string")))).first()[0] > 0


def test_names_are_brought_up_to_date(names):
    found = {r.hospital_name for r in queries.hospital_names(names).collect()}
    assert len(found) == 46
    assert "St. Michael's Hospital Dun Laoghaire" in found
    assert "Cappagh National Orthopaedic Hospital" in found
    assert "St. Michael's Hospital" not in found


def test_irregular_dates(names):
    spring = names.where("archive_date < '2021-08-01'").select("archive_date").distinct()
    assert as_set(spring) == {(date(2021, 4, 29),), (date(2021, 5, 13),), (date(2021, 7, 29),)}


def test_star_agrees(spark, raw, names, tmp_path):
    star = build_warehouse(unify_store(spark, raw), str(tmp_path / "warehouse"))
    by = ["list_type", "adult_child", "archive_date", "total"]
    assert as_set(queries.star_national_series(star), *by) == as_set(queries.national_series(names), *by)
