"""Profiles kept as sketches that merge."""

import datetime
import shutil

from helpers import as_set
from pyspark.sql import functions as F
from test_sources import WIDE_HEADER, land

from stocktide.operators.quality import column_profile
from stocktide.sources import profiles, raw_store

ODD = (
    "k string, t string, b binary, d double, f float, n decimal(10,2), at timestamp, yes boolean, "
    "a array<string>, s struct<x: string, y: int>, `a.b` bigint"
)


def odd_rows(spark):
    day = datetime.datetime(2026, 1, 1)
    return spark.createDataFrame(
        [
            ("p", "", b"", 0.0, 0.0, None, day, True, ["a, b"], ("x", None), 1),
            ("p", "", b"\0", -0.0, -0.0, None, day, False, ["a", "b"], (None, 1), 1),
            ("q", "x", b"", float("nan"), 1.0, None, None, True, [], (None, None), 2),
            ("q", "=", None, float("nan"), 1.5, None, day, None, None, None, None),
            ("q", None, b"=", 1.0, None, None, day, None, ["a, b"], ("x", None), None),
        ],
        ODD,
    )


def test_estimates_of_few_values_are_exact_for_every_type(spark):
    rows = odd_rows(spark)
    exact = as_set(column_profile(rows.drop("k")))
    sketches = profiles.column_sketches(rows, "k")
    assert as_set(profiles.merged(sketches), "column_name", "column_type", "n_rows", "n_present", "n_distinct") == exact
    assert as_set(profiles.merged(profiles.column_sketches(rows.drop("k")))) == exact


def test_no_rows(spark):
    none = odd_rows(spark).where("false")
    assert profiles.column_sketches(none, "k").isEmpty() and profiles.merged(profiles.column_sketches(none, "k")).isEmpty()
    assert {r.n_distinct for r in profiles.merged(profiles.column_sketches(none)).collect()} == {0}


def test_many_values_merge_within_the_error(spark):
    """200,000 values, half of them in each of four overlapping parts, a third of all rows in one part."""
    rows = spark.range(200_000).select(
        F.explode(F.array(F.lit(0), F.lit(0), (F.col("id") % 3).cast("int") + 1)).alias("part"), F.col("id").cast("string")
    )
    (row,) = profiles.merged(profiles.column_sketches(rows, "part")).collect()
    assert row.n_rows == 600_000 and abs(row.n_distinct - 200_000) < 200_000 * 0.04
    by_part = {r.part: r.n_distinct for r in profiles.merged(profiles.column_sketches(rows, "part"), "part").collect()}
    assert abs(by_part[0] - 200_000) < 8_000 and all(abs(by_part[i] - 66_667) < 2_700 for i in (1, 2, 3))


def test_refresh_reads_changed_years_only(spark, tmp_path):
    landed, raw, at = (str(tmp_path / n) for n in ("landing", "raw", "profiles"))

    def line(hospital):
        return f"29/01/2026,Adult,{hospital},1,2,3,4,10"

    def load():
        assert raw_store.ingest(spark, landed, raw).isEmpty()
        return profiles.refresh(spark, raw, at)

    def hospitals(*keys):
        return as_set(
            profiles.profile(spark, at, *keys).where("column_name = 'HospitalName'"), *keys, "n_rows", "n_distinct"
        )

    assert profiles.refresh(spark, raw, at) == [] and profiles.profile(spark, at).isEmpty()
    for year, names in (("2024", "AB"), ("2025", "BC")):
        land(landed, "ipdc_hospital", year, "2026-07-01", WIDE_HEADER, [line(n) for n in names])
    assert load() == [("ipdc_hospital", "2024"), ("ipdc_hospital", "2025")]
    assert hospitals() == {(4, 3)} and load() == []
    # What is not read again may as well be gone.
    shutil.rmtree(f"{raw}/wide/dataset=ipdc_hospital/year_key=2024")
    land(landed, "ipdc_hospital", "2025", "2026-08-01", WIDE_HEADER, [line(n) for n in "CDE"])
    land(landed, "op_hospital", "2026", "2026-08-01", WIDE_HEADER, [line("A")])
    assert load() == [("ipdc_hospital", "2025"), ("op_hospital", "2026")]
    assert hospitals() == {(6, 5)}
    assert hospitals("dataset") == {("ipdc_hospital", 5, 5), ("op_hospital", 1, 1)}
    assert hospitals("year_key") == {("2024", 2, 2), ("2025", 3, 3), ("2026", 1, 1)}
    assert profiles.read_sketches(spark, at).where("column_name like '\\\\_%'").isEmpty()
