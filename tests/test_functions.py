from datetime import date

import pytest
from helpers import column
from pyspark.sql import functions as F

from stocktide.fixed_values import BUCKETS, WIDE_BANDS, WIDE_TABLE_NAMES
from stocktide.functions import bands, cells, dates, headers, names


def one(spark, values, expression, kind="string"):
    frame = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return column(frame.select(expression(F.col("c")).alias("out")))


def test_counts(spark):
    values = ["5,434", " 12 ", "", "<5", "N/A", "1d", "nan", "1e3", "12.5", "12.0", "-3", None, "inf",
              "9007199254740993", "99999999999999999999", "1_000", "٣"]
    expected = [5434, 12, None, None, None, None, None, 1000, None, 12, -3, None, None,
                9007199254740993, None, None, None]
    assert one(spark, values, cells.parse_count) == expected


def test_counts_with_exponents_and_long_fractions(spark):
    zeros = "0" * 40
    values = ["1200e-02", "1250e-2", "1e-5", "0e99999999999", "-12.5e1", "+.5E1", "5.e0", "00012.000",
              f"12{zeros}e-40", f"1.{zeros}1", f"1.{zeros}", "9223372036854775807.0", "9223372036854775808.0",
              "1e400", "1e99999999999", "-0.0", ".", "e5", "922337203685477580.7e1", "1,200e-2"]
    expected = [12, None, None, 0, -125, 5, 5, 12, 12, None, 1, 2**63 - 1, None, None, None, 0, None, None,
                2**63 - 1, 12]
    assert one(spark, values, cells.parse_count) == expected


def test_numbers(spark):
    values = ["1,234.5", "1e3", ".5", "5.", "1d", "nan", "", "+7", "1 2"]
    assert one(spark, values, cells.parse_number) == [1234.5, 1000.0, 0.5, 5.0, None, None, None, 7.0, None]


def test_missing_markers(spark):
    values = ["", "NA", "N/A", "null", "None", "nan", "Small Volume", " ", "na"]
    assert one(spark, values, cells.present) == [None] * 6 + ["Small Volume", " ", "na"]


def test_dates(spark):
    values = ["29/01/2026", "9/1/2026", "2016-01-29", "31/02/2026", "29/01/2026 ", None, "29/1/26",
              "009/01/2026", "2016-1-9", "29-01-2026", "29/02/2024"]
    assert one(spark, values, dates.parse_archive_date) == [
        date(2026, 1, 29), date(2026, 1, 9), date(2016, 1, 29), None, None, None, None, None,
        date(2016, 1, 9), None, date(2024, 2, 29),
    ]
    assert one(spark, values[:3], dates.parse_day_first)[2] is None


def test_date_labels(spark):
    day = [date(2026, 6, 25)]
    assert one(spark, day, dates.month_label, "date") == ["Jun 2026"]
    assert one(spark, day, dates.long_month_label, "date") == ["June 2026"]
    assert one(spark, day, dates.iso_label, "date") == ["2026-06-25"]


@pytest.mark.parametrize(
    "label, bucket",
    [
        (WIDE_BANDS[0], 0), (WIDE_BANDS[1], 1), (WIDE_BANDS[2], 2), (WIDE_BANDS[3], 2),
        ("0-3 Months", 0), ("3-6 Months", 0), (" 6-9 Months", 1), ("9-12 Months", 1),
        ("12+ Months", 2), ("18+ Months", 2), (" 6-9 Months", 1), ("\t5", 0),
        ("000000000000000000000005", 0), ("99999999999999999999999 Months", 2),
        ("Over a year", None), ("> 12", None), ("", None), (None, None), ("Over 18 months", None),
    ],
)
def test_bands(spark, label, bucket):
    expected = "Unknown" if bucket is None else BUCKETS[bucket]
    assert one(spark, [label], bands.classify_band) == [expected]


def test_slugs(spark):
    values = ["St. Michael's Hospital Dun Laoghaire", "National Maternity Hospital (Holles Street)"]
    assert one(spark, values, names.slug) == [
        "st.-michaels-hospital-dun-laoghaire",
        "national-maternity-hospital-(holles-street)",
    ]
    assert one(spark, ["Children's Ward"], names.specialty_slug) == ["children's-ward"]


def test_current_names(spark):
    values = ["Tallaght Hospital", "Cork University Maternity Hospital ", "Elsewhere", None, "tallaght hospital"]
    assert one(spark, values, names.current_name) == [
        "Tallaght University Hospital", "Cork University Maternity Hospital", "Elsewhere", None,
        "tallaght hospital",
    ]


def test_suppression_flag(spark):
    rows = [("Small Volume Hospitals", None), ("A", "Small Volume Specialities"),
            (None, "Small Volume Specialties"), (None, None), ("A", None), ("A", "B")]
    frame = spark.createDataFrame(rows, "h string, s string")
    flag = names.is_suppressed(F.col("h"), F.col("s")).alias("out")
    assert column(frame.select(flag)) == [True, True, True, False, False, False]


def test_fingerprints_join_spellings(spark):
    values = ["Mayo General Hospital", "Mayo University Hospital", "Galway University Hospital",
              "Galway University Hospitals", "Kerry General Hospital", "University Hospital Kerry",
              "National Orthopaedic Hospital Cappagh", "Cappagh National Orthopaedic Hospital",
              "Mercy University Hospital"]
    keys = one(spark, values, names.name_fingerprint)
    assert keys[0] == keys[1] and keys[2] == keys[3] and keys[4] == keys[5] and keys[6] == keys[7]
    assert len(set(keys)) == 5


def test_headers():
    assert headers.clean_headers([" ArchiveDate ", "Total"]) == ["ArchiveDate", "Total"]
    assert headers.snake_headers(["ArchiveDate", "New-Band Name "], WIDE_TABLE_NAMES) == [
        "archive_date",
        "new_band_name",
    ]


def test_family_of_header():
    wide = ["ArchiveDate", "Adult_Child", "HospitalName", *WIDE_BANDS, "Total"]
    assert headers.family_of_header(wide) == "wide"
    assert headers.family_of_header([h.replace("HospitalName", "Speciality") for h in wide]) == "wide_specialty"
    early = ["Archive Date", "Group", "Hospital", "Adult/Child", "Time Bands", "Count"]
    assert headers.family_of_header(early) == "long_early"
    later = ["Archive_Date", "Hospital_Name", "Adult_Child", "Time_Bands", "Total"]
    assert headers.family_of_header(later) == "long"
    assert headers.family_of_header(["a", "b"]) is None
