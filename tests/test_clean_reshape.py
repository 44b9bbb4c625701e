import re
from datetime import date

import pytest
from helpers import as_set, unified
from pyspark.sql import functions as F

from stocktide.fixed_values import WIDE_BANDS
from stocktide.functions.cells import parse_count
from stocktide.operators import clean, joins, reshape

WIDE_HEADER = ["ArchiveDate", "Adult_Child", "HospitalName", *WIDE_BANDS, "Total", "dataset", "year_key"]


def wide(spark, rows, header=WIDE_HEADER):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))


def test_numeric_columns_by_share(spark):
    rows = [(str(i), f"{i},000" if i else "x", "a", None) for i in range(10)]
    rows += [(str(i), "7", "b", None) for i in range(10)]
    frame = spark.createDataFrame(rows, "all string, most string, none string, empty string")
    nine = spark.createDataFrame([(str(i) if i else "x",) for i in range(10)], "c string")
    report = {r.column_name: r for r in clean.numeric_report(frame).collect()}
    assert report["all"].is_numeric and report["most"].is_numeric
    assert report["most"].cells_lost == 1
    assert not report["none"].is_numeric and not report["empty"].is_numeric
    assert not clean.numeric_report(nine).first().is_numeric  # exactly nine in ten
    converted = clean.auto_numeric(frame)
    assert dict(converted.dtypes) == {"all": "bigint", "most": "bigint", "none": "string", "empty": "string"}
    assert converted.where("most is null").count() == 1
    assert clean.auto_numeric(nine).dtypes == [("c", "string")]


def test_missing_cells_count_against_a_column(spark):
    frame = spark.createDataFrame([("1,000",), (None,), ("2",)], "c string")
    assert not clean.numeric_report(frame).first().is_numeric
    plain = spark.createDataFrame([("1",), (None,), ("2.5",)], "c string")
    assert clean.auto_numeric(plain).dtypes == [("c", "double")]


def test_wide_table(spark):
    frame = wide(spark, [("9/1/2026", "Adult", "A", "5,434", " 1 ", "<5", None, "5,435", "d", "2026")])
    row = clean.wide_table(frame.withColumnRenamed("dataset", "Extra-Col Name")).first()
    assert row.archive_date == date(2026, 1, 9)
    assert (row.months_0_6, row.months_6_12, row.months_12_18, row.months_18_plus, row.total) == (
        5434, 1, None, None, 5435,
    )
    assert row.extra_col_name == "d"


def test_two_spellings_feed_one_column(spark):
    frame = spark.createDataFrame(
        [("1", None), (None, "2"), ("3", "4")], "Specialty_HIPE string, Specialty_HIPE1 string"
    )
    merged = clean.merge_headers(frame)
    assert [r.specialty_hipe for r in merged.collect()] == ["1", "2", "3"]
    assert merged.columns.count("specialty_hipe") == 1


def test_conform_adds_and_drops(spark):
    made = clean.conform(spark.createDataFrame([("A", "x")], "hospital_name string, Age_Profile string"))
    assert made.columns[:4] == ["archive_date", "hospital_group", "hospital_hipe", "hospital_name"]
    assert dict(made.dtypes)["count"] == "bigint" and "Age_Profile" not in made.columns


def test_aliases_by_join_equal_aliases_by_table(spark):
    table = {"old": "new", "older": "old"}
    names = spark.createDataFrame([("old",), ("older",), ("x",), (None,)], "hospital_name string")
    frame = spark.createDataFrame(list(table.items()), "alias string, canonical string")
    by_table = sorted(map(str, clean.canonical_names(names, table).collect()))
    assert by_table == sorted(map(str, clean.canonical_names(names, frame).collect()))
    assert as_set(clean.canonical_names(names, frame)) == {("new",), ("old",), ("x",), (None,)}


def test_wide_to_long_over_present_bands(spark):
    rows = [("29/01/2026", "Adult", "A", "1", "2", "3", "4", "10", "ipdc_hospital", "2026")]
    long = reshape.wide_to_long(wide(spark, rows))
    assert as_set(long, "time_band", "count") == set(zip(WIDE_BANDS, (1, 2, 3, 4)))
    assert as_set(long, "granularity", "list_type", "source_year_key", "specialty_name") == {
        ("hospital", "ipdc", "2026", None)
    }
    fewer = reshape.wide_to_long(wide(spark, rows).drop(WIDE_BANDS[2]))
    assert fewer.count() == 3


SPECIALTY_HEADER = [h.replace("HospitalName", "Speciality") for h in WIDE_HEADER]


def test_unlabelled_parts_are_summed_for_op_only(spark):
    def row(specialty, first, dataset):
        return ("29/01/2026", "Adult", specialty, first, None, None, "0", "1", dataset, "2026")

    rows = [
        row("X", "979", "op_specialty"), row("X", "4,402", "op_specialty"),
        row(None, "5", "op_specialty"),
        row("X", "1", "ipdc_specialty"), row("X", "2", "ipdc_specialty"),
    ]
    long = reshape.wide_specialty_to_long(wide(spark, rows, SPECIALTY_HEADER))
    first = long.where(F.col("time_band") == WIDE_BANDS[0])
    found = sorted((r.list_type, r["count"]) for r in first.collect())
    assert found == [("ipdc", 1), ("ipdc", 2), ("op", 5381)]
    # All parts missing: summed to 0 for op, left missing otherwise.
    second = long.where(F.col("time_band") == WIDE_BANDS[1])
    assert sorted((r.list_type, r["count"]) for r in second.fillna(-1, ["count"]).collect()) == [
        ("ipdc", -1), ("ipdc", -1), ("op", 0),
    ]


def test_long_rows(spark):
    early = spark.createDataFrame(
        [("2016-01-29", "G", "1", "H", "2", "S", "Day Case", "Adult", "0-3 Months", "1,000", "ipdc_hospital", "2016")],
        "`Archive Date` string, `Group` string, `Hospital HIPE` string, Hospital string, `Specialty HIPE` string, "
        "Speciality string, `Case Type` string, `Adult/Child` string, `Time Bands` string, Count string, "
        "dataset string, year_key string",
    )
    row = reshape.long_rows(early).first()
    assert (row.archive_date, row.hospital_name, row.specialty_name, row.case_type, row["count"]) == (
        "2016-01-29", "H", "S", "Day Case", 1000,
    )
    outpatient = early.drop("Case Type").withColumn("dataset", F.lit("op_hospital"))
    row = reshape.long_rows(outpatient).first()
    assert row.case_type is None and row.list_type == "op" and row.granularity == "hospital_specialty"


def test_union_keeps_every_row(spark):
    a = unified(spark, [("2026-01-29", "A", None, "Adult", "0-6 Months", 1, "hospital", "ipdc")])
    both = reshape.union_all([a, a.drop("case_type"), a])
    assert both.count() == 3 and both.columns == a.columns


def test_empty_input_is_refused(spark):
    with pytest.raises(ValueError):
        clean.require_rows(spark.createDataFrame([], "a string"))


def test_an_alias_with_two_names_is_an_error(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "hospital_name string, n int")
    twice = spark.createDataFrame([("a", "x"), ("a", "x")], "alias string, canonical string")
    assert as_set(clean.canonical_names(rows, twice)) == {("x", 1), ("b", 2)}
    other = spark.createDataFrame([("a", "x"), ("a", "y")], "alias string, canonical string")
    with pytest.raises(Exception, match="alias with more than one name: a"):
        clean.canonical_names(rows, other).collect()


def test_register_keeps_the_first_entry_whatever_the_order(spark):
    register = spark.createDataFrame([("k", "2020", "CC0")], "dataset_id string, added string, licence string")
    entries = [("a", "2022", "none"), ("a", "2021", "CC-BY"), ("a", "2021", "zz"), ("k", "2019", "x"), ("b", "1", "y")]
    want = {("k", "2020", "CC0"), ("a", "2021", "CC-BY"), ("b", "1", "y")}
    for rows in (entries, entries[::-1]):
        frame = spark.createDataFrame(rows, register.schema)
        assert as_set(joins.append_missing(register, frame)) == want
        assert as_set(joins.conflicting_entries(frame)) == {("a", 3)}


def test_code_that_reads_counts_is_short_enough_to_be_compiled(spark, capsys):
    """The JVM never compiles a method of more than 8,000 bytes."""
    cells = spark.range(3).select(F.col("id").cast("string").alias("cell"))
    cells.select(parse_count(F.col("cell")).alias("n")).explain(mode="codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 4000
