import json
from datetime import date

import pytest
from helpers import as_set, facts
from pyspark.sql import functions as F

from stocktide.fixed_values import HOSPITAL_ALIASES, METADATA_REQUIRED
from stocktide.operators import analysis, governance, joins, quality


def test_column_profile(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "n long, t string")
    assert as_set(quality.column_profile(frame)) == {
        ("n", "bigint", 3, 3, 2), ("t", "string", 3, 2, 1),
    }
    estimated = quality.column_profile(frame, 0.05)
    assert as_set(estimated, "column_name", "n_distinct") == {("n", 2), ("t", 1)}


def test_markers(spark):
    frame = spark.createDataFrame([("SMALL Volume X", 1), ("<5", 2), (None, 3)], "t string, n int")
    assert as_set(quality.marker_scan(frame)) == {("t", 2, True), ("n", 0, False)}
    assert quality.marker_found(frame).first().marker_found
    assert not quality.marker_found(frame.select("n")).first().marker_found
    assert not quality.marker_found(frame.where("false")).first().marker_found


def test_reconcile_keeps_one_sided_keys(spark):
    left = spark.createDataFrame([("a", 10), ("a", 5), ("b", 1)], "k string, count long")
    right = spark.createDataFrame([("a", 14), ("c", 2)], "k string, count long")
    found = as_set(quality.reconcile(left, right, ["k"], tolerance=1))
    assert found == {("a", 15, 14, 1, True), ("b", 1, None, None, False), ("c", None, 2, None, False)}
    assert not quality.reconcile(left, right, ["k"]).where("k = 'a'").first().agrees


def test_band_sum_gaps(spark):
    frame = spark.createDataFrame([(1, 2, 3), (1, None, 2), (5, 5, 10)], "`a b` long, b long, total long")
    assert as_set(quality.band_sum_gaps(frame, ["a b", "b"], "total")) == {(0, 2), (1, 1)}


def test_duplicate_keys(spark):
    frame = spark.createDataFrame([("x", 1), ("x", 1), ("y", 1)], "k string, n int")
    assert as_set(quality.duplicate_keys(frame, ["k", "n"])) == {("x", 1, 2)}


def test_alias_candidates_against_pairs(spark):
    """Groups by fingerprint hold exactly the pairs a comparison of all pairs would find."""
    names = ["Mayo General Hospital", "Mayo University Hospital", "Kerry General Hospital",
             "University Hospital Kerry", "Mercy University Hospital", "Cork  Hospital", "Cork Hospital ",
             "St. James's Hospital", "St James Hospital"]
    frame = spark.createDataFrame([(n,) for n in [*names, names[0]]] + [(None,)], "hospital_name string")
    found = quality.alias_candidates(frame).collect()
    groups = {}
    for row in found:
        groups.setdefault(row.fingerprint, set()).add(row.name)
        assert row.first_name == min(n for n in names if n in {r.name for r in found if r.fingerprint == row.fingerprint})

    def key(name):
        words = "".join(c if c.isalnum() else " " for c in name.lower().replace("'", "")).split()
        words = {w[:-1] if w.endswith("s") and len(w) > 3 else w for w in words}
        return tuple(sorted(words - {"general", "hospital", "regional", "the", "university"}))

    expected = {}
    for name in names:
        expected.setdefault(key(name), set()).add(name)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_contamination(spark):
    rows = [("2026-06-25", "A", None, "Adult", "0-6 Months", 12536, "hospital", "ipdc"),
            ("2026-06-25", "A", None, "Adult", "0-6 Months", 56854, "hospital", "op")]
    row = quality.list_type_contamination(facts(spark, rows), ["hospital_name"]).first()
    assert (row.ipdc_total, row.op_total, row.mixed_total) == (12536, 56854, 69390)


def test_small_cells(spark):
    frame = spark.createDataFrame([(0, 4), (5, None), (1, 3)], "a long, b long")
    assert as_set(quality.suppress_small(frame, ["a", "b"])) == {
        (0, None, 1), (5, None, 0), (None, None, 2),
    }
    rows = spark.createDataFrame([("x", 3), ("y", 4), ("z", 30), ("z", 1)], "e string, count long")
    assert as_set(quality.bucket_small(rows, "e", [], "Small", 20)) == {("Small", 7), ("z", 31)}


# ---- governance ------------------------------------------------------------------------------


def record(**changes):
    made = {name: "x" for name in METADATA_REQUIRED}
    made |= {
        "dataset_id": "some-set-1", "variables": ["a"], "geography_level": "county",
        "redistribution_allowed": True, "small_cell_suppression_applied": False,
        "download_date": "2026-08-11", "processing_date": "2026-08-11",
    }
    made |= changes
    return json.dumps({k: v for k, v in made.items() if v is not ...})


@pytest.mark.parametrize(
    "text, missing, undeclared, out_of_rule",
    [
        (record(), [], [], []),
        (record(licence=..., owner=...), ["licence", "owner"], [], []),
        (record(colour="red"), [], ["colour"], []),
        (record(quality_notes="ok", known_limitations="ok"), [], [], []),
        (record(dataset_id="Some Set"), [], [], ["dataset_id"]),
        (record(geography_level="planet", variables=[]), [], [], ["geography_level", "variables"]),
        (record(redistribution_allowed="yes", download_date="2026-02-30"), [], [],
         ["redistribution_allowed", "download_date"]),
        ("not json", sorted(METADATA_REQUIRED), [], []),
    ],
)
def test_metadata_check(spark, text, missing, undeclared, out_of_rule):
    frame = spark.createDataFrame([(text,)], "record string")
    row = governance.check_metadata(frame).first()
    assert (row.missing, row.undeclared, row.out_of_rule) == (missing, undeclared, out_of_rule)
    assert row.is_complete == (not missing and not undeclared)


def test_metadata_record_is_complete(spark):
    frame = spark.createDataFrame([(1, "a")], "count long, name string")
    profile = quality.column_profile(frame).withColumn(
        "position", F.when(F.col("column_name") == "count", 0).otherwise(1)
    )
    constants = {
        name: "hospital" if name == "geography_level" else "text"
        for name in METADATA_REQUIRED
        if name not in ("variables", "download_date", "processing_date", "redistribution_allowed",
                        "small_cell_suppression_applied")
    }
    made = governance.metadata_record(profile, constants, F.lit(False)).withColumn(
        "redistribution_allowed", F.lit(True)
    )
    assert made.first().variables == ["count", "name"]
    texts = made.select(F.to_json(F.struct(*made.columns)).alias("record"))
    row = governance.check_metadata(texts).first()
    assert row.is_complete and row.out_of_rule == []
    entry = governance.register_entry(made).first()
    assert entry.added == made.first().download_date and entry.source == "text"


def test_register_append_is_idempotent(spark):
    schema = "dataset_id string, added string"
    register = spark.createDataFrame([("a", "1")], schema)
    entries = spark.createDataFrame([("a", "2"), ("ab", "2"), ("ab", "2")], schema)
    once = joins.append_missing(register, entries)
    assert as_set(once) == {("a", "1"), ("ab", "2")}
    assert joins.append_missing(once, entries).count() == 2


def test_publish_gate_and_indicators(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "dataset_id string")
    checked = spark.createDataFrame(
        [("a", True), ("b", False), ("c", True)], "dataset_id string, is_complete boolean"
    )
    register = spark.createDataFrame([("a",), ("b",)], "dataset_id string")
    allowed, held = governance.publishable(ids, checked, register)
    assert as_set(allowed) == {("a",)}
    assert as_set(held) == {("b", False, True), ("c", True, False), ("d", False, False)}
    indicators = spark.createDataFrame(
        [("i", ["a"]), ("j", ["a", "b", "a"]), ("k", []), ("l", None)],
        "indicator_id string, depends_on array<string>",
    )
    assert as_set(governance.ready_indicators(indicators, allowed)) == {
        ("i", 1, 1, True), ("j", 2, 1, False), ("k", 0, 0, True), ("l", 0, 0, True),
    }


def test_lookup_join_of_other_types_keeps_rows_without_a_key(spark):
    left = spark.sql("SELECT * FROM VALUES (DATE'2026-01-01', 1), (NULL, 2), (NULL, 3), (DATE'2027-01-01', 4) AS t(k, n)")
    right = spark.sql("SELECT DATE'2026-01-01' AS k, 'x' AS v")
    found = joins.lookup_join(left, right, "k")
    assert found.columns == ["k", "n", "v"]
    assert as_set(found, "n", "v") == {(1, "x"), (2, None), (3, None), (4, None)}


def test_lookup_join_keeps_rows_without_a_key(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, n int")
    right = spark.createDataFrame([("a", "hit")], "k string, v string")
    assert as_set(joins.lookup_join(left, right, "k"), "k", "n", "v") == {
        ("a", 1, "hit"), (None, 2, None), ("z", 3, None),
    }
    by_id = joins.lookup_join(
        spark.createDataFrame([(1, "x"), (None, "y")], "id long, n string"),
        spark.createDataFrame([(1, "one")], "id long, name string"),
        "id",
    )
    assert as_set(by_id, "id", "n", "name") == {(1, "x", "one"), (None, "y", None)}


# ---- findings --------------------------------------------------------------------------------

SERIES = [("A", date(2026, m, 1), total, under, long, lt) for lt, m, total, under, long in (
    ("ipdc", 1, 10, 9, 1), ("ipdc", 2, 30, 9, 21), ("ipdc", 3, 20, 9, 11), ("ipdc", 4, 30, 20, 10),
    ("ipdc", 5, 31, 30, 1), ("op", 4, 100, 100, 0), ("op", 6, 5, 5, 0))]


@pytest.fixture(scope="module")
def series(spark):
    schema = "hospital_name string, archive_date date, total long, under_6 long, twelve_plus long, list_type string"
    return spark.createDataFrame(SERIES, schema)


def test_record_high(series):
    row = analysis.record_high(series.where("list_type = 'ipdc'"), ["hospital_name"]).first()
    assert (row.latest_value, row.previous_peak, row.previous_peak_date, row.is_record) == (
        31, 30, date(2026, 2, 1), True,
    )
    alone = analysis.record_high(series.where("archive_date = '2026-06-01'"), ["hospital_name"]).first()
    assert alone.is_record and alone.previous_peak is None


def test_turning_points(series):
    found = analysis.turning_points(series.where("list_type = 'ipdc'"), ["hospital_name"])
    assert as_set(found, "archive_date", "kind") == {
        (date(2026, 2, 1), "peak"), (date(2026, 3, 1), "trough"),
    }


def test_growth_inversions_and_ratio(series):
    ipdc = series.where("list_type = 'ipdc'")
    row = analysis.growth(ipdc, ["hospital_name"]).first()
    assert (row.first_value, row.last_value, row.lowest, row.highest, row.percent_of_first) == (
        10, 31, 10, 31, 310,
    )
    assert as_set(analysis.inversions(series, ["hospital_name"])) == {
        ("A", date(2026, 2, 1), date(2026, 3, 1), 2)
    }
    assert as_set(analysis.list_type_ratio(series, ["archive_date"])) == {
        (date(2026, 4, 1), 30, 100, 333)
    }


def test_words_find_renames_that_share_one(spark):
    """All known renames but the mergers, whose new name shares no telling word, are found."""
    names = sorted({*HOSPITAL_ALIASES, *HOSPITAL_ALIASES.values()})
    frame = spark.createDataFrame([(n,) for n in [*names, names[0]]] + [(None,)], "hospital_name string")
    found = {frozenset((r.name, r.first_name)) for r in quality.alias_candidates_by_word(frame).collect()}
    found |= {frozenset((r.name, r.first_name)) for r in quality.alias_candidates(frame).collect()}
    missed = {old for old, new in HOSPITAL_ALIASES.items() if frozenset((old, new)) not in found}
    mergers = {old for old, new in HOSPITAL_ALIASES.items() if new == "Children's Health Ireland"}
    assert missed <= mergers and len(HOSPITAL_ALIASES) - len(missed) >= 13


def test_lost_rows(spark):
    rows = [("ipdc", "Adult", 1, 5), ("ipdc", None, None, None), ("odd", "Child", 1, 2), (None, "Adult", 1, 3)]
    frame = spark.createDataFrame(
        rows, "list_type string, adult_child string, archive_date_parsed int, count bigint"
    ).withColumn("y", F.lit("2020"))
    assert as_set(quality.lost_rows(frame, ["y"])) == {("2020", 4, 2, 1, 1, 1)}
