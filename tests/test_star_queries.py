from datetime import date

import pytest
from helpers import as_set, facts, unified
from pyspark.sql import functions as F

from stocktide.operators import star
from stocktide.operators.totals import bucket_pivot, bucket_totals
from stocktide.plans import publish, queries, warehouse
from stocktide.plans.warehouse import build_warehouse
from stocktide.sources import warehouse_store
from stocktide.sources.warehouse_store import table_counts

JAN, JUN, JUL = "2026-01-29", "2026-06-25", "2026-07-30"
ROWS = [
    (JAN, "A", None, "Adult", "0-6 Months", 10, "hospital", "ipdc"),
    (JAN, "A", None, "Adult", "18 Months +", 5, "hospital", "ipdc"),
    (JAN, "A", None, "Adult", "Over a year", 100, "hospital", "ipdc"),
    (JAN, "A", None, "Adult", "0-6 Months", 70, "hospital", "op"),
    (JUN, "A", None, "Adult", "0-6 Months", 20, "hospital", "ipdc"),
    (JUN, "A", None, "Adult", "6-12 Months", None, "hospital", "ipdc"),
    (JUN, "B", None, "Child", "6-12 Months", 7, "hospital", "ipdc"),
    (JUN, "O", None, "Adult", " 12+", 3, "hospital", "op"),
    # A suppressed specialty at a real hospital, and a suppressed hospital.
    (JUN, "A", "Small Volume Specialties", "Adult", "0-6 Months", 1000, "hospital_specialty", "ipdc"),
    (JUN, "Small Volume Hospitals", None, "Adult", "0-6 Months", 1000, "hospital", "ipdc"),
    (JUN, "A", "S", "Adult", "0-3 Months", 2, "hospital_specialty", "ipdc"),
    # The same people again by specialty; the inpatient file is a month ahead.
    (JUL, None, "S", "Adult", "0-6 Months", 40, "national_specialty", "ipdc"),
    (JUL, None, "T", "Adult", "0-6 Months", 40, "national_specialty", "ipdc"),
    (JUL, None, "U", "Adult", "12-18 Months", 41, "national_specialty", "ipdc"),
    (JUN, None, "S", "Adult", "0-6 Months", 9, "national_specialty", "op"),
    (JUL, None, "Small Volume Specialities", "Child", "0-6 Months", 8, "national_specialty", "op"),
    # No date; a hospital known by an undated row and by an unknown band only.
    (None, "Undated", None, "Adult", "0-6 Months", 1, "hospital", "ipdc"),
    (JUN, "Odd", None, "Adult", "?", 1, "hospital", "ipdc"),
]


@pytest.fixture(scope="module")
def names(spark):
    return facts(spark, ROWS).persist()


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    return build_warehouse(unified(spark, ROWS), str(tmp_path_factory.mktemp("warehouse")))


def test_total_trend_keeps_unknown_bands(names):
    trend = queries.restrict(names, hospital="A", adult_child="Adult", list_type="ipdc")
    found = as_set(queries.hospital_total_trend(trend), "archive_date", "total_waiting")
    assert found == {(date(2026, 1, 29), 115), (date(2026, 6, 25), 22)}


def test_total_trend_of_missing_counts_is_missing(spark):
    rows = [(JAN, "A", None, "Adult", "0-6 Months", None, "hospital", "ipdc")]
    assert queries.national_total_trend(facts(spark, rows)).first().total_waiting is None
    assert queries.national_series(facts(spark, rows)).first().total == 0


def test_band_breakdown_drops_and_reports_unknown_bands(names):
    series, unknown = queries.band_breakdown(names, "A")
    assert [tuple(r) for r in series.collect()] == [
        (date(2026, 1, 29), 10, 0, 5), (date(2026, 6, 25), 22, 0, 0),
    ]
    assert as_set(unknown) == {("Over a year", 1)}


def test_national_series_counts_no_one_twice(names):
    found = as_set(
        queries.national_series(names), "list_type", "adult_child", "archive_date", "total"
    )
    assert found == {
        ("ipdc", "Adult", date(2026, 1, 29), 15), ("op", "Adult", date(2026, 1, 29), 70),
        ("ipdc", "Adult", date(2026, 6, 25), 22), ("ipdc", "Child", date(2026, 6, 25), 7),
        ("op", "Adult", date(2026, 6, 25), 3),
    }


def test_national_is_the_sum_of_hospitals(names):
    by = ["list_type", "adult_child", "archive_date"]
    summed = queries.hospital_series(names).groupBy(*by).agg(F.sum("total").alias("total"))
    assert as_set(summed) == as_set(queries.national_series(names), *by, "total")


def test_specialty_trend_uses_specialty_rows_only(names):
    one = queries.restrict(names, specialty="S", adult_child="Adult", list_type="ipdc")
    found = as_set(queries.specialty_trend(one), "archive_date", "total")
    assert found == {(date(2026, 6, 25), 2), (date(2026, 7, 30), 40)}


def test_latest_totals_use_the_one_latest_date(names, spark):
    assert queries.latest_by_list_type(names).count() == 0  # July has no hospital rows
    june = names.where(F.col("archive_date") < F.lit("2026-07-01"))
    assert as_set(queries.latest_by_list_type(june)) == {
        ("ipdc", date(2026, 6, 25), 23), ("op", date(2026, 6, 25), 3),
    }
    no_op = june.where("not (list_type = 'op' and hospital_name = 'O')")
    assert [r.list_type for r in queries.latest_by_list_type(no_op).collect()] == ["ipdc"]


def test_ranking_uses_its_own_latest_date_and_breaks_ties_by_name(names):
    top = queries.top_specialties(names, 2)
    found = as_set(top, "list_type", "adult_child", "rank", "specialty_name", "total", "n_tracked")
    assert found == {
        ("ipdc", "Adult", 1, "U", 41, 3), ("ipdc", "Adult", 2, "S", 40, 3),
        ("op", "Adult", 1, "S", 9, 1),
    }
    # A suppressed row sets the latest date although it is not ranked.
    latest = as_set(queries.latest_dates(names))
    assert ("op", "Child", date(2026, 7, 30)) in latest


def test_hospital_names_need_no_date_and_no_known_band(names):
    found = [r.hospital_name for r in queries.hospital_names(names).collect()]
    assert found == ["A", "B", "O", "Odd", "Undated"]


def test_star_gives_the_same_answers(names, built):
    def same(left, right):
        assert as_set(left, *sorted(left.columns)) == as_set(right, *sorted(left.columns))

    same(queries.hospital_series(names), queries.star_hospital_series(built))
    same(queries.national_series(names), queries.star_national_series(built))
    same(queries.hospital_total_trend(names), queries.star_hospital_total_trend(built))
    same(queries.national_total_trend(names), queries.star_national_total_trend(built))
    same(queries.specialty_trend(names), queries.star_specialty_trend(built))
    same(queries.top_specialties(names, 2), queries.star_top_specialties(built, 2))
    same(queries.hospital_names(names), queries.published_hospitals(built).select("hospital_name"))
    same(queries.latest_by_list_type(names), queries.latest_totals(built))
    same(queries.hospital_series(names), queries.hospital_series(star.star_observations(built)))


def test_one_hospital_of_a_star(names, built):
    one = queries.restrict_star(built, hospital="A", adult_child="Adult", list_type="ipdc")
    found = as_set(queries.star_hospital_total_trend(one), "archive_date", "total_waiting")
    assert found == {(date(2026, 1, 29), 115), (date(2026, 6, 25), 22)}
    condition = one.fact._sc._jvm.PythonSQLUtils.explainString(
        one.fact._jdf.queryExecution(), "formatted"
    )
    assert "EqualTo(hospital_id,1)" in condition
    at = queries.restrict_star(built, specialty="S", archive_date=date(2026, 7, 30))
    assert as_set(queries.star_specialty_trend(at), "specialty_name", "total") == {("S", 40)}
    assert queries.restrict_star(built, hospital="nobody").fact.count() == 0


def test_star_tables(built):
    assert as_set(table_counts(built)) == {
        ("dim_date", 3), ("dim_hospital", 5), ("dim_specialty", 3), ("fact_waiting_list", len(ROWS)),
    }
    assert [r.hospital_id for r in built.dim_hospital.orderBy("hospital_name").collect()] == [1, 2, 3, 4, 5]
    ids = built.fact.select("fact_id").distinct().count()
    assert ids == len(ROWS)
    suppressed = built.fact.where("is_suppressed_bucket and granularity = 'hospital_specialty'").first()
    assert suppressed.hospital_id is not None and suppressed.specialty_id is None
    undated = built.fact.where("date_id is null")
    assert undated.count() == 1


def test_dense_ids_over_many_partitions(spark):
    frame = spark.range(1000).select(F.format_string("n%05d", "id").alias("name")).repartition(7)
    numbered = star.dense_ids(frame, "name", "id").orderBy("id").collect()
    assert [r.id for r in numbered] == list(range(1, 1001))
    assert [r.name for r in numbered] == sorted(r.name for r in numbered)


def test_first_per_key(spark):
    rows = [("A", 2, "late"), ("A", 1, None), ("B", 1, "b"), (None, 1, "x")]
    frame = spark.createDataFrame(rows, "k string, at int, v string")
    assert as_set(star.first_per_key(frame, "k", ("v",), order=("at",))) == {("A", None), ("B", "b")}
    firsts = star.first_per_key(frame, "k", ("v",), order=("at",), skip_nulls=True)
    assert as_set(firsts) == {("A", "late"), ("B", "b")}


def test_pivot_equals_conditional_sums(names):
    rows = names.where("hospital_name is not null and archive_date is not null")
    pivot = bucket_pivot(rows, ["hospital_name", "archive_date"]).toDF("h", "d", "a", "b", "c")
    sums = bucket_totals(rows, ["hospital_name", "archive_date"])
    assert as_set(pivot) == as_set(
        sums, "hospital_name", "archive_date", "under_6", "six_to_12", "twelve_plus"
    )


def test_row_order_does_not_matter(spark, names):
    shuffled = facts(spark, list(reversed(ROWS))).repartition(5)
    assert as_set(queries.hospital_series(shuffled)) == as_set(queries.hospital_series(names))


# ---- documents -------------------------------------------------------------------------------


def test_documents_hold_every_combination(names):
    made = {r.hospital_name: r for r in publish.hospital_documents(names).collect()}
    assert sorted(made) == ["A", "B", "O", "Odd", "Undated"]
    a = made["A"].list_types
    assert [tuple(p) for p in a.ipdc.populations.Adult.series] == [
        ("2026-01-29", 15, 10, 0, 5), ("2026-06-25", 22, 22, 0, 0),
    ]
    assert a.ipdc.populations.Adult.last_updated == "2026-06-25"
    assert a.op.populations.Child.series == [] and a.op.populations.Child.last_updated is None
    assert made["Odd"].list_types.ipdc.populations.Adult.series == []
    assert made["Undated"].slug == "undated"


def test_national_document(names):
    flat = publish.flatten_documents(publish.national_document(names))
    by = ["list_type", "adult_child", "total"]
    assert as_set(flat, *by) == as_set(queries.national_series(names), *by)


def test_specialty_document(names):
    document = publish.specialty_document(names, k=2).first()
    adult = document.list_types.ipdc.populations.Adult
    assert adult.last_updated == "2026-07-30"
    assert [i.specialty_name for i in adult["items"]] == ["U", "S"]
    assert adult.known_limitations == (
        "Showing the 2 largest specialties by current waiting list volume, out of 3 specialties "
        "tracked for this combination."
    )
    empty = document.list_types.op.populations.Child
    assert empty["items"] == [] and empty.last_updated == "2026-07-30"
    assert empty.known_limitations == "No specialty-level data available for this combination."
    none = document.list_types.ipdc.populations.Child
    assert none["items"] == [] and none.last_updated is None


def test_documents_of_nothing(spark, names):
    nothing = names.where("false")
    assert publish.hospital_documents(nothing).count() == 0
    row = publish.national_document(nothing).first()
    assert row.list_types.op.populations.Adult.series == []
    assert publish.specialty_document(nothing).first().list_types.op.populations.Adult["items"] == []


def test_dashboard(names):
    made = publish.hospital_documents(names)
    shown = publish.dashboard_slice(made).collect()
    assert [(r.hospital_name, r.label) for r in shown] == [("A", "Jan 2026"), ("A", "Jun 2026")]
    chosen = publish.dashboard_slice(made, "op", "Adult", "o").collect()
    assert [(r.slug, r.total) for r in chosen] == [("o", 3)]
    line = publish.footer(
        publish.national_document(names), publish.specialty_document(names), "op", "Child"
    ).first()
    assert line.last_updated == "n/a"
    assert line.known_limitations.endswith("No specialty-level data available for this combination.")


def test_a_build_that_fails_leaves_the_last_one_in_place(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "w")
    before = build_warehouse(unified(spark, ROWS), at).dim_hospital.orderBy("hospital_id").collect()

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(warehouse, "build_fact", broken)
    fewer = unified(spark, ROWS).where("hospital_name <> 'A'")
    with pytest.raises(RuntimeError):
        build_warehouse(fewer, at)
    star = warehouse_store.read_star(spark, at)
    assert star.dim_hospital.orderBy("hospital_id").collect() == before
    assert star.fact.count() > 0
    monkeypatch.undo()
    assert build_warehouse(fewer, at).dim_hospital.where("hospital_name = 'A'").count() == 0


def test_fact_rows_joins_the_lines_once(spark, sf_dir):
    """Its dimensions and facts read the joined rows as they were written, not the tables again."""
    from workload import on_star

    assert not [path for path in on_star.fact_rows(spark, sf_dir).inputFiles() if "lineitem" in path]


def test_attributes_do_not_pair_hospitals_with_specialties(spark):
    """A row per entity and snapshot, where there was one for each pair; the dimensions stay the same."""
    from stocktide.operators import star

    pairs = [
        (date(2000, 1, 9), f"h{h}", f"g{h}", f"{h}", f"s{s}", f"{s}", "op", "2000", h == 0 and s == 0)
        for h in range(20) for s in range(20)
    ]
    pairs += [(date(2000, 4, 9), None, None, None, "s1", "9", "op", "2000", False), (None, "h1", "g", "1", None, None, "ipdc", "1999", False)]
    kinds = "archive_date_parsed date, " + ", ".join(f"{c} string" for c in star.ATTRIBUTES[1:-1]) + ", is_suppressed_bucket boolean"
    rows = spark.createDataFrame(pairs, kinds)
    apart = star.by_entity(rows)
    assert apart.columns == list(star.ATTRIBUTES) and apart.count() == 20 + 20 + 2 + 2
    for build in (star.build_dim_date, star.build_dim_hospital, star.build_dim_specialty):
        assert sorted(map(tuple, build(apart).collect())) == sorted(map(tuple, build(rows).collect()))
        if build is not star.build_dim_date:
            both = [sorted(map(tuple, build(r, skip_nulls=True).collect())) for r in (apart, rows)]
            assert both[0] == both[1]
