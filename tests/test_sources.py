import hashlib
import json
from pathlib import Path

import pytest
from helpers import as_set, facts
from pyspark.sql import functions as F

from stocktide.fixed_values import LONG, WIDE
from stocktide.plans import publish, queries
from stocktide.plans.harmonise import unify_store
from stocktide.plans.warehouse import rebuild
from stocktide.sources import catalogue, documents, file_hashes, landing, ledger, raw_store
from stocktide.streaming.ingest import ingest_arrivals

BANDS = "0-6 Months,6-12 Months,12-18 Months,18 Months +"
WIDE_HEADER = f"ArchiveDate,Adult_Child,HospitalName,{BANDS},Total"
SPECIALTY_HEADER = f"ArchiveDate,Adult_Child,Speciality,{BANDS},Total"
LONG_HEADER = (
    "Archive_Date,Hospital_Group,Hospital_HIPE,Hospital_Name,Specialty_HIPE,Specialty_Name,Case_Type,"
    "Adult_Child,Age_Profile,Time_Bands,Total"
)


def land(root, dataset, year, published, header, lines, name="file.csv", bom=True):
    folder = Path(root) / f"dataset={dataset}" / f"year_key={year}" / f"published={published}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "\r\n".join([header, *lines]) + "\r\n"
    (folder / name).write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode())
    return folder / name


@pytest.fixture
def root(tmp_path):
    """One file per shape, as published: byte order mark, CRLF, quoted numbers, missing cells."""
    at = str(tmp_path / "landing")
    land(at, "ipdc_hospital", "2026", "2026-07-01", WIDE_HEADER, [
        '29/01/2026,Adult,Beaumont Hospital,"5,434","3,130","1,577","1,322","11,462"',
        "9/2/2026,Adult,St. Michael's Hospital,1,N/A,,2,3",
        "29/01/2026,Child,Cork University Maternity Hospital ,4,0,0,0,4",
    ])
    land(at, "op_hospital", "2026", "2026-07-01", " ArchiveDate," + WIDE_HEADER.split(",", 1)[1], [
        "29/01/2026,Adult,Beaumont Hospital,7,0,0,0,7",
    ], bom=False)
    land(at, "op_specialty", "2026", "2026-07-01", SPECIALTY_HEADER, [
        "29/01/2026,Adult,Breast Surgery,979,13,0,2,994",
        '29/01/2026,Adult,Breast Surgery,"4,402",107,2,0,"4,511"',
    ])
    land(at, "ipdc_hospital", "2018", "2025-02-01", LONG_HEADER, [
        '31/01/2018,G,1,Tallaght Hospital,10,"Ear, Nose & Throat",Inpatient,Adult,16-64, 6-9 Months,12',
        "31/01/2018,G,1,Tallaght Hospital,11,Small Volume Specialties,Inpatient,Adult,16-64,0-3 Months,3",
    ])
    land(at, "op_hospital", "2021_jan_mar", "2024-10-01",
         LONG_HEADER.replace("Specialty_HIPE", "Specialty_HIPE1").replace("Case_Type,", ""), [
        "28/01/2021,G,1,Tallaght University Hospital,10,Urology,Adult,16-64,18+ Months,5",
    ])
    land(at, "ipdc_hospital", "2016", "2025-02-01",
         "Archive Date,Group,Hospital HIPE,Hospital,Specialty HIPE,Specialty,Case Type,Adult/Child,Time Bands,Count", [
        "2016-01-29,G,1,Tallaght Hospital,10,Urology,Day Case,Adult,0-3 Months,9",
    ])
    land(at, "ipdc_hospital", "1999", "2025-02-01", WIDE_HEADER, ["29/01/1999,Adult,X,1,1,1,1,4"])
    return at


def test_every_shape_from_files_to_answers(spark, root, tmp_path):
    raw = str(tmp_path / "raw")
    unknown = raw_store.ingest(spark, root, raw)
    assert as_set(unknown, "dataset", "year_key") == {("ipdc_hospital", "1999")}
    rows = unify_store(spark, raw)
    found = as_set(rows.where("count > 0"), "hospital_name", "specialty_name", "time_band", "count", "granularity")
    assert {
        ("Beaumont Hospital", None, "0-6 Months", 5434, "hospital"),
        ("St. Michael's Hospital Dun Laoghaire", None, "18 Months +", 2, "hospital"),
        ("Cork University Maternity Hospital", None, "0-6 Months", 4, "hospital"),
        ("Tallaght University Hospital", "Ear, Nose & Throat", " 6-9 Months", 12, "hospital_specialty"),
        ("Tallaght University Hospital", "Urology", "18+ Months", 5, "hospital_specialty"),
        ("Tallaght University Hospital", "Urology", "0-3 Months", 9, "hospital_specialty"),
        (None, "Breast Surgery", "0-6 Months", 5381, "national_specialty"),
    } <= found
    assert rows.where("archive_date_parsed is null").count() == 0
    assert rows.where("is_suppressed_bucket").count() == 1

    star = rebuild(spark, raw, str(tmp_path / "warehouse"))
    national = as_set(queries.star_national_series(star), "list_type", "adult_child", "total")
    assert ("ipdc", "Adult", 12) in national and ("op", "Adult", 5) in national
    hospital = star.dim_hospital.where("hospital_name = 'Tallaght University Hospital'").first()
    assert (hospital.hospital_group, hospital.hospital_hipe) == ("G", "1")


def test_raw_cells_stay_as_published(spark, root, tmp_path):
    raw = str(tmp_path / "raw")
    raw_store.ingest(spark, root, raw)
    rows = raw_store.read_raw(spark, raw, WIDE, lineage=True)
    beaumont = rows.where("HospitalName = 'Beaumont Hospital' and dataset = 'ipdc_hospital'").first()
    assert beaumont["0-6 Months"] == "5,434" and beaumont["Total"] == "11,462"
    assert beaumont["_source_year_key"] == "2026"
    assert beaumont["_source_url"].endswith("/2026/07/OpenData_IPDCNational01.csv")
    assert beaumont["_source_file"].endswith("file.csv") and beaumont["_loaded_date"] is not None
    missing = rows.where("HospitalName like 'St. %'").first()
    assert missing["6-12 Months"] is None and missing["12-18 Months"] is None
    assert not set(raw_store.read_raw(spark, raw, WIDE).columns) & {"_source_url", "_loaded_date"}
    assert raw_store.families_present(spark, raw) == ["wide", "long", "long_early", "wide_specialty"]
    counts = as_set(raw_store.loaded_years(spark, raw), "family", "dataset", "year_key", "n_rows")
    assert (LONG, "ipdc_hospital", "2018", 2) in counts


def test_only_wanted_years_are_loaded(spark, root, tmp_path):
    raw = str(tmp_path / "raw")
    wanted = spark.createDataFrame([("ipdc_hospital", "2018")], "dataset string, year_key string")
    raw_store.ingest(spark, root, raw, wanted)
    assert as_set(raw_store.loaded_years(spark, raw), "dataset", "year_key") == {("ipdc_hospital", "2018")}


GOOD = ["29/01/2026,Adult,X,1,1,1,1,4"]


def land_faults(at):
    """A good year and one of each fault."""
    land(at, "ipdc_hospital", "2026", "2026-07-01", WIDE_HEADER, GOOD)
    land(at, "ipdc_hospital", "2025", "2026-07-01", "a,b,c", ["1,2,3"])
    land(at, "ipdc_hospital", "2024", "2026-07-01", WIDE_HEADER, GOOD)
    land(at, "ipdc_hospital", "2024", "2026-07-01", SPECIALTY_HEADER, GOOD, "b.csv")
    land(at, "op_hospital", "2026", "2026-07-01", WIDE_HEADER, [*GOOD, "29/01/2026,Adult,St John, Cork,1,2,3,4,10"])
    land(at, "op_hospital", "2025", "2026-07-01", WIDE_HEADER, ['29/01/2026,Adult,"St John\nCork",1,2,3,4,10'])
    land(at, "op_hospital", "2024", "2026-07-01", WIDE_HEADER, [])
    land(at, "ipdc_hospital", "1999", "2026-07-01", WIDE_HEADER, GOOD)


FAULTS = {
    ("ipdc_hospital", "2025", landing.MISFIT), ("ipdc_hospital", "2024", landing.MISFIT),
    ("op_hospital", "2026", landing.BAD_ROWS), ("op_hospital", "2025", landing.BAD_ROWS),
    ("op_hospital", "2024", landing.EMPTY), ("ipdc_hospital", "1999", landing.UNKNOWN),
}


def test_faulty_publications_are_left_out_with_a_reason(spark, tmp_path):
    at, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    land_faults(at)
    rejects = raw_store.ingest(spark, at, raw)
    assert as_set(rejects, "dataset", "year_key", "reason") == FAULTS
    assert as_set(raw_store.loaded_years(spark, raw), "dataset", "year_key", "n_rows") == {("ipdc_hospital", "2026", 1)}


def test_bad_rows_can_be_left_out_and_quoted_breaks_read(spark, tmp_path):
    at, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    land_faults(at)
    rejects = raw_store.ingest(spark, at, raw, allow_bad_rows=True, multi_line=True)
    assert {r.reason for r in rejects.where("dataset = 'op_hospital'").collect()} == {landing.EMPTY}
    rows = raw_store.read_raw(spark, raw, WIDE).where("dataset = 'op_hospital'")
    assert as_set(rows, "year_key", "HospitalName", "Total") == {("2026", "X", "4"), ("2025", "St John\nCork", "10")}


def test_an_empty_correction_replaces_nothing(spark, tmp_path):
    at, raw = str(tmp_path / "landing"), str(tmp_path / "raw")
    land(at, "ipdc_hospital", "2026", "2026-07-01", WIDE_HEADER, GOOD)
    assert raw_store.ingest(spark, at, raw).count() == 0
    land(at, "ipdc_hospital", "2026", "2026-08-01", WIDE_HEADER, [])
    assert as_set(raw_store.ingest(spark, at, raw), "published", "reason") == {("2026-08-01", landing.EMPTY)}
    assert raw_store.read_raw(spark, raw, WIDE).count() == 1


def test_a_stream_goes_on_after_a_bad_batch(spark, tmp_path):
    at, raw, state = (str(tmp_path / name) for name in ("landing", "raw", "state"))
    rejects = str(tmp_path / "rejects")

    def run():
        ingest_arrivals(spark, at, raw, state, rejects).awaitTermination()

    land_faults(at)
    run()
    assert as_set(spark.read.parquet(rejects), "dataset", "year_key", "reason") == FAULTS
    land(at, "op_hospital", "2024", "2026-08-01", WIDE_HEADER, GOOD)
    run()
    assert as_set(raw_store.loaded_years(spark, raw), "dataset", "year_key") == {
        ("ipdc_hospital", "2026"), ("op_hospital", "2024"),
    }


def test_an_empty_store_has_no_years(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    assert raw_store.loaded_years(spark, str(tmp_path / "raw")).collect() == []


def test_manifest(spark, root):
    first = land(root, "op_specialty", "2025", "2026-01-01", SPECIALTY_HEADER, ["x,y,z,1,1,1,1,4"])
    land(root, "op_specialty", "2025", "2026-02-01", SPECIALTY_HEADER, ["x,y,z,1,1,1,1,4"])
    entries = landing.manifest(spark, root)
    digest = hashlib.sha256(first.read_bytes()).hexdigest()
    assert {r.published for r in entries.where(F.col("sha256") == digest).collect()} == {
        "2026-01-01", "2026-02-01",
    }
    (duplicate,) = landing.duplicate_files(entries).collect()
    assert (duplicate.sha256, duplicate.copies) == (digest, 2)
    latest = landing.latest_publications(landing.list_files(spark, root))
    folder = latest.where("dataset = 'op_specialty' and year_key = '2025'").first().folder
    assert folder.endswith("published=2026-02-01")


def test_manifest_reads_in_steps_and_goes_on_without_bad_files(spark, tmp_path):
    """Larger than a step, of an odd name, cut off since it was listed, gone, empty, of a name that says compressed."""
    at = str(tmp_path / "landing")
    large = land(at, "op_specialty", "2025", "2026-01-01", "h", ["x" * 700] * 9000, "large one%20é+.csv")
    empty = tmp_path / "empty.csv"
    empty.write_bytes(b"")
    gone = land(at, "op_specialty", "2023", "2026-01-01", "h", ["1"], "gone.csv")
    short = land(at, "op_specialty", "2022", "2026-01-01", "h", ["1"] * 50, "short.csv")
    assert large.stat().st_size > file_hashes.STEP_BYTES
    files = landing.list_files(spark, at).withColumn("extra", F.lit("kept")).checkpoint()
    gone.unlink()
    short.write_bytes(b"h")
    entries = {r.path.rsplit("/", 1)[1]: r for r in file_hashes.hash_files(files).collect()}
    assert entries[large.name].sha256 == hashlib.sha256(large.read_bytes()).hexdigest()
    assert file_hashes.hash_file(f"file:{empty}", 0) == (hashlib.sha256(b"").hexdigest(), None)
    assert (entries["gone.csv"].sha256, entries["gone.csv"].error) == (None, "file is gone")
    assert entries["short.csv"].error.startswith("1 bytes, ")
    assert all((r.sha256 is None) != (r.error is None) and r.extra == "kept" for r in entries.values())
    packed = tmp_path / "a.csv.gz"
    packed.write_bytes(b"not gzip")
    assert file_hashes.hash_file(str(packed), 8, 3) == (hashlib.sha256(b"not gzip").hexdigest(), None)
    told = landing.unreadable_files(file_hashes.hash_files(files))
    assert {r.year_key for r in told.collect()} == {"2023", "2022"}
    assert file_hashes.hash_files(files.where("false")).collect() == []


def test_stream_loads_each_publication_once(spark, root, tmp_path):
    raw, checkpoint, rejects = (str(tmp_path / n) for n in ("raw", "checkpoint", "rejects"))

    def run():
        ingest_arrivals(spark, root, raw, checkpoint, rejects).awaitTermination()

    def written():
        return {p: p.stat().st_mtime_ns for p in Path(raw).rglob("*.parquet")}

    def wide_rows():
        rows = raw_store.read_raw(spark, raw, WIDE)
        return as_set(rows, "dataset", "year_key", "HospitalName", "`0-6 Months`")

    run()
    first, files = wide_rows(), written()
    assert len(first) == 4
    run()
    assert written() == files  # nothing new, nothing written
    land(root, "ipdc_hospital", "2026", "2026-08-01", WIDE_HEADER, ["30/07/2026,Adult,Beaumont Hospital,1,0,0,0,1"])
    run()
    assert wide_rows() == {
        ("ipdc_hospital", "2026", "Beaumont Hospital", "1"),
        ("op_hospital", "2026", "Beaumont Hospital", "7"),
    }
    untouched = {p for p in files if "year_key=2018" in str(p)}
    assert untouched and all(written()[p] == files[p] for p in untouched)
    # An older publication that arrives late does not take the place of the newer one.
    land(root, "ipdc_hospital", "2026", "2026-01-01", WIDE_HEADER, ["1/1/2026,Adult,Old,9,0,0,0,9"])
    run()
    assert ("ipdc_hospital", "2026", "Beaumont Hospital", "1") in wide_rows()
    refused = spark.read.option("recursiveFileLookup", True).parquet(rejects)
    assert as_set(refused, "dataset", "year_key") == {("ipdc_hospital", "1999")}


def test_stream_gives_what_a_batch_load_gives(spark, root, tmp_path):
    batch, streamed = str(tmp_path / "a"), str(tmp_path / "b")
    raw_store.ingest(spark, root, batch)
    ingest_arrivals(spark, root, streamed, str(tmp_path / "c")).awaitTermination()
    assert sorted(map(str, unify_store(spark, batch).collect())) == sorted(
        map(str, unify_store(spark, streamed).collect())
    )


def test_catalogue(spark):
    known = catalogue.catalogue(spark)
    assert known.count() == 36
    by_family = {r.family: r["count"] for r in known.groupBy("family").count().collect()}
    assert by_family == {"wide": 12, "long": 8, "long_early": 4, "wide_specialty": 12}
    wanted = spark.createDataFrame(
        [("op_hospital", "2014"), ("op_hospital", "2018")], "dataset string, year_key string"
    )
    chosen, unknown = catalogue.select_sources(known, wanted)
    assert as_set(chosen, "dataset", "year_key") == {("op_hospital", "2018")}
    assert as_set(unknown) == {("op_hospital", "2014")}


def test_discover_tables(spark):
    names = ["ntpf_ipdc_speciality_2021_apr_dec", "ntpf_op_historical_2018", "ntpfXopXspeciality_1", "other"]
    tables = spark.createDataFrame([(n,) for n in names], "table_name string")
    found = as_set(catalogue.discover_tables(tables), "dataset", "year_key", "list_type", "is_specialty_file")
    assert found == {
        ("ipdc_specialty", "2021_apr_dec", "ipdc", True), ("op_hospital", "2018", "op", False),
    }


def test_documents_come_back_as_written(spark, tmp_path):
    rows = [("2026-06-25", "North Dublin Surgical Hub", None, "Adult", "0-6 Months", 22, "hospital", "ipdc"),
            ("2026-06-25", "North Dublin Surgical Hub", None, "Adult", "6-12 Months", 21, "hospital", "ipdc"),
            ("2026-06-25", "St. Mary's", None, "Child", "6-12 Months", 1, "hospital", "op")]
    made = publish.hospital_documents(facts(spark, rows))
    for layout in (documents.LINES, documents.PER_SLUG):
        folder = str(tmp_path / layout)
        documents.write_documents(made, folder, layout)
        again = documents.read_documents(spark, folder, made.schema)
        assert sorted(map(str, again.collect())) == sorted(map(str, made.collect()))
    one = json.loads(next((tmp_path / "per_slug" / "document=north-dublin-surgical-hub").glob("*.json")).read_text())
    assert one["list_types"]["ipdc"]["populations"]["Adult"] == {
        "last_updated": "2026-06-25",
        "series": [{"date": "2026-06-25", "total": 43, "under_6": 22, "six_to_12": 21, "twelve_plus": 0}],
    }
    # Nulls are written, not left out.
    assert one["list_types"]["op"]["populations"]["Child"] == {"last_updated": None, "series": []}
    assert [json.loads(r.value)["slug"] for r in documents.json_text(made).orderBy("value").collect()] == [
        "north-dublin-surgical-hub", "st.-marys",
    ]
    with pytest.raises(ValueError):
        documents.write_documents(made, str(tmp_path / "x"), "other")


def store_of(spark, raw):
    rows = raw_store.read_raw(spark, raw, WIDE)
    return sorted(map(str, rows.collect()))


def test_a_fresh_load_gives_what_loads_on_the_way_gave(spark, tmp_path):
    at, stepwise, fresh = (str(tmp_path / name) for name in ("landing", "stepwise", "fresh"))
    twice, bad = [*GOOD, "31/03/2026,Adult,Y,1,1,1,1,4"], [*GOOD, "29/01/2026,Adult,St John, Cork,1,2,3,4,10"]
    land(at, "ipdc_hospital", "2026", "2026-07-01", WIDE_HEADER, GOOD)
    land(at, "op_hospital", "2026", "2026-07-01", WIDE_HEADER, bad)
    assert as_set(raw_store.ingest(spark, at, stepwise), "dataset", "reason") == {("op_hospital", landing.BAD_ROWS)}
    land(at, "ipdc_hospital", "2026", "2026-08-01", WIDE_HEADER, twice)
    land(at, "op_hospital", "2026", "2026-08-01", WIDE_HEADER, GOOD)
    assert raw_store.ingest(spark, at, stepwise).count() == 0
    land(at, "ipdc_hospital", "2026", "2026-09-01", WIDE_HEADER, [])
    land(at, "ipdc_hospital", "2026", "2026-10-01", WIDE_HEADER, bad)
    faults = {("2026-09-01", landing.EMPTY), ("2026-10-01", landing.BAD_ROWS)}
    for raw in (stepwise, fresh):
        assert as_set(raw_store.ingest(spark, at, raw), "published", "reason") == faults
    assert store_of(spark, stepwise) == store_of(spark, fresh) and len(store_of(spark, fresh)) == 3
    for raw in (stepwise, fresh):
        valid = ledger.newest_valid(ledger.read_ledger(spark, raw))
        assert as_set(valid, "dataset", "published", "n_rows") == {
            ("ipdc_hospital", "2026-08-01", 2), ("op_hospital", "2026-08-01", 1),
        }
    # A publication that was refused is judged anew once another file has joined it, or if bad rows are allowed.
    land(at, "ipdc_hospital", "2026", "2026-09-01", WIDE_HEADER, GOOD, "late.csv")
    assert as_set(raw_store.ingest(spark, at, fresh), "published") == {("2026-10-01",)}
    assert len(store_of(spark, fresh)) == 2
    assert raw_store.ingest(spark, at, fresh, allow_bad_rows=True).count() == 0
    assert as_set(ledger.loaded(ledger.read_ledger(spark, fresh)), "dataset", "published") >= {("ipdc_hospital", "2026-10-01")}


def test_a_load_scans_each_file_once_and_a_second_load_none(spark, root, tmp_path):
    """By the rows that CSV scans put out, as Spark's own metrics count them."""
    raw, tracker = str(tmp_path / "raw"), spark._jsparkSession.sharedState().statusStore()
    known = lambda: {e.executionId() for e in executions()}

    def executions():
        found = tracker.executionsList()
        return [found.apply(i) for i in range(found.size())]

    def text_scans(before):
        plans = [e.physicalPlanDescription() for e in executions() if e.executionId() not in before]
        return [p for p in plans if "Scan csv" in p]

    before = known()
    raw_store.ingest(spark, root, raw)
    layouts = len(text_scans(before))
    n_headers = len({json.dumps(landing.read_header(spark, r.folder)) for r in landing.publications(
        landing.list_files(spark, root)).collect()})
    assert 0 < layouts <= n_headers + 1
    before, held = known(), as_set(raw_store.loaded_years(spark, raw), "family", "dataset", "year_key", "n_rows")
    raw_store.ingest(spark, root, raw)
    assert text_scans(before) == []
    assert as_set(raw_store.loaded_years(spark, raw), "family", "dataset", "year_key", "n_rows") == held
    assert not list((tmp_path / "raw").glob("_staging/*"))


def test_attributes_come_from_published_rows(spark, root, tmp_path):
    from stocktide.operators.star import ATTRIBUTES
    from stocktide.plans.harmonise import store_tables, unify, unify_attributes

    raw = str(tmp_path / "raw")
    # An unlabelled part without a population is left out of the sums, and its specialty with them.
    land(root, "op_specialty", "2025", "2026-07-01", SPECIALTY_HEADER, [
        "29/01/2025,,Lost,1,1,1,1,4", "29/01/2025,Adult,Kept,1,1,1,1,4", "29/01/2025,Adult,Kept,1,1,1,1,4",
    ])
    raw_store.ingest(spark, root, raw)
    tables = store_tables(spark, raw)
    found = unify_attributes(tables)
    want = unify(tables).select(*ATTRIBUTES).distinct()
    assert as_set(found, *ATTRIBUTES) == as_set(want, *ATTRIBUTES) and found.count() == want.count()
    assert "Lost" not in {r.specialty_name for r in found.collect()}
    shown = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in shown(found) and "Expand" in shown(unify(tables))
