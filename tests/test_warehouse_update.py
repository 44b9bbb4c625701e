"""The warehouse brought up to date by its changed partitions, against one built whole."""

import pytest
from pyspark.sql import functions as F
from test_sources import LONG_HEADER, SPECIALTY_HEADER, WIDE_HEADER, land

from stocktide.operators.star import star_observations
from stocktide.plans.warehouse import rebuild, update
from stocktide.sources import raw_store
from stocktide.sources.warehouse_store import FACTS, expire, published_build, read_parts, read_star

DIMENSIONS = {"dim_date": "archive_date", "dim_hospital": "hospital_name", "dim_specialty": "specialty_name"}


def wide(at, year, published, *rows, dataset="ipdc_hospital"):
    land(at, dataset, year, published, WIDE_HEADER, [f"{day},Adult,{name},1,2,3,{n},{6 + n}" for day, name, n in rows])


def long(at, year, published, *rows):
    land(at, "ipdc_hospital", year, published, LONG_HEADER, [
        f"{day},{group},1,{name},10,{specialty},Inpatient,Adult,16-64,0-3 Months,{n}" for day, group, name, specialty, n in rows
    ])


@pytest.fixture
def places(spark, tmp_path):
    landing, raw, warehouse = (str(tmp_path / name) for name in ("landing", "raw", "warehouse"))
    wide(landing, "2025", "2026-01-01", ("29/01/2025", "M", 1), ("29/02/2025", "Q", 2))
    wide(landing, "2026", "2026-07-01", ("29/01/2026", "M", 3), ("29/01/2026", "D", 4))
    wide(landing, "2026", "2026-07-01", ("29/01/2026", "M", 5), dataset="op_hospital")
    land(landing, "op_specialty", "2026", "2026-07-01", SPECIALTY_HEADER, ["29/01/2026,Adult,Urology,1,1,1,1,4"])
    # T is named in a suppressed row only: no id.
    long(landing, "2018", "2025-02-01", ("31/01/2018", "G", "K", "Urology", 7), ("31/01/2018", "G", "T", "Small Volume Specialties", 8))
    raw_store.ingest(spark, landing, raw)
    rebuild(spark, raw, warehouse)
    return landing, raw, warehouse


def ids(star):
    return {name: dict(getattr(star, name).select(key, f"{name[4:]}_id").collect()) for name, key in DIMENSIONS.items()}


def same_as_whole(spark, star, raw, at):
    whole = rebuild(spark, raw, at)
    for name in DIMENSIONS:
        one, other = (getattr(s, name).drop(f"{name[4:]}_id") for s in (star, whole))
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty(), name
    one, other = (star_observations(s).drop("fact_id") for s in (star, whole))
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
    assert star.fact.count() == star.fact.select("fact_id").distinct().count()


def written_by(spark, warehouse):
    return {part.key: part.facts for part in published_build(spark, warehouse).parts}


def test_only_changed_partitions_are_written(spark, places, tmp_path):
    landing, raw, warehouse = places
    first, before = published_build(spark, warehouse), ids(read_star(spark, warehouse))
    wide(landing, "2026", "2026-08-01", ("29/01/2026", "A", 3), ("28/02/2026", "M", 9), ("bad", "Z", 1))
    raw_store.ingest(spark, landing, raw)
    star = update(spark, raw, warehouse)
    same_as_whole(spark, star, raw, str(tmp_path / "whole"))
    by = written_by(spark, warehouse)
    assert {key for key, build in by.items() if build != first.name} == {("ipdc", "2026")}
    after = ids(star)
    for name, known in before.items():
        assert {k: v for k, v in after[name].items() if k in known}.items() <= known.items(), name
    assert "D" not in after["dim_hospital"] and after["dim_hospital"]["A"] > max(before["dim_hospital"].values())
    paths = {r.p for r in star.fact.select(F.input_file_name().alias("p")).distinct().collect()}
    assert any(first.name in p for p in paths) and any(by["ipdc", "2026"] in p for p in paths)

    # D comes back with the id it had.
    wide(landing, "2026", "2026-09-01", ("29/01/2026", "D", 3))
    raw_store.ingest(spark, landing, raw)
    star = update(spark, raw, warehouse)
    same_as_whole(spark, star, raw, str(tmp_path / "again"))
    assert ids(star)["dim_hospital"]["D"] == before["dim_hospital"]["D"]


def test_nothing_new_makes_no_build(spark, places):
    _, raw, warehouse = places
    first = published_build(spark, warehouse)
    update(spark, raw, warehouse)
    assert published_build(spark, warehouse) == first


def test_suppressed_rows_follow_the_names_of_other_partitions(spark, places, tmp_path):
    landing, raw, warehouse = places
    first = published_build(spark, warehouse)
    wide(landing, "2026", "2026-08-01", ("29/01/2026", "T", 3))
    raw_store.ingest(spark, landing, raw)
    star = update(spark, raw, warehouse)
    same_as_whole(spark, star, raw, str(tmp_path / "whole"))
    assert {k for k, b in written_by(spark, warehouse).items() if b != first.name} == {("ipdc", "2026"), ("ipdc", "2018")}
    assert star.fact.where("is_suppressed_bucket and hospital_id is not null").count() == 1
    wide(landing, "2026", "2026-09-01", ("29/01/2026", "M", 3))
    raw_store.ingest(spark, landing, raw)
    star = update(spark, raw, warehouse)
    same_as_whole(spark, star, raw, str(tmp_path / "again"))
    assert star.fact.where("is_suppressed_bucket and hospital_id is not null").count() == 0


def test_other_aliases_change_every_partition(spark, places, tmp_path):
    _, raw, warehouse = places
    listed = [("M", "N"), ("Q", "R")]
    aliases = spark.createDataFrame(listed, "alias string, canonical string")
    star = update(spark, raw, warehouse, aliases)
    assert {"N", "R"} <= set(ids(star)["dim_hospital"]) and "M" not in ids(star)["dim_hospital"]
    second = published_build(spark, warehouse)
    assert {part.facts for part in second.parts} == {second.name}
    update(spark, raw, warehouse, aliases.orderBy(F.desc("alias")))
    assert published_build(spark, warehouse) == second


def test_a_warehouse_that_is_not_there_is_built_whole(spark, places, tmp_path):
    _, raw, _ = places
    star = update(spark, raw, str(tmp_path / "new"))
    same_as_whole(spark, star, raw, str(tmp_path / "whole"))


def test_builds_in_use_are_not_removed(spark, places):
    landing, raw, warehouse = places
    names = [published_build(spark, warehouse).name]
    for month, n in (("08", 3), ("09", 4), ("10", 5)):
        wide(landing, "2026", f"2026-{month}-01", ("29/01/2026", "M", n))
        raw_store.ingest(spark, landing, raw)
        update(spark, raw, warehouse)
        names.append(published_build(spark, warehouse).name)
    before = sorted(map(tuple, read_star(spark, warehouse).fact.collect()), key=str)
    # The first build still holds the other partitions; the third is kept for readers that are on it.
    assert expire(spark, warehouse, keep=2) == [names[1]]
    assert expire(spark, warehouse, keep=2) == []
    star = read_star(spark, warehouse)
    assert sorted(map(tuple, star.fact.collect()), key=str) == before and star.dim_hospital.count() > 0
    rebuild(spark, raw, warehouse)
    assert set(expire(spark, warehouse, keep=1)) == {names[0], names[2], names[3]}
    assert read_parts(spark, published_build(spark, warehouse), FACTS).count() == len(before)


def test_a_year_of_one_partition_is_read_alone(spark, places):
    """The condition on partitions leaves files out when the scan is planned."""
    landing, raw, warehouse = places
    wide(landing, "2026", "2026-08-01", ("29/01/2026", "M", 9))
    raw_store.ingest(spark, landing, raw)
    fact = update(spark, raw, warehouse).fact.where("list_type = 'ipdc' and source_year_key = '2026'")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "concat_ws" in plan.split("PartitionFilters")[1].split("]")[0]
    assert fact.select(F.input_file_name()).distinct().count() == 1
