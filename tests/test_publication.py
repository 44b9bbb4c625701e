"""Record schemas, and documents published by content."""

import json
from pathlib import Path

import pytest
from helpers import as_set, unified
from pyspark.sql import functions as F

from stocktide.operators.record_schema import check_schema, metadata_schema
from stocktide.plans import export, publish
from stocktide.plans.warehouse import build_warehouse
from stocktide.sources.published_documents import manifest, read_published

GOOD = {
    "dataset_id": "a-1", "title": "t", "owner": "o", "source_name": "s", "source_url": "https://x.ie/a%20b?c=d#e",
    "licence": "l", "attribution_required": "no", "redistribution_allowed": True, "variables": ["a"],
    "geography_level": "county", "update_frequency": "monthly", "download_date": "2026-02-28",
    "processing_date": "2024-02-29", "citation": "c", "small_cell_suppression_applied": False,
}
CASES = [
    ({}, []),
    ({"quality_notes": "", "known_limitations": "k"}, []),
    ({"colour": 1, "licence": ...}, ["colour/undeclared", "licence/required"]),
    ({"dataset_id": "A b"}, ["dataset_id/pattern"]),
    ({"dataset_id": "ab\n"}, ["dataset_id/pattern"]),
    ({"dataset_id": 5}, ["dataset_id/type"]),
    ({"title": None}, ["title/type"]),
    ({"redistribution_allowed": "true"}, ["redistribution_allowed/type"]),
    ({"variables": []}, ["variables/minItems"]),
    ({"variables": "a"}, ["variables/type"]),
    ({"variables": ["a", 1, None, ["b"]]}, ["variables/items/type"]),
    ({"geography_level": "planet"}, ["geography_level/enum"]),
    ({"geography_level": ["county"]}, ["geography_level/enum", "geography_level/type"]),
    ({"download_date": "2026-02-30", "processing_date": "1/1/2026"}, ["download_date/format", "processing_date/format"]),
    ({"source_url": "x.ie"}, ["source_url/format"]),
    ({"source_url": "https://x.ie/a b"}, ["source_url/format"]),
    ({"source_url": "https://x.ie/%zz"}, ["source_url/format"]),
]


def test_rules_of_metadata_records(spark):
    rows = [(i, json.dumps({k: v for k, v in (GOOD | change).items() if v is not ...})) for i, (change, _) in enumerate(CASES)]
    rows += [(100, None), (101, "no json"), (102, '{"title": "a", "title": "b"}'), (103, "[]"), (104, "{}")]
    # Other columns of the table may have any name.
    frame = spark.createDataFrame(rows, "id int, record string").withColumns({"value": F.lit(1), "item": F.lit(2)})
    found = {row.id: row for row in check_schema(frame).collect()}
    for i, (_, want) in enumerate(CASES):
        assert found[i].violations == want and found[i].is_valid == (not want)
    for i in (100, 101, 102):
        assert found[i].violations == ["not a record"] and not found[i].is_valid
    assert found[103].violations == ["type"]
    assert found[104].violations == sorted(f"{name}/required" for name in metadata_schema()["required"])


def test_nested_schemas_and_unknown_keywords(spark):
    point = {"type": "object", "required": ["n"], "properties": {"n": {"type": ["integer", "null"]}, "r": {"type": "number"}}}
    schema = {"type": "object", "properties": {"points": {"type": "array", "items": point}}}
    texts = ['{"points": [{"n": 1}, {"n": 2.0, "r": 2.5}, {"n": null}]}', '{"points": [{"n": 1.5}]}',
             '{"points": [{"r": "x"}, 3]}', '{"points": [], "more": 1}', "{}"]
    frame = spark.createDataFrame([(t,) for t in texts], "record string").coalesce(1)
    assert [row.violations for row in check_schema(frame, schema).collect()] == [
        [], ["points/items/n/type"], ["points/items/n/required", "points/items/r/type", "points/items/type"], [], []
    ]
    for odd in ({"maxLength": 3}, {"additionalProperties": {"type": "string"}}, {"enum": [1]}):
        with pytest.raises(ValueError):
            check_schema(frame, odd)


def test_each_record_and_field_is_taken_apart_once(spark):
    checked = check_schema(spark.createDataFrame([(json.dumps(GOOD),)], "record string")).select("violations")
    plan = checked._jdf.queryExecution().optimizedPlan().toString()
    # One object in the schema, whose members all rules read.
    assert plan.count("MapType(StringType,VariantType") == 1


ROWS = [
    ("2026-01-01", "A", None, "Adult", "0-6 Months", 20, "hospital", "ipdc"),
    ("2026-01-01", "A", None, "Adult", "6-12 Months", 3, "hospital", "ipdc"),
    ("2026-02-01", "A", None, "Adult", "0-6 Months", 0, "hospital", "ipdc"),
    ("2026-01-01", "A", None, "Adult", "0-6 Months", 40, "hospital", "op"),
    ("2026-01-01", "B", None, "Child", "0-6 Months", 50, "hospital", "op"),
    ("2026-01-01", "C", None, "Adult", "0-6 Months", 60, "hospital", "ipdc"),
    ("2026-01-01", None, "U", "Adult", "0-6 Months", 2, "national_specialty", "op"),
    ("2026-01-01", None, "V", "Adult", "0-6 Months", 9, "national_specialty", "op"),
]
IDS = "dataset_id string"


def files(folder):
    """When each file was written, but for the marks of finished writes."""
    return {p: p.stat().st_mtime_ns for p in Path(folder).rglob("*") if p.is_file() and "_SUCCESS" not in p.name}


def points(spark, folder, star, kind=export.HOSPITALS):
    schema = publish.star_hospital_documents(star).schema
    return as_set(
        publish.flatten_documents(read_published(spark, folder, kind, schema)),
        "hospital_name", "list_type", "date", "total", "under_6", "six_to_12",
    )


def test_only_changed_documents_are_written(spark, tmp_path):
    at, folder = str(tmp_path / "w"), str(tmp_path / "site")
    star = build_warehouse(unified(spark, ROWS), at)
    assert manifest(spark, folder).isEmpty()
    assert export.export_changed(star, folder) == {"national": 1, "national_by_specialty": 1, "hospitals": 3, "index": 3}
    before = files(folder)
    assert not any(export.export_changed(star, folder).values()) and files(folder) == before
    whole = points(spark, folder, star)
    assert {("A", "ipdc", "2026-01-01", 23, 20, 3), ("A", "ipdc", "2026-02-01", 0, 0, 0)} <= whole

    # One hospital has another figure, one is gone, one came.
    other = [(*row[:5], row[5] + 1, *row[6:]) if row[1] == "C" else row for row in ROWS if row[1] != "B"]
    later = build_warehouse(unified(spark, [*other, (*ROWS[5][:1], "D", *ROWS[5][2:])]), at)
    written = export.export_changed(later, folder)
    assert written == {"national": 1, "national_by_specialty": 0, "hospitals": 2, "index": 1}
    assert {p: t for p, t in files(folder).items() if p in before} == before
    assert {r[0] for r in points(spark, folder, later)} == {"A", "C", "D"}
    assert ("C", "ipdc", "2026-01-01", 61, 61, 0) in points(spark, folder, later)
    names = read_published(spark, folder, export.INDEX, "slug string, hospital_name string")
    assert as_set(names, "hospital_name") == {("A",), ("C",), ("D",)}

    # Back to the first state: its documents are named again without a reader seeing any twice.
    export.export_changed(build_warehouse(unified(spark, ROWS), at), folder)
    assert points(spark, folder, star) == whole and manifest(spark, folder).count() == 8


def test_gate_and_small_cells(spark, tmp_path):
    folder = str(tmp_path / "site")
    star = build_warehouse(unified(spark, ROWS), str(tmp_path / "w"))
    allowed = spark.createDataFrame([("ipdc-hospital",), ("op-specialty",), ("else",), (None,)], IDS)
    export.export_changed(star, folder, allowed, minimum=5)
    found = points(spark, folder, star)
    assert {r[:2] for r in found} == {("A", "ipdc"), ("C", "ipdc")}
    assert ("A", "ipdc", "2026-01-01", None, 20, None) in found and ("C", "ipdc", "2026-01-01", 60, 60, 0) in found
    ranking = read_published(spark, folder, export.BY_SPECIALTY, publish.star_specialty_document(star).schema)
    items = as_set(publish.flatten_ranking(ranking).select(F.inline("items")), "specialty_name", "total", "under_6")
    assert items == {("V", 9, 9), ("U", None, None)}
    # A dataset that is held back later is gone from what readers see.
    export.export_changed(star, folder, spark.createDataFrame([], IDS))
    assert points(spark, folder, star) == set() and points(spark, folder, star, export.NATIONAL) == set()
