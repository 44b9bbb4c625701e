"""Metadata records, the licence register and what may be published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import (
    DATASET_ID_PATTERN,
    GEOGRAPHY_LEVELS,
    METADATA_BOOLEANS,
    METADATA_DATES,
    METADATA_OPTIONAL,
    METADATA_REQUIRED,
    REGISTER_COLUMNS,
)


def _texts(names) -> Column:
    return F.array(*[F.lit(name) for name in names])


def _bad_field(field: str, good: Column) -> Column:
    """The field's name when its value is there and breaks its rule."""
    return F.when(F.col("_fields")[field].isNotNull() & ~F.coalesce(good, F.lit(False)), field)


def check_metadata(
    records: DataFrame,
    record: str = "record",
    required=METADATA_REQUIRED,
    optional=METADATA_OPTIONAL,
) -> DataFrame:
    """Check JSON metadata records: required fields missing, fields not declared, values out of rule.

    Text that is not a JSON object lacks every field.
    """
    fields = F.col("_fields")
    parsed = records.withColumn(
        "_fields",
        F.coalesce(
            F.from_json(F.col(record), "map<string,string>"),
            F.create_map().cast("map<string,string>"),
        ),
    )
    variables = F.from_json(fields["variables"], "array<string>")
    bad = [
        _bad_field("dataset_id", fields["dataset_id"].rlike(DATASET_ID_PATTERN)),
        _bad_field("geography_level", fields["geography_level"].isin(*GEOGRAPHY_LEVELS)),
        _bad_field("variables", F.size(variables) > 0),
        *[_bad_field(name, fields[name].isin("true", "false")) for name in METADATA_BOOLEANS],
        *[
            _bad_field(
                name,
                fields[name].rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
                & F.try_to_date(fields[name], "yyyy-MM-dd").isNotNull(),
            )
            for name in METADATA_DATES
        ],
    ]
    present = F.map_keys(fields)
    checked = parsed.withColumns(
        {
            "missing": F.array_sort(F.array_except(_texts(required), present)),
            "undeclared": F.array_sort(F.array_except(present, _texts([*required, *optional]))),
            "out_of_rule": F.array_compact(F.array(*bad)),
        }
    ).drop("_fields")
    sound = (F.size("missing") == 0) & (F.size("undeclared") == 0)
    return checked.withColumn("is_complete", sound)


def metadata_record(profile: DataFrame, constants: dict[str, str], suppressed: Column) -> DataFrame:
    """Assemble a record: given texts, the columns of a `column_profile`, dates of today.

    `profile` has one row per column of the table and its `position`. `suppressed` is a literal, or an
    aggregate over columns of the profile, such as whether a marker scan found anything.
    """
    names = F.transform(
        F.array_sort(F.collect_list(F.struct("position", "column_name"))),
        lambda e: e["column_name"],
    )
    flag = suppressed.alias("small_cell_suppression_applied")
    rows = profile.agg(names.alias("variables"), flag)
    texts = [F.lit(value).alias(name) for name, value in constants.items()]
    return rows.select(
        *texts,
        "variables",
        F.current_date().cast("string").alias("download_date"),
        F.current_date().cast("string").alias("processing_date"),
        "small_cell_suppression_applied",
    )


def register_entry(records: DataFrame) -> DataFrame:
    """Metadata records -> rows of the licence register."""
    names = {
        "dataset_id": "dataset_id",
        "source": "source_name",
        "licence": "licence",
        "attribution_required": "attribution_required",
        "redistribution_allowed": "redistribution_allowed",
        "added": "download_date",
    }
    return records.select(*[F.col(names[c]).alias(c) for c in REGISTER_COLUMNS])


def publishable(
    datasets: DataFrame, checked: DataFrame, register: DataFrame, key: str = "dataset_id"
) -> tuple[DataFrame, DataFrame]:
    """(datasets with a complete record and a register row, the others with what they lack)."""
    records = checked.where("is_complete").select(key).distinct().withColumn("_record", F.lit(True))
    listed = register.select(key).distinct().withColumn("_listed", F.lit(True))
    found = datasets.join(records, key, "left").join(listed, key, "left")
    has_record, has_row = F.col("_record").isNotNull(), F.col("_listed").isNotNull()
    allowed = found.where(has_record & has_row).select(*datasets.columns)
    held = found.where(~(has_record & has_row)).select(
        *datasets.columns,
        has_record.alias("has_complete_record"),
        has_row.alias("has_register_row"),
    )
    return allowed, held


def ready_indicators(
    indicators: DataFrame, datasets: DataFrame, key: str = "dataset_id"
) -> DataFrame:
    """Per indicator: how many of the datasets it depends on may be published, and whether all may.

    `indicators` has a unique `indicator_id` and an array `depends_on`. One that depends on nothing is
    ready. The semi-join needs no distinct datasets, so one that most indicators depend on can be
    split over tasks.
    """
    needs = F.array_distinct(F.coalesce("depends_on", F.array().cast("array<string>")))
    listed = indicators.select("indicator_id", F.array_compact(needs).alias("_needs"))
    found = (
        listed.select("indicator_id", F.explode("_needs").alias(key))
        .join(datasets.select(key), key, "left_semi")
        .groupBy("indicator_id")
        .agg(F.count("*").alias("_found"))
    )
    n_available = F.coalesce("_found", F.lit(0))
    counted = listed.join(found, "indicator_id", "left").select(
        "indicator_id",
        F.size("_needs").cast("bigint").alias("n_needed"),
        n_available.cast("bigint").alias("n_available"),
    )
    return counted.withColumn("is_ready", F.col("n_available") == F.col("n_needed"))
