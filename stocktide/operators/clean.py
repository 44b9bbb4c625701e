"""Cleaning: header variants, typed cells, conforming to the unified columns, name harmonising."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import HEADER_NAMES, HOSPITAL_ALIASES, WIDE_TABLE_COUNTS, WIDE_TABLE_NAMES
from ..functions.cells import parse_count, parse_number
from ..functions.dates import parse_day_first
from ..functions.headers import snake_headers
from ..functions.names import current_name, is_suppressed
from ..schemas import UNIFIED
from .joins import lookup_join


def first_present(df: DataFrame, names) -> Column:
    """The first non-null of the columns `names` that exist, as text; null when none does."""
    there = [df[name] for name in names if name in df.columns]
    return F.coalesce(*there) if there else F.lit(None).cast("string")


def merge_headers(df: DataFrame, names=HEADER_NAMES, keep=()) -> DataFrame:
    """Published spellings -> canonical columns. Two spellings in one file feed one column."""
    return df.select(
        *[first_present(df, variants).alias(name) for name, variants in names.items()],
        *keep,
    )


def rename_known(df: DataFrame, names=WIDE_TABLE_NAMES) -> DataFrame:
    """Rename by table; all other headers to snake case."""
    return df.toDF(*snake_headers(df.columns, names))


def parse_counts(df: DataFrame, columns=WIDE_TABLE_COUNTS) -> DataFrame:
    """Named count columns -> bigint, those present."""
    return df.withColumns({c: parse_count(F.col(c)) for c in columns if c in df.columns})


def wide_table(df: DataFrame) -> DataFrame:
    """The single-file form of a wide publication: snake-case names, bigint counts, a date."""
    named = parse_counts(rename_known(df))
    if "archive_date" not in named.columns:
        return named
    return named.withColumn("archive_date", parse_day_first(F.col("archive_date")))


def numeric_report(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """One row per text column: rows, cells that read as numbers, and whether it is numeric.

    A column is numeric when more than `threshold` of all rows read as a number once thousands
    commas are gone (missing cells count against it), or when every cell that is there is a plain
    number. One pass over the data, whatever the number of columns.
    """
    names = [name for name, kind in df.dtypes if kind == "string"]
    if not names:
        raise ValueError("no text columns")

    # Numbers get a projection of their own, so that each cell is parsed once.
    numbers = df.select(
        *[F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)],
        *[parse_number(F.col(f"`{name}`")).alias(f"n{i}") for i, name in enumerate(names)],
    )

    def cell_counts(i: int, name: str) -> Column:
        cell, number = F.col(f"c{i}"), F.col(f"n{i}")
        plain = number.isNotNull() & ~cell.contains(",")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count("*").alias("n_rows"),
            F.count(cell).alias("n_present"),
            F.count(number).alias("n_numbers"),
            F.count_if(plain).alias("n_plain"),
            F.coalesce(F.every(number.isNull() | (number == F.floor(number))), F.lit(True)).alias(
                "all_whole"
            ),
        )

    structs = [cell_counts(i, name) for i, name in enumerate(names)]
    rows = numbers.agg(F.array(*structs).alias("columns")).select(F.inline("columns"))
    by_share = F.col("n_numbers") / F.col("n_rows") > threshold
    all_plain = (F.col("n_present") > 0) & (F.col("n_plain") == F.col("n_present"))
    numeric = F.coalesce(by_share | all_plain, F.lit(False))
    return rows.select(
        "column_name",
        "n_rows",
        "n_present",
        "n_numbers",
        numeric.alias("is_numeric"),
        F.when(numeric, F.col("n_present") - F.col("n_numbers"))
        .otherwise(F.lit(0))
        .cast("bigint")
        .alias("cells_lost"),
        "all_whole",
    )


def auto_numeric(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Convert the text columns that are numeric by `numeric_report`; other cells become null.

    The report is needed before the projection is known: one small row per column reaches the driver.
    """
    converted = {}
    for row in numeric_report(df, threshold).where("is_numeric").collect():
        cell = F.col(f"`{row.column_name}`")
        parse = parse_count if row.all_whole else parse_number
        converted[row.column_name] = parse(cell)
    return df.withColumns(converted) if converted else df


def conform(df: DataFrame, schema=UNIFIED) -> DataFrame:
    """Project to the schema's columns in order; those that are missing become typed nulls."""
    return df.select(
        *[
            (df[f.name] if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def canonical_names(df: DataFrame, aliases=HOSPITAL_ALIASES, name="hospital_name") -> DataFrame:
    """Replace earlier names by current ones: one exact lookup, not trimmed, not transitive.

    `aliases` is a small dict, looked up inside the projection, or a DataFrame (alias, canonical),
    joined. An alias listed with two names is an error, since it would double the rows it matches; one
    listed twice with the same name counts once.
    """
    if isinstance(aliases, dict):
        return df.withColumn(name, current_name(F.col(name), aliases))
    two_names = F.concat(F.lit("alias with more than one name: "), F.col("alias"))
    canonical = F.when(F.min("canonical").eqNullSafe(F.max("canonical")), F.min("canonical")).otherwise(
        F.raise_error(two_names)
    )
    # The hint lets the join shuffle this side on its own, so that a hot name can still be split.
    unique = aliases.groupBy("alias").agg(canonical.alias("_canonical")).hint("rebalance")
    renamed = unique.select(F.col("alias").alias(name), "_canonical")
    joined = lookup_join(df, renamed, name)
    return joined.withColumn(name, F.coalesce("_canonical", name)).select(*df.columns)


def flag_suppressed(df: DataFrame, **labels) -> DataFrame:
    flag = is_suppressed(F.col("hospital_name"), F.col("specialty_name"), **labels)
    return df.withColumn("is_suppressed_bucket", flag)


def require_rows(df: DataFrame) -> DataFrame:
    """The frame itself, or an error when it is empty."""
    if df.isEmpty():
        raise ValueError("no rows")
    return df
