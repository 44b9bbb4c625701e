"""Checks on data before it is trusted or published."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import GENERIC_NAME_WORDS, LIST_TYPES, MINIMUM_CELL, POPULATIONS, SUPPRESSION_MARKERS
from ..functions.names import name_fingerprint
from ..shared_dir import fixed


def column_profile(df: DataFrame, relative_error: float | None = None) -> DataFrame:
    """One row per column: type, rows, non-null cells and distinct values (nulls not counted).

    Distinct counts are exact; with `relative_error` they are estimated in one pass with constant
    memory, for tables where exact counts of every column cost too much.
    """

    def distinct(cell: Column) -> Column:
        if relative_error is None:
            return F.count_distinct(cell)
        return F.approx_count_distinct(cell, relative_error)

    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("column_type"),
            F.count("*").alias("n_rows"),
            F.count(F.col(f"`{name}`")).alias("n_present"),
            distinct(F.col(f"`{name}`")).alias("n_distinct"),
        )
        for name, kind in df.dtypes
    ]
    return df.agg(F.array(*cells).alias("columns")).select(F.inline("columns"))


def has_marker(cell: Column, markers=SUPPRESSION_MARKERS) -> Column:
    """Whether a cell's text contains one of the markers, whatever the case; false when missing."""
    text = F.lower(cell.cast("string"))
    found = F.lit(False)
    for marker in markers:
        found = found | text.contains(marker)
    return F.coalesce(found, F.lit(False))


def marker_scan(df: DataFrame, markers=SUPPRESSION_MARKERS) -> DataFrame:
    """One row per column: the number of cells with a suppression marker, and whether there is any."""
    counts = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(has_marker(F.col(f"`{name}`"), markers)).alias("n_cells"),
        )
        for name in df.columns
    ]
    rows = df.agg(F.array(*counts).alias("columns")).select(F.inline("columns"))
    return rows.withColumn("found", F.col("n_cells") > 0)


def marker_found(df: DataFrame, markers=SUPPRESSION_MARKERS) -> DataFrame:
    """One row: whether any cell of the frame has a marker."""
    any_cell = F.lit(False)
    for name in df.columns:
        any_cell = any_cell | has_marker(F.col(f"`{name}`"), markers)
    return df.agg(F.coalesce(F.bool_or(any_cell), F.lit(False)).alias("marker_found"))


def reconcile(
    left: DataFrame, right: DataFrame, by, measure: str = "count", tolerance: int = 0
) -> DataFrame:
    """Sums of two cuts of the same people, side by side, with their difference.

    A key that one side lacks stays, with a null sum and `agrees` false. The two are stacked and summed
    once, which takes one shuffle of partial sums instead of two and a join.
    """
    nothing = F.lit(None).cast("bigint")
    value = F.col(measure).cast("bigint")
    stacked = left.select(*by, value.alias("_left"), nothing.alias("_right")).unionByName(
        right.select(*by, nothing.alias("_left"), value.alias("_right"))
    )
    totals = stacked.groupBy(*by).agg(
        F.sum("_left").alias("left_total"), F.sum("_right").alias("right_total")
    )
    difference = F.col("left_total") - F.col("right_total")
    return totals.withColumn("difference", difference).withColumn(
        "agrees", F.coalesce(F.abs("difference") <= tolerance, F.lit(False))
    )


def band_sum_gaps(wide: DataFrame, bands, total: str) -> DataFrame:
    """How often the bands of a row differ from its published total, by size of the difference."""
    band_sum = F.lit(0).cast("bigint")
    for band in bands:
        band_sum = band_sum + F.coalesce(F.col(f"`{band}`"), F.lit(0))
    gaps = wide.select((F.col(f"`{total}`") - band_sum).alias("difference"))
    return gaps.groupBy("difference").agg(F.count("*").alias("n_rows"))


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def alias_candidates(
    dimension: DataFrame, name: str = "hospital_name", generic=GENERIC_NAME_WORDS
) -> DataFrame:
    """Names that look like spellings of one entity: (fingerprint, name, first_name, n_names, distance).

    Names with the same fingerprint form a group, compared to the group's first name only: the
    output grows with the names, never with pairs of them. The groups are fixed before names are
    joined to them, so that a fingerprint with very many names can be split over tasks.
    """
    keyed = _keyed_names(dimension, name, generic)
    groups = fixed(
        keyed.where("fingerprint <> ''")
        .groupBy("fingerprint")
        .agg(F.count("*").alias("n_names"), F.min("name").alias("first_name"))
        .where("n_names > 1")
    )
    return (
        keyed.join(groups, "fingerprint")
        .withColumn("distance", F.levenshtein("name", "first_name"))
        .select("fingerprint", "name", "first_name", "n_names", "distance")
    )


def _keyed_names(dimension: DataFrame, name: str, generic) -> DataFrame:
    names = dimension.where(F.col(name).isNotNull()).select(F.col(name).alias("name")).distinct()
    return names.withColumn("fingerprint", name_fingerprint(F.col("name"), generic))


def alias_candidates_by_word(
    dimension: DataFrame, name: str = "hospital_name", generic=GENERIC_NAME_WORDS, least_share: float = 0.3
) -> DataFrame:
    """Names that share a telling word with an earlier name: (word, name, first_name, n_names, shared).

    Each telling word is a group of the names that have it, and each name is compared with the first
    name of each of its words' groups only. `shared` is the part of both names' telling words that they
    have in common; pairs below `least_share` are left out. Output grows with words, never with pairs.
    """
    keyed = _keyed_names(dimension, name, generic).withColumn("words", F.split("fingerprint", " "))
    by_word = keyed.select("name", "words", F.explode(F.array_distinct("words")).alias("word")).where("word <> ''")
    groups = fixed(
        by_word.groupBy("word")
        .agg(F.count("*").alias("n_names"), F.min(F.struct("name", "words")).alias("first"))
        .where("n_names > 1")
    )
    met = by_word.join(groups, "word").where("name <> first.name")
    shared = F.size(F.array_intersect("words", "first.words")) / F.size(F.array_union("words", "first.words"))
    return (
        met.select("word", "name", F.col("first.name").alias("first_name"), "n_names", shared.alias("shared"))
        .where(F.col("shared") >= least_share)
    )


def lost_rows(rows: DataFrame, by, list_types=LIST_TYPES, populations=POPULATIONS) -> DataFrame:
    """Per `by`: unified rows, and those that some answer leaves out, in one pass.

    Dated answers leave out rows whose date could not be read, sums those whose count could not, and rankings
    and documents those of a list type or population outside the fixed lists.
    """
    outside = lambda column, known: F.count_if(~F.coalesce(F.col(column).isin(*known), F.lit(False)))
    return rows.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        outside("list_type", list_types).alias("n_unknown_list_type"),
        outside("adult_child", populations).alias("n_unknown_population"),
        F.count_if(F.col("archive_date_parsed").isNull()).alias("n_undated"),
        F.count_if(F.col("count").isNull()).alias("n_uncounted"),
    )


def list_type_contamination(facts: DataFrame, by) -> DataFrame:
    """Each list type's sum next to the sum of all, which a query that forgets the filter returns."""
    return facts.groupBy(*by).agg(
        F.sum(F.when(F.col("list_type") == "ipdc", F.col("count"))).alias("ipdc_total"),
        F.sum(F.when(F.col("list_type") == "op", F.col("count"))).alias("op_total"),
        F.sum("count").alias("mixed_total"),
    )


def suppress_small(df: DataFrame, columns, minimum: int = MINIMUM_CELL) -> DataFrame:
    """Cells from 1 to below the minimum become null, with `n_suppressed` cells per row."""
    small = {c: (F.col(c) > 0) & (F.col(c) < minimum) for c in columns}
    hidden = sum(
        (F.coalesce(s, F.lit(False)).cast("int") for s in small.values()), F.lit(0)
    )
    return df.withColumns(
        {**{c: F.when(~s | F.col(c).isNull(), F.col(c)) for c, s in small.items()}, "n_suppressed": hidden}
    )


def suppress_points(points: DataFrame, cells, total: str, minimum: int = MINIMUM_CELL) -> DataFrame:
    """Small cells become null, and with any of them the row's total, from which it could be worked out."""
    hidden = suppress_small(points, cells, minimum)
    return hidden.withColumn(total, F.when(F.col("n_suppressed") == 0, F.col(total))).drop("n_suppressed")


def bucket_small(df: DataFrame, entity: str, by, label: str, minimum: int) -> DataFrame:
    """Entities whose sum is below the minimum are added up under one label."""
    per_entity = df.groupBy(entity, *by).agg(F.sum("count").alias("count"))
    name = F.when(F.col("count") < minimum, F.lit(label)).otherwise(F.col(entity))
    return (
        per_entity.withColumn(entity, name).groupBy(entity, *by).agg(F.sum("count").alias("count"))
    )


def suppressed_count(facts: DataFrame, by=()) -> DataFrame:
    """Rows in suppression buckets."""
    return facts.groupBy(*by).agg(
        F.count_if("is_suppressed_bucket").alias("n_suppressed"), F.count("*").alias("n_rows")
    )
