"""Comparable duration buckets from band labels whose boundaries drift over the years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import SIX_TO_12, TWELVE_PLUS, UNDER_6, UNKNOWN_BUCKET


def band_digits(label: Column) -> Column:
    """The digits a label starts with, after any white space; '' if there are none."""
    return F.regexp_extract(label, r"(?U)^\s*([0-9]+)", 1)


def bucket_of_digits(digits: Column) -> Column:
    """Bucket by first month, of digits as `band_digits` gives them."""
    start = digits.try_cast("bigint")
    return (
        F.when(digits.isNull() | (digits == ""), UNKNOWN_BUCKET)
        .when(start < 6, UNDER_6)
        .when(start < 12, SIX_TO_12)
        .otherwise(TWELVE_PLUS)  # also a run of digits too long for a bigint
    )


def classify_band(label: Column) -> Column:
    """Bucket of a band by its first month. A label that starts with no number is 'Unknown'."""
    return bucket_of_digits(band_digits(label))
