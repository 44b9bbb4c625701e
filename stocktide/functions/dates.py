"""Archive dates. They are irregular, so nothing here assumes a month between two snapshots."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _to_date(cell: Column, shape: str, pattern: str) -> Column:
    return F.when(cell.rlike(shape), F.try_to_date(cell, pattern))


def parse_day_first(cell: Column) -> Column:
    """'9/1/2026' or '09/01/2026' -> date; anything else is null."""
    return _to_date(cell, r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z", "d/M/yyyy")


def parse_archive_date(cell: Column) -> Column:
    """Day-first, or ISO where day-first does not fit."""
    iso = _to_date(cell, r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z", "yyyy-M-d")
    return F.coalesce(parse_day_first(cell), iso)


def iso_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def month_label(day: Column) -> Column:
    """'Jun 2026'."""
    return F.date_format(day, "MMM yyyy")


def long_month_label(day: Column) -> Column:
    """'June 2026'."""
    return F.date_format(day, "MMMM yyyy")
