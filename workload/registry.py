"""Registered queries, each next to the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.functions.dates import iso_label

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def plain(df: DataFrame) -> DataFrame:
    """Dates as ISO text, so that both engines return the same type."""
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({name: iso_label(F.col(name)) for name in dates})


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name. Without `sql` no statement can express the result."""

    def register(function: Query) -> Query:
        REGISTRY[function.__name__] = Registered(lambda s, d: plain(function(s, d)), sql)
        return function

    return register
