"""Joins of a large frame to a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SLICES = 1024


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left equi-join to a lookup with unique, non-null keys (ids, if numbers, are positive).

    No broadcast is forced: Spark broadcasts the lookup when its measured size is under
    `spark.sql.autoBroadcastJoinThreshold` and otherwise shuffles both sides, where adaptive
    execution splits a key that holds too many rows. It can do so only when each side of the join is
    a plain shuffle, so the lookup should be a table or a fixed frame, not an aggregate by the same
    key. Rows without a key match nothing; they are spread over the shuffle partitions rather than
    all hashed to the one of the null key.
    """
    kind = dict(facts.dtypes)[key]
    others = [F.col(f"`{c}`") for c in facts.columns if c != key]
    if not others:
        return facts.join(lookup, key, "left")
    if kind not in ("string", "bigint"):
        # No value of the type is free to stand for none, so that such rows go round the join.
        joined = facts.where(F.col(key).isNotNull()).join(lookup, key, "left")
        given = {name: F.lit(None).cast(t) for name, t in lookup.dtypes if name != key}
        return joined.unionByName(facts.where(F.col(key).isNull()).withColumns(given).select(joined.columns))
    slice_ = F.pmod(F.xxhash64(*others), F.lit(NULL_SLICES))
    no_key = F.concat(F.lit("\uffff"), slice_.cast("string")) if kind == "string" else -1 - slice_
    left = facts.withColumn("_key", F.coalesce(F.col(key), no_key))
    right = lookup.withColumnRenamed(key, "_key")
    return left.join(right, "_key", "left").drop("_key")


def known_only(facts: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the lookup, which may repeat keys (see `lookup_join` on hot keys)."""
    return facts.join(lookup.select(key), key, "left_semi")


def _first_entries(entries: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """One entry per key: the first by the columns of `order`, then by all others. Partial minimums meet
    in the shuffle, so a key that is listed very often is one row per task."""
    first = [c for c in order if c in entries.columns]
    rest = [c for c in entries.columns if c not in (key, *first)]
    names = [*first, *rest]
    if not names:
        return entries.distinct()
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in names])).alias("_entry")
    chosen = entries.groupBy(key).agg(least)
    return chosen.select(key, *[F.col(f"_entry.`{c}`").alias(c) for c in names])


def append_missing(
    register: DataFrame,
    entries: DataFrame,
    key: str = "dataset_id",
    order: tuple[str, ...] = ("added",),
) -> DataFrame:
    """The register with those entries whose key it does not hold yet.

    Of several entries with one key the first by `order` counts, then the first by all other columns, so
    that the order of rows plays no part. `conflicting_entries` tells which keys that concerns.
    """
    new = _first_entries(entries, key, order).join(register, key, "left_anti")
    return register.unionByName(new.select(*register.columns))


def conflicting_entries(entries: DataFrame, key: str = "dataset_id") -> DataFrame:
    """(key, n_entries): keys that are listed with different entries."""
    return (
        entries.distinct().groupBy(key).agg(F.count("*").alias("n_entries")).where("n_entries > 1")
    )
