"""Building the star schema, whole or by the partitions that changed."""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import HOSPITAL_ALIASES
from ..operators.star import (
    ATTRIBUTES,
    Star,
    build_dim_date,
    build_dim_hospital,
    build_dim_specialty,
    build_fact,
    by_entity,
    stable_ids,
)
from ..shared_dir import fixed
from ..sources import ledger
from ..sources.catalogue import list_type_of
from ..sources.warehouse_store import (
    ATTRIBUTE_ROWS,
    KEYS,
    Build,
    Part,
    new_build,
    publish,
    published_build,
    read_dimension,
    read_parts,
    read_registry,
    read_star,
    star_of,
    write_attributes,
    write_dimension,
    write_fact,
    write_registry,
)
from .harmonise import store_tables, unify, unify_entities

DIMENSIONS = {
    "dim_date": build_dim_date,
    "dim_hospital": build_dim_hospital,
    "dim_specialty": build_dim_specialty,
}
#: Raise it when harmonising gives other rows than before, so that no partition is taken over from earlier builds.
RULES = 1


def _side_by_side(write, items) -> None:
    items = list(items)
    with ThreadPool(len(items)) as pool:  # their jobs do not depend on each other
        pool.map(write, items)


def build_dimensions(attributes: DataFrame, build: Build, before: Build | None = None) -> list[DataFrame]:
    """Write the dimensions of ATTRIBUTES `by_entity`, and read them back.

    Ids are dense and in the order of names; after a build `before` they are its ids, and the next ones for new names.
    """
    spark = attributes.sparkSession

    def write(item):
        name, make = item
        if before is None:
            return write_dimension(make(attributes), build, name)
        column, key = KEYS[name]
        known = read_registry(spark, before, name)
        write_registry(stable_ids(_names(attributes, name), known, key, column), build, name)
        write_dimension(make(attributes, ids=read_registry(spark, build, name)), build, name)

    _side_by_side(write, DIMENSIONS.items())
    return [read_dimension(spark, build, name) for name in DIMENSIONS]


def _names(attributes: DataFrame, name: str) -> DataFrame:
    """The keys that a dimension of the attributes has: dates of all rows, names of unsuppressed ones."""
    if name == "dim_date":
        key, rows = F.col("archive_date_parsed").alias("archive_date"), attributes
    else:
        key, rows = F.col(KEYS[name][1]), attributes.where("not is_suppressed_bucket")
    return rows.select(key).where(key.isNotNull()).distinct()


def build_warehouse(
    unified: DataFrame, warehouse: str, attributes: DataFrame | None = None, sources: dict | None = None
) -> Star:
    """Write the dimensions, then the fact, publish them together, and read them back.

    The fact joins the written dimensions, whose file sizes tell Spark whether to broadcast them. Each
    build has folders of its own: readers, and a build that fails, never see new names with old ids.
    `attributes` are the ATTRIBUTES of `unified`, `by_entity`, if there is a cheaper way to them than its rows. `sources`
    says what each (list type, year) was made from, {(list type, year): text}, for `update` to go by.
    """
    spark, build = unified.sparkSession, new_build(warehouse)
    if attributes is None:
        attributes = by_entity(unified.select(*ATTRIBUTES))
    made = sources or {(None, None): None}
    build = replace(build, parts=tuple(Part(*key, source, build.name, build.name) for key, source in made.items()))
    write_attributes(attributes, build)
    dims = build_dimensions(read_parts(spark, build, ATTRIBUTE_ROWS), build)
    last = write_fact(build_fact(unified, *dims), build)
    build = replace(build, last_fact_id=-1 if last is None else last)
    publish(spark, build)
    return star_of(spark, build)


def _rules_of(aliases) -> str:
    """What besides the raw rows decides how they are harmonised: our rules, and the aliases in any order."""
    if isinstance(aliases, dict):
        return f"{RULES}/{hashlib.sha256(json.dumps(sorted(aliases.items())).encode()).hexdigest()}"
    hashed = F.xxhash64("alias", "canonical").cast("decimal(38,0)")
    row = aliases.agg(F.count("*").alias("n"), F.sum(hashed).alias("sum")).first()
    return f"{RULES}/{row.n}/{row.sum}"


def sources_of(spark: SparkSession, raw: str, aliases=HOSPITAL_ALIASES) -> dict[tuple[str, str], str]:
    """{(list type, year): what the store would make that partition from}, by the ledger; no data is read."""
    rules = _rules_of(aliases)
    rows = ledger.partition_sources(ledger.read_ledger(spark, raw)).collect()
    return {(row.list_type, row.source_year_key): f"{rules}/{row.source}" for row in rows}


def rebuild(spark: SparkSession, raw: str, warehouse: str, aliases=HOSPITAL_ALIASES) -> Star:
    """Raw store -> warehouse, in two reads of the store: its attributes, then its counts."""
    sources = sources_of(spark, raw, aliases)
    tables = store_tables(spark, raw)
    return build_warehouse(unify(tables, aliases), warehouse, unify_entities(tables, aliases), sources)


def _of(keys, list_type, year):
    """The condition that a row is of one of the (list type, year)."""
    return F.concat_ws("/", list_type, year).isin([f"{a}/{b}" for a, b in keys])


def update(spark: SparkSession, raw: str, warehouse: str, aliases=HOSPITAL_ALIASES) -> Star:
    """Bring the warehouse up to the raw store by the partitions that changed; names and numbers as `rebuild` gives.

    A partition is read and written again if other publications of it were loaded since, or if it has suppressed
    rows of a name that came into a dimension or left it. All others are taken over as they lie there.
    Ids do not move: a new name gets the next one, and the id of a name that is gone is not given out again. With
    nothing new no build is made. A warehouse that was never built, or a store without a ledger, is built whole.
    """
    before, sources = published_build(spark, warehouse), sources_of(spark, raw, aliases)
    if before is None or not sources:
        return rebuild(spark, raw, warehouse, aliases)
    kept = {part.key: part for part in before.parts if part.source and sources.get(part.key) == part.source}
    changed = [key for key in sources if key not in kept]
    if not changed and len(kept) == len(before.parts):
        return read_star(spark, warehouse)
    tables, build = store_tables(spark, raw), new_build(warehouse)

    def raw_of(keys):
        mine = _of(keys, list_type_of(F.col("dataset")), F.col("year_key"))
        return {family: rows.where(mine) for family, rows in tables.items()}

    if changed:
        write_attributes(unify_entities(raw_of(changed), aliases), build)
    parts = {key: Part(*key, sources[key], build.name, build.name) for key in changed} | kept
    build = replace(build, parts=tuple(parts.values()), has_registry=True)
    attributes = read_parts(spark, build, ATTRIBUTE_ROWS)

    moved = []
    for name in ("dim_hospital", "dim_specialty"):
        # Names that only one of the two builds has: as many as changed, not as there are.
        names, key = _names(attributes, name), KEYS[name][1]
        past = read_dimension(spark, before, name).select(key)
        differ = fixed(names.exceptAll(past).union(past.exceptAll(names)))
        rows = attributes.where(F.col("is_suppressed_bucket") & _of(kept, F.col("list_type"), F.col("source_year_key")))
        found = rows.join(differ, key, "left_semi").select("list_type", "source_year_key").distinct()
        moved += [(row.list_type, row.source_year_key) for row in found.collect()]
    parts |= {key: replace(parts[key], facts=build.name) for key in moved}
    build = replace(build, parts=tuple(parts.values()))

    dims = build_dimensions(attributes, build, before)
    last = before.last_fact_id
    if changed or moved:
        fact = build_fact(unify(raw_of({*changed, *moved}), aliases), *dims)
        written = write_fact(fact.withColumn("fact_id", F.col("fact_id") + F.lit(last + 1)), build)
        last = last if written is None else written
    build = replace(build, last_fact_id=last)
    publish(spark, build)
    return star_of(spark, build)
