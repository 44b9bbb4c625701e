"""Warehouse store: three dimensions, one fact table and its attributes in Parquet.

Each build has a name. Its dimensions stand below `builds`, the partitions (list type and year) it wrote of the facts
and of their distinct attributes below `facts` and `attributes`. `published` lists the finished builds, a row
appended for each in one commit, with the partitions it consists of: those it wrote, and those it took over from
earlier builds. Readers follow the newest row and stay on it. `expire` removes builds that no recent row names.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.star import Star
from ..schemas import ATTRIBUTE, DIM_DATE, DIM_HOSPITAL, DIM_SPECIALTY, FACT

SCHEMAS = {"dim_date": DIM_DATE, "dim_hospital": DIM_HOSPITAL, "dim_specialty": DIM_SPECIALTY}
#: (id, key) of each dimension.
KEYS = {
    "dim_date": ("date_id", "archive_date"),
    "dim_hospital": ("hospital_id", "hospital_name"),
    "dim_specialty": ("specialty_id", "specialty_name"),
}
FACT_TABLE = "fact_waiting_list"
FACTS, ATTRIBUTE_ROWS = "facts", "attributes"
PARTITIONED = {FACTS: FACT, ATTRIBUTE_ROWS: ATTRIBUTE}
PUBLISHED = (
    "build string, published_at bigint, has_registry boolean, last_fact_id bigint, "
    "parts array<struct<list_type string, source_year_key string, source string, facts string, attributes string>>"
)


@dataclass(frozen=True)
class Part:
    """A partition of a build: what it was made from, and the builds that wrote its rows.

    One without a list type and year stands for all partitions of its build.
    """

    list_type: str | None
    source_year_key: str | None
    source: str | None
    facts: str
    attributes: str

    @property
    def key(self) -> tuple[str | None, str | None]:
        return self.list_type, self.source_year_key


@dataclass(frozen=True)
class Build:
    warehouse: str
    name: str
    parts: tuple[Part, ...] = ()
    has_registry: bool = False
    last_fact_id: int = -1

    @property
    def folder(self) -> str:
        return f"{self.warehouse}/builds/{self.name}"


def new_build(warehouse: str) -> Build:
    """A name for one build; nothing is created yet."""
    return Build(warehouse, uuid.uuid4().hex)


def publish(spark: SparkSession, build: Build) -> None:
    """Make a finished build the one that readers see."""
    parts = [(*p.key, p.source, p.facts, p.attributes) for p in build.parts]
    row = [(build.name, time.time_ns(), build.has_registry, build.last_fact_id, parts)]
    spark.createDataFrame(row, PUBLISHED).coalesce(1).write.mode("append").parquet(f"{build.warehouse}/published")


def _listed(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.schema(PUBLISHED).parquet(f"{warehouse}/published")


def published_build(spark: SparkSession, warehouse: str) -> Build | None:
    """The newest published build; none of a warehouse that was never built."""
    try:
        listed = _listed(spark, warehouse)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    row = listed.agg(F.max_by(F.struct("*"), "published_at").alias("of")).first().of
    return Build(warehouse, row.build, tuple(Part(*p) for p in row.parts), row.has_registry, row.last_fact_id)


def write_dimension(dim: DataFrame, build: Build, name: str) -> None:
    dim.write.mode("overwrite").parquet(f"{build.folder}/{name}")


def write_fact(fact: DataFrame, build: Build) -> int | None:
    """Partitioned by list type and year, which every query filters or sums by. Returns the largest fact id.

    Inside a partition files are sized at run time (a year with most of the rows is split) and
    sorted by hospital and date, so that a query for one hospital skips row groups.
    """
    seen = Observation()
    (
        fact.observe(seen, F.max("fact_id").alias("last"))
        .hint("rebalance", "list_type", "source_year_key")
        .sortWithinPartitions("list_type", "source_year_key", "hospital_id", "date_id")
        .write.mode("overwrite")
        .partitionBy("list_type", "source_year_key")
        .parquet(f"{build.warehouse}/{FACTS}/build={build.name}")
    )
    return seen.get["last"]


def write_attributes(attributes: DataFrame, build: Build) -> None:
    """Partitioned like the facts; the tasks that made them distinct write them, without another shuffle."""
    (
        attributes.write.mode("overwrite")
        .partitionBy("list_type", "source_year_key")
        .parquet(f"{build.warehouse}/{ATTRIBUTE_ROWS}/build={build.name}")
    )


def read_dimension(spark: SparkSession, build: Build, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{build.folder}/{name}")


def read_registry(spark: SparkSession, build: Build, name: str) -> DataFrame:
    """(id, key) of every name that ever had an id. A build without a registry gave all its ids itself."""
    if not build.has_registry:
        return read_dimension(spark, build, name).select(*KEYS[name])
    schema = SCHEMAS[name]
    kinds = ", ".join(f"{c} {schema[c].dataType.simpleString()}" for c in KEYS[name])
    return spark.read.schema(kinds).parquet(f"{build.folder}/ids_{name}")


def write_registry(ids: DataFrame, build: Build, name: str) -> None:
    ids.write.mode("overwrite").parquet(f"{build.folder}/ids_{name}")


def read_parts(spark: SparkSession, build: Build, table: str) -> DataFrame:
    """The rows of a build's partitions of `facts` or `attributes`, whichever builds wrote them.

    Only folders of those builds are listed, and the condition on partition columns leaves out the files of
    partitions that later builds wrote again. There are as many parts as list types and years.
    """
    schema, root = PARTITIONED[table], f"{build.warehouse}/{table}"
    builds = sorted({getattr(part, table) for part in build.parts})
    if builds == [build.name]:  # all it wrote is its own
        return spark.read.schema(schema).parquet(f"{root}/build={build.name}").select(*schema.fieldNames())
    rows = (
        spark.read.schema(StructType([*schema.fields, StructField("build", StringType())]))
        .option("basePath", root)
        .parquet(*[f"{root}/build={name}" for name in builds])
    )
    written = F.concat_ws("/", "build", "list_type", "source_year_key")
    wanted = [f"{getattr(part, table)}/{part.list_type}/{part.source_year_key}" for part in build.parts]
    return rows.where(written.isin(wanted)).select(*schema.fieldNames())


def star_of(spark: SparkSession, build: Build) -> Star:
    dims = [read_dimension(spark, build, name) for name in SCHEMAS]
    return Star(*dims, read_parts(spark, build, FACTS))


def read_star(spark: SparkSession, warehouse: str) -> Star:
    """The newest published build."""
    build = published_build(spark, warehouse)
    if build is None:
        raise ValueError(f"nothing has been built in {warehouse}")
    return star_of(spark, build)


def expire(spark: SparkSession, warehouse: str, keep: int = 2) -> list[str]:
    """Remove published builds that none of the `keep` newest rows name; returns the names of those removed.

    A build goes whole: as long as one of its partitions is in use, all of them stay. Builds that are not
    published, because they are still being written, are left alone. Readers of a build that goes lose its files.
    """
    # As many rows as there were builds.
    rows = _listed(spark, warehouse).orderBy(F.desc("published_at")).collect()
    used = {row.build for row in rows[:keep]}
    for row in rows[:keep]:
        used |= {name for part in row.parts for name in (part.facts, part.attributes)}
    hadoop, removed = spark._jvm.org.apache.hadoop.fs, []
    for name in dict.fromkeys(row.build for row in rows if row.build not in used):
        gone = False
        for folder in (f"builds/{name}", f"{FACTS}/build={name}", f"{ATTRIBUTE_ROWS}/build={name}"):
            path = hadoop.Path(f"{warehouse}/{folder}")
            gone |= path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        removed += [name] if gone else []
    return removed


def register_star(star: Star) -> None:
    """Expose the four tables to SQL under their own names."""
    star.dim_date.createOrReplaceTempView("dim_date")
    star.dim_hospital.createOrReplaceTempView("dim_hospital")
    star.dim_specialty.createOrReplaceTempView("dim_specialty")
    star.fact.createOrReplaceTempView(FACT_TABLE)


def table_counts(star: Star) -> DataFrame:
    """Rows per table."""
    tables = {
        "dim_date": star.dim_date,
        "dim_hospital": star.dim_hospital,
        "dim_specialty": star.dim_specialty,
        FACT_TABLE: star.fact,
    }
    counts = [
        table.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, table in tables.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])
