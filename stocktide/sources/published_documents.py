"""Documents published by content.

`<folder>/<kind>/version=...` holds JSON documents with their SHA-256, each written by the export that first had it.
`manifests/version=...` lists what an export consists of (kind, hash, the version that wrote it), and `published` the
exports, a row appended for each in one commit. Readers follow the newest, so that they see one export whole.
"""

from __future__ import annotations

import time
import uuid
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..shared_dir import fixed

MANIFEST = "kind string, sha256 string, written string"
PUBLISHED = "version string, published_at bigint"


def hashed(documents: DataFrame) -> DataFrame:
    """Documents with the hash of their JSON text, nulls written out; equal ones once."""
    text = F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"})
    return documents.withColumn("sha256", F.sha2(text, 256)).dropDuplicates(["sha256"])


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """What the newest export consists of; nothing if there was none."""
    try:
        listed = spark.read.schema(PUBLISHED).parquet(f"{folder}/published")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)
    newest = listed.agg(F.max_by("version", "published_at").alias("version")).first().version
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifests/version={newest}")


def publish_documents(spark: SparkSession, folder: str, kinds: dict[str, DataFrame]) -> dict[str, int]:
    """Write the documents that the newest export does not have, and make these the current ones.

    Returns the documents written of each kind. If all are there and no other is, nothing is written. Documents
    that are no longer current keep their files, which earlier exports name.
    """
    before, version = manifest(spark, folder), uuid.uuid4().hex

    def compare(item):
        kind, documents = item
        made = fixed(hashed(documents))  # compared and written, but computed once
        there = before.where(F.col("kind") == kind).drop("kind")
        new = made.join(there, "sha256", "left_anti")
        entries = made.select(F.lit(kind).alias("kind"), "sha256").join(there, "sha256", "left")
        counts = entries.agg(F.count("*").alias("n"), F.count_if(F.col("written").isNull()).alias("n_new")).first()
        if counts.n_new:
            rows = new.repartitionByRange("slug").sortWithinPartitions("slug") if "slug" in new.columns else new
            rows.write.option("ignoreNullFields", False).json(f"{folder}/{kind}/version={version}")
        named = F.coalesce("written", F.lit(version)).alias("written")
        return kind, entries.select("kind", "sha256", named), counts.n, counts.n_new

    with ThreadPool(len(kinds)) as pool:  # their jobs do not depend on each other
        compared = pool.map(compare, kinds.items())
    written = {kind: n_new for kind, _, _, n_new in compared}
    if sum(written.values()) or sum(n for _, _, n, _ in compared) != before.count():
        entries = compared[0][1]
        for _, more, _, _ in compared[1:]:
            entries = entries.unionByName(more)
        entries.write.parquet(f"{folder}/manifests/version={version}")
        row = spark.createDataFrame([(version, time.time_ns())], PUBLISHED)
        row.coalesce(1).write.mode("append").parquet(f"{folder}/published")
    return written


def read_published(spark: SparkSession, folder: str, kind: str, schema: StructType | str) -> DataFrame:
    """The current documents of a kind. As many folders are read as exports wrote some of them."""
    fields = spark.createDataFrame([], schema).schema
    mine = manifest(spark, folder).where(F.col("kind") == kind).select("sha256", F.col("written").alias("version"))
    versions = sorted(row.version for row in mine.select("version").distinct().collect())
    if not versions:
        return spark.createDataFrame([], fields)
    more = [StructField(name, StringType()) for name in ("sha256", "version")]
    rows = (
        spark.read.schema(StructType([*fields.fields, *more]))
        .option("basePath", f"{folder}/{kind}")
        .json([f"{folder}/{kind}/version={version}" for version in versions])
    )
    return rows.join(mine, ["sha256", "version"], "left_semi").select(*fields.fieldNames())
