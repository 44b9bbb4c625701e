"""Load newly landed publications, each once.

The stream reads which files have arrived, not their rows: a micro-batch names the datasets and years
that changed, and the latest publication of each replaces that year in the raw store. Files of one
publication may arrive over several batches, and a batch that runs twice writes the same partitions
again with the same rows, so a restart or a lost executor changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    BinaryType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from ..sources.landing import FOLDER_KEYS
from ..sources.raw_store import ingest

ARRIVALS = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
        *[StructField(name, StringType()) for name in FOLDER_KEYS],
    ]
)


def arrivals(spark: SparkSession, landing: str) -> DataFrame:
    """Stream of landed files; their content is never read."""
    files = spark.readStream.format("binaryFile").schema(ARRIVALS)
    return files.option("pathGlobFilter", "*.csv").load(landing).drop("content")


def ingest_arrivals(
    spark: SparkSession, landing: str, raw: str, checkpoint: str, rejects: str | None = None, **families
) -> StreamingQuery:
    """Load all that has landed since the last run, then stop. Wait with `awaitTermination`.

    Publications that cannot be loaded are appended to `rejects`, if given, each with its reason; the
    batch they are in loads the others and commits, and a corrected publication loads when it lands.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        changed = batch.select("dataset", "year_key").distinct()
        left_out = ingest(batch.sparkSession, landing, raw, changed, **families)
        if rejects is not None:
            left_out.write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")

    return (
        arrivals(spark, landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
