"""Document store: JSON, nulls written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LINES, PER_SLUG = "lines", "per_slug"
FOLDER_COLUMN = "document"


def write_documents(documents: DataFrame, folder: str, layout: str = LINES) -> None:
    """One JSON document per line.

    `lines` puts many documents in one file, files in order of slug; it suits any number of
    documents. `per_slug` gives each document a folder of its own, `document=<slug>/`, for a site that
    fetches them one by one.
    """
    if layout == LINES:
        rows, parts = documents.repartitionByRange("slug").sortWithinPartitions("slug"), []
    elif layout == PER_SLUG:
        rows, parts = documents.withColumn(FOLDER_COLUMN, F.col("slug")), [FOLDER_COLUMN]
    else:
        raise ValueError(f"unknown layout {layout}")
    rows.write.mode("overwrite").option("ignoreNullFields", False).partitionBy(*parts).json(folder)


def write_lines(rows: DataFrame, folder: str) -> None:
    """Any rows as JSON lines in their present order, such as the index."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(folder)


def json_text(documents: DataFrame) -> DataFrame:
    """Each document as one JSON string."""
    everything = F.struct(*documents.columns)
    return documents.select(F.to_json(everything, {"ignoreNullFields": "false"}).alias("value"))


def read_documents(spark: SparkSession, folder: str, schema, multi_line: bool = False) -> DataFrame:
    """Published documents; `multi_line` for files that hold one indented document each."""
    rows = spark.read.schema(schema).option("multiLine", multi_line).json(folder)
    return rows.drop(FOLDER_COLUMN)
