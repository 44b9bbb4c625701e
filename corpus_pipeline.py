"""The corpus pipeline: its stages in order, each reading what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm import quality
from stocktide.llm.decontaminate import find_passages
from stocktide.llm.near_dedup import near_duplicates
from stocktide.llm.packing import pack
from stocktide.llm.pii import sanitise
from stocktide.llm.queries import TOKENIZER, quality_model
from stocktide.llm.tables import row_keyed, scratch, table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the classifier, learnt from `labels`, does not reject."""
    scored = quality.with_scores(docs, quality_model(spark, docs, sf_dir))
    return scored.where(F.col("score") >= quality.REJECTED_BELOW).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that with the smallest doc_id, rows without one last.

    Rows are told apart by where they stand, so that rows of one id, or of none, are documents of their
    own: those with different texts all stay, and copies among them stay once. Rows without words are no
    copies and all stay.
    """
    rows = row_keyed(docs)
    with scratch(spark) as used:
        found = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"), shingle_words=5, percent=80)
        worded = found.where("n_shingles > 0").select(F.col("doc_id").alias("_row"), "component_id")
        worded = written(worded.join(rows.select("_row", F.col("doc_id").alias("_id")), "_row"), "found")
        rank = F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")
        first = worded.groupBy("component_id").agg(F.min(rank).alias("of")).select(F.col("of._row").alias("_row"))
        # Written, so that Spark knows how small it is before it decides to shuffle texts.
        dropped = used.keep(written(worded.select("_row").join(first, "_row", "left_anti"), "dropped"))
    return rows.join(dropped, "_row", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of `benchmark`, whatever other rows of their id hold."""
    rows = row_keyed(docs)
    with scratch(spark) as used:
        texts, items = rows.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")
        # Only exact passages count, so that proximity is not looked for.
        found = find_passages(texts, items, slack=-1).where("n_hit > 0")
        held = used.keep(written(found.select(F.col("doc_id").alias("_row")), "contaminated"))
    return rows.join(held, "_row", "left_anti").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind."""
    return sanitise(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids, placed in sequences."""
    return pack(docs, TOKENIZER, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
