"""Registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.llm import language_id, quality
from stocktide.llm.ann import nearest
from stocktide.llm.chat_format import (
    DELTA,
    EDIT,
    LOSS_ROLE,
    MESSAGE,
    REGENERATE,
    loss_text,
    messages,
    parsed,
    rendered,
)
from stocktide.llm.decontaminate import find_passages
from stocktide.llm.license_scan import scan_licences, sentences
from stocktide.llm.near_dedup import near_duplicates
from stocktide.llm.negatives import hard_negatives
from stocktide.llm.oracle import SQL
from stocktide.llm.packing import pack
from stocktide.llm.pii import KINDS, find_personal_data
from stocktide.llm.ranking import ranked_search
from stocktide.llm.tables import table
from stocktide.llm.token_planes import token_round_trip
from stocktide.llm.warc import archive_round_trip

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


def _logged(log: DataFrame) -> DataFrame:
    """Events of a table of messages (conv_id, message, role, text): an answer is streamed in three pieces after a first
    try of half of it, any other message is written down by half and edited."""
    text = F.coalesce(F.col("text"), F.lit(""))
    third, half = F.ceil(F.length(text) / 3).cast("int"), F.substring(text, F.lit(1), F.ceil(F.length(text) / 2).cast("int"))
    unsaid = F.lit(None).cast("string")

    def event(kind: str, said: Column, role: Column = unsaid) -> Column:
        return F.struct(F.lit(kind).alias("kind"), role.alias("role"), said.alias("text"))

    pieces = [event(DELTA, F.substring(text, third * i + 1, third)) for i in range(3)]
    role, nothing = F.col("role"), F.lit("")
    answer = F.array(event(MESSAGE, nothing, role), event(DELTA, half), event(REGENERATE, nothing), *pieces)
    other = F.array(event(MESSAGE, half, role), event(EDIT, text))
    events = F.when(role == LOSS_ROLE, answer).otherwise(other)
    rows = log.select("conv_id", "message", F.posexplode(events).alias("at", "event"))
    return rows.select("conv_id", "message", (F.col("message") * 8 + F.col("at")).alias("seq"), "event.*")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of the table is a message, numbered by turn and logged in events, which are folded and rendered; what is
    returned is read from the rendering."""
    more = spark.createDataFrame(
        [(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    log = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    chats = rendered(messages(_logged(log.select("conv_id", place.alias("message"), "role", "text"))))
    turns, said = parsed(F.col("formatted")), loss_text(F.col("formatted"), F.col("loss_spans"))
    every = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id", F.size(turns).cast("bigint").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length(said).cast("bigint").alias("loss_chars"), F.sha2(said, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree source/lang/block/doc_id.txt, a thousand ids to a block. One that opens
    with a notice is the licence file source/lang/LICENSE-doc_id of all blocks there."""
    docs = table(spark, sf_dir, "documents")
    first = F.get(sentences(F.coalesce("text", F.lit(""))), F.lit(0))
    folder = F.concat_ws("/", F.coalesce("source", F.lit("_")), F.coalesce("lang", F.lit("_")))
    opens = first.rlike("(?i)^[^.]*(licensed|released) under ")
    plain = F.concat_ws("/", folder, F.floor(F.col("doc_id") / 1000), F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.when(opens, F.concat(folder, F.lit("/LICENSE-"), F.col("doc_id"))).otherwise(plain)
    return scan_licences(docs.select(path.alias("path"), "text"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 50 = 0"), k=5)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("bigint").alias("n_near_items"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = quality.held_out(F.col("doc_id"), 3, 1)
    found = language_id.predict(docs, language_id.learn(docs.where(~fold)))
    return found.select("doc_id", fold.alias("held_out"), "lang_pred", "score")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = '{k.name}')) as bigint)").alias(f"n_{k.name}")
        for k in KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.QualityModel:
    """Learnt from the labels outside the fold that is held out."""
    labels = table(spark, sf_dir, "labels").withColumnRenamed("quality", "label")
    return quality.learn(docs, labels.where(~quality.held_out(F.col("doc_id"), 5, 0)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.scores(docs, quality_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.REJECTED_BELOW).cast("int").alias("predicted"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark, table(spark, sf_dir, "pages"), revisit_from=0)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row against the anchors; every seventh id's label is moved on by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives(rows, F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


def op12_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(spark, table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query"), "text")
    found = ranked_search(table(spark, sf_dir, "documents"), items, k=50)
    return found.withColumnRenamed("query", "item_id")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_chat_format, op2_near_dedup, op3_license_scan, op4_packing, op5_nearest, op6_decontamination,
        op7_language_id, op8_pii, op9_quality, op10_warc, op11_hard_negatives, op12_token_planes, op13_ranked_search,
    )
}
