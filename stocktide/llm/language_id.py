"""Language of texts: multinomial logistic regression on TF-IDF of character n-grams.

Letters are lower-cased, everything between them is one blank, and runs of one to three characters are
hashed to FEATURES numbers. Document frequencies come from all texts learnt from; the weights are fitted on a
bounded sample of them by follow-the-regularised-leader with both an L1 and an L2 penalty, and a
temperature fitted on other texts of the sample makes the probabilities honest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEATURES = 1 << 15
ORDERS = 3
#: Texts the weights and the temperature are fitted on, in all; as many of each language as there is room for.
SAMPLE_TEXTS = 3_000
#: Parts a language's rows are ranked in before they are ranked together.
SLICES = 64
EPOCHS = 3
RATE, SMOOTH, L1, L2 = 1.0, 1.0, 0.01, 0.01
UNDETERMINED = "und"
PIECE_CHARS = 1 << 20
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def letter_table() -> np.ndarray:
    """For each code point the lower-case letter it stands for, 0 if it is no letter."""
    table = np.zeros(0x110000, dtype=np.uint32)
    for code in range(len(table)):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


def _runs(text: str, letters: np.ndarray) -> np.ndarray:
    """The letters of a text with one 0 for each gap between them."""
    codes = letters[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    kept = codes > 0
    kept[1:] |= codes[:-1] > 0
    return codes[kept]


def counts(text: str, letters: np.ndarray) -> np.ndarray:
    """How often each feature is in a whole text. Long texts are counted in overlapping pieces."""
    total = np.zeros(FEATURES, dtype=np.int64)
    runs = _runs(text, letters)
    for low in range(0, len(runs), PIECE_CHARS):
        part = runs[low : low + PIECE_CHARS + ORDERS - 1].astype(np.uint64)
        mixed = np.full(len(part), ORDERS, dtype=np.uint64)
        for order in range(ORDERS):
            n = min(len(part) - order, PIECE_CHARS)
            if n <= 0:
                break
            mixed = mixed[: len(part) - order] + part[order:] * np.uint64(_ODD[order])
            spread = (mixed[:n] ^ (mixed[:n] >> np.uint64(29))) * np.uint64(_ODD[0])
            total += np.bincount((spread >> np.uint64(49)).astype(np.int64), minlength=FEATURES)
    return total


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _weighted(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their weights, of length 1 in all."""
    at = np.flatnonzero(found)
    value = (1 + np.log(found[at])) * idf[at]
    return at, value / np.linalg.norm(value) if len(at) else value


def _counting_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, n): in how many texts of one task a feature is; the feature -1 counts the texts."""
    letters, total, texts = letter_table(), np.zeros(FEATURES, dtype=np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            total += counts(text or "", letters) > 0
            texts += 1
    at = np.flatnonzero(total)
    features, n = np.append(at, -1).astype(np.int32), np.append(total[at], texts)
    yield pa.RecordBatch.from_arrays([pa.array(features), pa.array(n)], names=["feature", "n"])


def _extracting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, at, found): the counts of each text that has a letter."""
    letters = letter_table()
    for batch in batches:
        for lang, fits, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            found = counts(text or "", letters)
            at = np.flatnonzero(found)
            if len(at):
                values = [[lang], [fits], [at.astype(np.int32)], [found[at].astype(np.int32)]]
                kinds = [pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "fits", "at", "found"])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _follow_the_leader(rows: list, n_classes: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias from rows (class, features, values). Features whose sum of gradients stays within
    the L1 penalty have weight 0. The bias is a last feature, unpenalised."""
    z, squares = np.zeros((FEATURES + 1, n_classes)), np.zeros((FEATURES + 1, n_classes))
    l1 = np.full((FEATURES + 1, 1), L1)
    l1[-1] = 0

    def weights(at):
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1[at], 0)
        return -shrunk / ((SMOOTH + np.sqrt(squares[at])) / RATE + L2)

    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, at, value = rows[i]
            at, value = np.append(at, FEATURES), np.append(value, 1.0)
            w = weights(at)
            p = _softmax(value @ w)
            p[label] -= 1
            gradient = value[:, None] * p[None, :]
            grown = squares[at] + gradient**2
            z[at] += gradient - (np.sqrt(grown) - np.sqrt(squares[at])) / RATE * w
            squares[at] = grown
    found = weights(np.arange(FEATURES + 1))
    return found[:-1], found[-1]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """What to divide logits by for the best likelihood of the labels, by golden-section search."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(50):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def learn(docs: DataFrame) -> LanguageModel:
    """Fit on `docs` (doc_id, text, lang); rows without lang teach nothing.

    Document frequencies cover all rows. The sample has SAMPLE_TEXTS rows at most, shared alike by the languages,
    the rows of lowest hash; a fifth of it is kept for the temperature. Of more than SAMPLE_TEXTS languages those with
    the most rows are learnt, ties by name. Without rows no language is learnt.
    """
    known = docs.where("lang is not null").select(
        F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.xxhash64("doc_id", F.xxhash64("text")).alias("key"),
    )
    totals = known.select("text").mapInArrow(_counting_texts, "feature int, n bigint").groupBy("feature")
    frequency = {r.feature: r.n for r in totals.agg(F.sum("n").alias("n")).collect()}  # FEATURES + 1 rows
    texts = frequency.pop(-1, 0)
    df = np.zeros(FEATURES)
    df[list(frequency)] = list(frequency.values())
    idf = np.log((1 + texts) / (1 + df)) + 1
    frequent = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE_TEXTS)
    languages = tuple(sorted(r.lang for r in frequent.collect()))
    share = max(1, SAMPLE_TEXTS // max(1, len(languages)))
    # Keys are ranked without their texts, which are then looked up for the SAMPLE_TEXTS keys at most. First within
    # slices of a language, so that a frequent one has SLICES * share keys at most in the task that ranks it.
    slice_of = F.pmod("key", F.lit(SLICES))
    at = lambda *group: F.row_number().over(Window.partitionBy("lang", *group).orderBy("key"))
    keys = known.where(F.col("lang").isin(*languages)).select("lang", "key").distinct().withColumn("slice", slice_of)
    keys = keys.withColumn("at", at("slice")).where(F.col("at") <= share).withColumn("at", at())
    chosen = known.join(F.broadcast(keys.where(F.col("at") <= share)), ["lang", "key"], "left_semi")
    fits = F.pmod(F.xxhash64("key"), F.lit(5)) > 0
    schema = "lang string, fits boolean, at array<int>, found array<int>"
    rows = chosen.select("lang", fits.alias("fits"), "text").mapInArrow(_extracting, schema).collect()
    number = {lang: i for i, lang in enumerate(languages)}
    fitted, kept = [], []
    for r in sorted(rows, key=lambda r: (r.lang, r.at, r.found)):
        found = np.zeros(FEATURES, dtype=np.int64)
        found[r.at] = r.found
        (fitted if r.fits else kept).append((number[r.lang], *_weighted(found, idf)))
    weights, bias = _follow_the_leader(fitted, max(1, len(languages)))
    logits = np.array([value @ weights[at] + bias for _, at, value in kept]).reshape(len(kept), len(bias))
    temperature = _temperature(logits, np.array([label for label, _, _ in kept], dtype=int))
    return LanguageModel(languages, idf, weights, bias, temperature)


def _predicting(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        for batch in batches:
            predicted, scores = [], []
            for text in batch.column(1).to_pylist():
                at, value = _weighted(counts(text or "", letters), model.idf)
                if not len(at) or not model.languages:
                    predicted.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                p = _softmax((value @ model.weights[at] + model.bias) / model.temperature)
                predicted.append(model.languages[int(p.argmax())])
                scores.append(float(p.max()))
            arrays = [batch.column(0), pa.array(predicted, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of `docs` (doc_id, text).

    The score is the probability of the language. A null text, one without letters, and every text where nothing
    was learnt is `und` with score 0. Equal probabilities go to the language that is first in order. Rows that
    repeat an id stay separate; other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return texts.mapInArrow(_predicting(model), "doc_id bigint, lang_pred string, score double")
