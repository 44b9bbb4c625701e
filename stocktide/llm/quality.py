"""Quality scores by compression.

Two zstandard dictionaries are built from samples of text labelled good and bad. A text is cut into
pieces that are each compressed with either dictionary, so that the dictionary tells as much at the end
of a long text as at its start. The difference of the sizes, bad minus good, for each byte of text is the
score, which logistic regression on other labelled texts turns into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stocktide.llm.text import slices, trimmed

PIECE_BYTES = 1024
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Bounds of what is learnt from, for each of the two labels.
LABELLED_TEXTS = 4_000
DICTIONARY_PIECES = 8_000
SLICE_BYTES = 4 << 20
REJECTED_BELOW = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries of good and bad text and the line from size difference to log-odds."""

    good: bytes
    bad: bytes
    intercept: float
    slope: float


def _pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode()
    return [data[i : i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]


def _dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary, or the pieces themselves where there are too few to train on."""
    if not pieces:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, pieces, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, **plain)
    loaded = zstandard.ZstdCompressionDict(dictionary)
    loaded.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=loaded, **plain)


def _differences(texts: list[str | None], good: bytes, bad: bytes) -> np.ndarray:
    """Bytes saved by the good dictionary over the bad one, for each byte of text; 0 of no text."""
    by_good, by_bad = _compressor(good).compress, _compressor(bad).compress
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        pieces = _pieces(text)
        if pieces:
            saved = sum(len(by_bad(p)) - len(by_good(p)) for p in pieces)
            out[i] = saved / sum(map(len, pieces))
    return out


def _fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Intercept and slope of weighted logistic regression, by Newton's method with a slight ridge."""
    design = np.column_stack([np.ones(len(x)), x])
    beta, ridge = np.zeros(2), np.diag([1e-3, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - ridge @ beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -20, 20)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, labels, texts = (batch.column(i).to_pylist() for i in range(3))
        rows = [(d, y, i, p) for d, y, t in zip(ids, labels, texts) for i, p in enumerate(_pieces(t))]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary())
        names = ["doc_id", "label", "number", "piece"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _comparing(good: bytes, bad: bytes, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _differences(batch.column(1).to_pylist(), good, bad)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], names=names)

    return run


def learn(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """Fit on `docs` (doc_id, text) and `labels` (doc_id, label 0 or 1).

    At most LABELLED_TEXTS texts of each label are looked at, those whose ids hash lowest: two thirds for
    the dictionaries (of their pieces, at most DICTIONARY_PIECES of each label), the rest to calibrate, weighted by how
    often each label occurs among all labels. Null ids and labels teach nothing. Without labels every
    score is 0.5; with one label only, all scores lean to it.
    """
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int"))
    known = known.where("doc_id is not null and label in (0, 1)")
    number = F.xxhash64("doc_id")
    lowest = [
        known.where(F.col("label") == label).orderBy(number, "doc_id").limit(LABELLED_TEXTS)
        for label in (0, 1)
    ]
    sample = lowest[0].union(lowest[1])
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    chosen = texts.join(F.broadcast(sample), "doc_id")  # 2 * LABELLED_TEXTS rows at most
    for_dictionary = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) > 0
    cut = chosen.where(for_dictionary).select("doc_id", "label", "text").mapInArrow(
        _cut, "doc_id bigint, label int, number int, piece binary"
    )
    pieces: dict[int, list[bytes]] = {}
    for label in (0, 1):
        spread = F.xxhash64("doc_id", "number")
        rows = cut.where(F.col("label") == label).orderBy(spread, "doc_id", "number")
        pieces[label] = [bytes(r.piece) for r in rows.limit(DICTIONARY_PIECES).select("piece").collect()]
    good, bad = _dictionary(pieces[1]), _dictionary(pieces[0])
    rest = chosen.where(~for_dictionary).select("label", "text").mapInArrow(
        _comparing(good, bad, ["label", "difference"]), "label int, difference double"
    )
    # As many as the sample has texts; ids that are repeated in `docs` could give more.
    rows = rest.orderBy(F.xxhash64("label", "difference")).limit(2 * LABELLED_TEXTS).collect()
    y = np.array([r.label for r in rows], dtype=float)
    x = np.array([r.difference for r in rows], dtype=float)
    counts = dict(known.groupBy("label").count().collect())
    if not len(y):
        total = [counts.get(0, 0), counts.get(1, 0)]
        return QualityModel(good, bad, float(np.log((total[1] + 1) / (total[0] + 1))), 0.0)
    weight = np.array([counts[int(v)] / max(1, (y == v).sum()) for v in y])
    weight *= len(y) / weight.sum()
    return QualityModel(good, bad, *_fit(x, y, weight))


def _scoring(model: QualityModel, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low, high in slices(whole.column(text_at), SLICE_BYTES):
                batch = whole.slice(low, high - low)
                found = _differences(batch.column(text_at).to_pylist(), model.good, model.bad)
                odds = np.clip(model.intercept + model.slope * found, -700, 700)
                score = pa.array(1 / (1 + np.exp(-odds)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, score], names=[*batch.schema.names, "score"]
                )

    return trimmed(run)


def with_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """All columns of `docs`, of which `text` is one, and `score`. A column of that name is replaced."""
    rows = docs.drop("score")
    schema = StructType([*rows.schema.fields, StructField("score", DoubleType())])
    return rows.mapInArrow(_scoring(model, rows.columns.index("text")), schema)


def scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score) of every row of `docs` (doc_id, text): the probability of a good label.

    Whole texts count. A null or empty text has difference 0 and gets the score that goes with it.
    Equal texts get equal scores, rows that repeat an id stay separate, other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    return with_scores(texts, model).select("doc_id", "score")


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether the CRC of an id as text falls in the fold that nothing is learnt from; a null's does not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))
