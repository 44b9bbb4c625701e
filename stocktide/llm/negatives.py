"""Hard negatives: for an anchor and each of its nearest rows of one label, rows of other labels that score almost as high.

Scores are inner products of whole-number vectors. Every row is stored with its norm and its angles to some
reference directions. The angle between two vectors lies between the largest difference and the smallest
sum of their angles to a reference, so that the stored angles give an interval of their cosine and, times the
norms, bounds of their score. They are widened by more than rounding can take. Only pairs whose bounds reach into a
window that is still open (a score that can enter the best so far) are scored, in whole numbers.

Rows are laid out by their closest reference and the angle to it. What lies together has similar angles, and
a group of rows is passed over whole where the bounds of all of them miss the windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.tables import written
from stocktide.shared_dir import new_folder

SCALE = 256
REFERENCES = 16
#: Rows whose ids hash lowest: references are chosen among them, and they give the first bounds.
SAMPLE = 2_000
#: Anchors looked up in one pass over all rows.
ANCHOR_BLOCK = 2_048
#: Rows that are compared with the anchors at one time.
GROUP = 512
#: More than stored angles, in single precision, and arccosines near 0 can be off by.
SLACK = 4e-6
ROW_COLUMNS = "vec_id bigint, label string, vector array<double>, norm double, angles array<float>, near int, apart float"
PAIR_COLUMNS = "anchor int, place int, vec_id bigint, score bigint"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths, also of vectors whose squares leave the range of doubles."""
    largest = np.abs(vectors).max(axis=1, initial=0)
    scaled = vectors / np.where(largest > 0, largest, 1)[:, None]
    return np.linalg.norm(scaled, axis=1) * largest


def _angles(vectors: np.ndarray, references: np.ndarray) -> np.ndarray:
    """(rows, references). A zero vector gets right angles; its norm makes its bounds zero."""
    largest = np.abs(vectors).max(axis=1, initial=0)
    scaled = vectors / np.where(largest > 0, largest, 1)[:, None]
    norms = np.linalg.norm(scaled, axis=1)
    cosines = scaled @ references.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(cosines, -1, 1))


def _references(sample: np.ndarray) -> np.ndarray:
    """Unit directions of the sample, each as far as can be from those chosen before."""
    norms = _norms(sample) if len(sample) else np.zeros(0)
    usable = sample[norms > 0]
    if not len(usable):
        return np.eye(1, sample.shape[1])
    unit = usable / np.abs(usable).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    chosen, closest = [unit[0]], np.abs(unit @ unit[0])
    while len(chosen) < min(REFERENCES, len(unit)):
        chosen.append(unit[int(closest.argmin())])
        closest = np.maximum(closest, np.abs(unit @ chosen[-1]))
    return np.array(chosen)


def _measuring(references: np.ndarray):
    """Rows as ROW_COLUMNS."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            with np.errstate(over="ignore"):
                vectors = np.floor(_matrix(batch.column(2)) * SCALE)
            whole = np.isfinite(vectors).all(axis=1)
            vectors, kept = vectors[whole], batch.filter(pa.array(whole))
            angles = _angles(vectors, references).astype(np.float32)
            near = angles.argmin(axis=1) if len(angles) else np.zeros(0, dtype=np.int64)
            lists = lambda m, kind: pa.ListArray.from_arrays(
                np.arange(0, m.size + 1, max(m.shape[1], 1), dtype=np.int32), pa.array(m.ravel(), kind)
            )
            arrays = [kept.column(0), kept.column(1), lists(vectors, pa.float64()), pa.array(_norms(vectors)),
                      lists(angles, pa.float32()), pa.array(near.astype(np.int32)),
                      pa.array(angles[np.arange(len(near)), near], pa.float32())]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in ROW_COLUMNS.split(", ")])

    return run


@dataclass(frozen=True)
class _Anchors:
    """Anchors of one pass. For each of `places` lists of anchor i, open[i, p] is whether there is one, low and
    high[i, p] are the scores it takes; it ends with the `most` best, of which least[i, p] is a lower bound."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    angles: np.ndarray
    same_label: bool
    exact: bool
    most: int
    open: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray


def score_bounds(low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores from bounds of angles and of the products of norms, rounded outwards."""
    up = np.cos(np.maximum(low - SLACK, 0))
    down = np.cos(np.minimum(high + SLACK, np.pi))
    with np.errstate(invalid="ignore", over="ignore"):
        top = np.where(up >= 0, up * most, up * least)
        bottom = np.where(down >= 0, down * least, down * most)
        top, bottom = top + np.abs(top) * 1e-9 + 1, bottom - np.abs(bottom) * 1e-9 - 1
    return np.where(np.isnan(bottom), -np.inf, bottom), np.where(np.isnan(top), np.inf, top)


def angle_bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the angle between each anchor and each row, from their angles to the references: of an anchor
    (anchors, references), and of a row between `low` and `high` (rows, references)."""
    least = np.zeros((len(anchors), len(low)))
    most = np.full((len(anchors), len(low)), np.pi)
    for j in range(anchors.shape[1]):
        own = anchors[:, j, None]
        np.maximum(least, own - high[None, :, j], out=least)
        np.maximum(least, low[None, :, j] - own, out=least)
        np.minimum(most, own + high[None, :, j], out=most)
        np.minimum(most, 2 * np.pi - own - low[None, :, j], out=most)
    return least, most


def _scores(vectors: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products in whole numbers: of doubles where no sum can leave the whole numbers they hold."""
    if exact:
        return (vectors @ anchor).astype(np.int64)
    other = [int(x) for x in anchor]
    return np.array([sum(int(x) * y for x, y in zip(v, other)) for v in vectors], dtype=object)


class _Best:
    """The best rows found so far of every list."""

    def __init__(self, anchors: _Anchors):
        self.anchors, self.least = anchors, anchors.least.copy()
        self.found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def _reach(self, bottom: np.ndarray, top: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Whether bounds reach into an open window of the anchors `some`: (anchors, rows)."""
        a, out = self.anchors, np.zeros(top.shape, dtype=bool)
        for p in range(a.open.shape[1]):
            from_ = np.maximum(a.low[some, p], self.least[some, p])[:, None]
            out |= a.open[some, p, None] & (top >= from_) & (bottom <= a.high[some, p, None])
        return out

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, norms: np.ndarray, angles: np.ndarray) -> None:
        a = self.anchors
        whole = angle_bounds(a.angles, angles.min(axis=0)[None], angles.max(axis=0)[None])
        every = np.arange(len(a.ids))
        group = score_bounds(*whole, a.norms[:, None] * norms.min(), a.norms[:, None] * norms.max())
        some = np.flatnonzero(self._reach(*group, every)[:, 0])
        if not len(some):
            return
        product = a.norms[some, None] * norms[None]
        bounds = score_bounds(*angle_bounds(a.angles[some], angles, angles), product, product)
        reach = self._reach(*bounds, some)
        reach &= (a.labels[some, None] == labels[None]) == a.same_label
        reach &= a.ids[some, None] != ids[None]
        for i, row in zip(some[reach.any(axis=1)], reach[reach.any(axis=1)]):
            near = np.flatnonzero(row)
            self.scored += len(near)
            self._keep(int(i), ids[near], _scores(vectors[near], a.vectors[i], a.exact))

    def _keep(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        a = self.anchors
        for p in np.flatnonzero(a.open[i]):
            from_ = max(a.low[i, p], self.least[i, p])
            mine = (scores >= from_) & (scores <= a.high[i, p])
            if not mine.any():
                continue
            old = self.found.get((i, int(p)), (ids[:0], scores[:0]))
            every_id, every = np.concatenate([old[0], ids[mine]]), np.concatenate([old[1], scores[mine]])
            order = sorted(range(len(every)), key=lambda j: (-every[j], every_id[j])) if not a.exact else (
                np.lexsort((every_id, -every)))
            order = order[: a.most]
            self.found[i, int(p)] = every_id[order], every[order]
            if len(order) == a.most:
                self.least[i, p] = max(self.least[i, p], every[order[-1]])

    def rows(self) -> pa.RecordBatch:
        flat = [(i, p, d, int(s)) for (i, p), (ids, scores) in self.found.items() for d, s in zip(ids.tolist(), scores)]
        columns = list(zip(*flat)) or [()] * 4
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "place", "vec_id", "score"]
        )


def _searching(anchors: _Anchors):
    """The best rows of one task for every list of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(anchors)
        for batch in batches:
            for low in range(0, len(batch), GROUP):
                part = batch.slice(low, GROUP)
                ids, labels = part.column(0).to_numpy(), part.column(1).to_numpy(zero_copy_only=False)
                best.add(ids, labels, _matrix(part.column(2)), part.column(3).to_numpy(), _matrix(part.column(4)))
        yield best.rows()

    return run


def _first(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _seeded(anchors: _Anchors, sample: tuple) -> _Anchors:
    """With the scores that the sample alone reaches."""
    best = _Best(anchors)
    for low in range(0, len(sample[0]), GROUP):
        best.add(*(part[low : low + GROUP] for part in sample))
    return replace(anchors, least=best.least)


def _whole(x: np.ndarray, percent: int, up: bool) -> np.ndarray:
    """percent / 100 of whole numbers, rounded to whole numbers; as Python's, of any size."""
    return np.array([[-(-int(v) * percent // 100) if up else int(v) * percent // 100 for v in row] for row in x], dtype=object)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of `vectors`
    (vec_id, label, embedding) for which `is_anchor` holds.

    A component x counts as floor(SCALE * x); a score is the inner product of two such vectors. Higher scores come
    first, equal ones by smaller vec_id. The `positives` best rows of the anchor's label and another vec_id are its
    positives; for each the `negatives` best rows of other labels are returned whose score is from `low` to
    `high` percent of the positive's. A score below zero has no such rows.

    Rows with a null vec_id, label or vector, and vectors that are empty or hold a null or non-finite component, or one
    that times SCALE is none, take no part, nor do vectors of another length than most have. Rows that repeat
    an id are rows of their own and may each be a positive or negative; the same anchor twice counts once. Fewer
    rows come where there are fewer; an empty table gives none. Other columns are ignored. A score that does not fit
    in 64 bits raises.
    """
    spark = vectors.sparkSession
    as_double = F.col("embedding").cast("array<double>")
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
        & F.forall(as_double, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    )
    rows = vectors.where(usable).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"),
        as_double.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    usual = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    width = usual["size"] if usual else 1
    rows = rows.where(F.size("vector") == width)
    lowest = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector")
    sample = np.array([r.vector for r in lowest.collect()], dtype=np.float64).reshape(-1, width)
    with np.errstate(over="ignore"):
        floored = np.floor(sample * SCALE)
    references = _references(floored[np.isfinite(floored).all(axis=1)])
    plain = rows.select("vec_id", "label", "vector")
    measured = written(plain.mapInArrow(_measuring(references), ROW_COLUMNS), "measured")
    by_angle = ["near", "apart", "vec_id"]
    laid = written(measured.repartitionByRange(*by_angle).sortWithinPartitions(*by_angle), "laid")
    stored = laid.drop("near", "apart")
    # No partial sum of an inner product is larger than the product of the norms.
    exact = (laid.agg(F.max("norm")).first()[0] or 0) ** 2 < 2**53
    chosen = rows.where("is_anchor").select("vec_id", "label", "vector").distinct()
    asked = written(chosen.mapInArrow(_measuring(references), ROW_COLUMNS), "anchors").drop("near", "apart")
    seeds = _arrays(stored.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE), len(references), width)
    folder, n = new_folder(spark, "negatives"), -(-asked.count() // ANCHOR_BLOCK)
    for number in range(n):
        mine = asked.where(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(n)) == number)
        found = _one_pass(stored, _arrays(mine, len(references), width), seeds, exact, positives, negatives, low, high)
        if found is not None:
            found.write.parquet(f"{folder}/part={number}")
    columns = (
        "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    )
    empty = spark.createDataFrame([], columns)
    empty.write.parquet(f"{folder}/part={n}")
    return spark.read.schema(columns).parquet(folder).drop("part")


def _arrays(rows: DataFrame, references: int, width: int) -> tuple:
    """Rows as ROW_COLUMNS up to `angles`, of which there are boundedly many, as arrays."""
    table = rows.toArrow().combine_chunks()
    if not len(table):
        return (np.zeros(0, np.int64), np.zeros(0, object), np.zeros((0, width)), np.zeros(0), np.zeros((0, references)))
    columns = [table.column(i).combine_chunks() for i in range(5)]
    return (columns[0].to_numpy(), columns[1].to_numpy(zero_copy_only=False), _matrix(columns[2]),
            columns[3].to_numpy(), _matrix(columns[4]))


def _one_pass(stored, asked, seeds, exact, positives, negatives, low, high) -> DataFrame | None:
    """The negatives of the anchors `asked`."""
    n, spark = len(asked[0]), stored.sparkSession
    if not n:
        return None
    whole = np.full((n, 1), np.inf)
    first = _Anchors(*asked, True, exact, positives, np.ones((n, 1), dtype=bool), -whole, whole, -whole)
    found = stored.mapInArrow(_searching(_seeded(first, seeds)), PAIR_COLUMNS)
    # At most `positives` rows for each anchor of the pass.
    near = _first(found, positives).select("anchor", "rank", "vec_id", "score").collect()
    score = np.zeros((n, positives), dtype=object)
    there = np.zeros((n, positives), dtype=bool)
    for r in near:
        score[r.anchor, r["rank"] - 1] = r.score
        there[r.anchor, r["rank"] - 1] = r.score >= 0
    from_, to = _whole(score, low, up=True), _whole(score, high, up=False)
    if exact:
        from_, to = from_.astype(np.float64), to.astype(np.float64)
    second = _Anchors(*asked, False, exact, negatives, there, from_, to, np.full(there.shape, -np.inf))
    found = stored.mapInArrow(_searching(_seeded(second, seeds)), PAIR_COLUMNS)
    pairs = [(r.anchor, r["rank"] - 1, int(asked[0][r.anchor]), r.vec_id, r.score) for r in near]
    of_list = "anchor int, place int, anchor_id bigint, positive_id bigint, positive_score bigint"
    named = F.broadcast(spark.createDataFrame(pairs, of_list))  # as many rows as `near`
    return _first(found, negatives).join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
