"""Nearest vectors by cosine: a forest of random-projection trees, searched through one queue.

The trees are grown on the driver from a bounded sample, each node split at the median along the line
between two means of its points, started at random. Every vector is then routed to its leaf in every tree.
A query walks all trees at once: of all branches not taken the one whose worst margin is smallest comes
next, until the leaves reached hold enough vectors. These candidates are ranked by their exact cosine.

Leaves meet the queries that reach them in blocks of bounded size on either side, however full a leaf is.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors the trees are grown from, those whose ids hash lowest.
SAMPLE = 20_000
TREES = 10
LEAF = 100
#: A tree has 2^DEEPEST leaves at most, so that a search that is to reach a share of all vectors visits as
#: many leaves however many vectors there are.
DEEPEST = 7
#: A search ends when the leaves it reached hold this share of all vectors, counted in every tree, or this many.
SEARCH_SHARE = 0.8
SEARCH_LEAST = 2_000
MEMBER_BLOCK = 4_096
QUERY_BLOCK = 512


@dataclass(frozen=True)
class Forest:
    """Complete binary trees. `normals[t, i]` and `cuts[t, i]` split node i, whose children are 2i+1 and 2i+2."""

    depth: int
    normals: np.ndarray
    cuts: np.ndarray

    def leaves(self, unit: np.ndarray) -> np.ndarray:
        """The leaf of each row in each tree: (trees, rows)."""
        out = np.zeros((len(self.normals), len(unit)), dtype=np.int64)
        for t, (normals, cuts) in enumerate(zip(self.normals, self.cuts)):
            node = out[t]
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", unit, normals[node]) >= cuts[node]
                node = 2 * node + 1 + side
            out[t] = node - (2**self.depth - 1)
        return out

    def search(self, unit: np.ndarray, sizes: np.ndarray, enough: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of one queue over all trees, until `enough` vectors are held."""
        first_leaf, held, found = 2**self.depth - 1, 0, []
        queue = [(0.0, t, 0) for t in range(len(self.normals))]
        margins = self.normals @ unit - self.cuts
        while queue and held < enough:
            worst, t, node = heapq.heappop(queue)
            while node < first_leaf:
                margin = margins[t, node]
                near = 2 * node + 1 + int(margin >= 0)
                heapq.heappush(queue, (max(worst, abs(margin)), t, 4 * node + 3 - near))
                node = near
            held += sizes[t, node - first_leaf]
            found.append((t, node - first_leaf))
        return found


def _split(points: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """The direction between two means of the points, and the median along it."""
    few = points[rng.choice(len(points), min(len(points), 200), replace=False)]
    a, b = few[0], few[-1]
    for _ in range(4):
        closer = few @ a >= few @ b
        if closer.all() or not closer.any():
            break
        a, b = few[closer].mean(axis=0), few[~closer].mean(axis=0)
    direction = a - b
    length = np.linalg.norm(direction)
    direction = direction / length if length > 0 else rng.normal(size=len(direction)) / len(direction) ** 0.5
    return direction, float(np.median(points @ direction))


def grow(sample: np.ndarray, rows: int, trees: int = TREES, seed: int = 1) -> Forest:
    """Trees for `rows` vectors from a sample of them, deep enough for leaves of about LEAF or DEEPEST levels."""
    deepest = min(DEEPEST, int(np.log2(max(len(sample) / 16, 1))))
    depth = min(deepest, max(0, int(np.ceil(np.log2(max(rows / LEAF, 1))))))
    inner = 2**depth - 1
    normals, cuts = np.zeros((trees, max(inner, 1), sample.shape[1])), np.zeros((trees, max(inner, 1)))
    for t in range(trees):
        rng = np.random.default_rng([seed, t])
        parts = {0: np.arange(len(sample))}
        for node in range(inner):
            mine = parts.pop(node)
            if len(mine):
                normals[t, node], cuts[t, node] = _split(sample[mine], rng)
            side = sample[mine] @ normals[t, node] >= cuts[t, node]
            parts[2 * node + 1], parts[2 * node + 2] = mine[~side], mine[side]
    return Forest(depth, normals, cuts)


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors, each divided by the power of two that brings its largest component near one. That changes no
    cosine, not even in its last bit, and keeps squares in the range of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    vectors = flat.astype(np.float64).reshape(len(column), -1 if len(column) else 1)
    _, power = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, -power[:, None])


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _sizing(forest: Forest):
    """Vectors of each leaf, as far as one task sees them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(forest.normals), 2**forest.depth), dtype=np.int64)
        for batch in batches:
            if len(batch):
                for t, leaf in enumerate(forest.leaves(_unit(_matrix(batch.column(0))))):
                    total[t] += np.bincount(leaf, minlength=total.shape[1])
        tree, leaf = np.nonzero(total)
        arrays = [pa.array(tree.astype(np.int32)), pa.array(leaf), pa.array(total[tree, leaf])]
        yield pa.RecordBatch.from_arrays(arrays, names=["tree", "leaf", "n"])

    return run


def _routing(forest: Forest):
    """Every vector once for each tree, at its leaf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            for t, leaf in enumerate(forest.leaves(_unit(_matrix(batch.column(1))))):
                arrays = [pa.array(np.full(len(leaf), t, np.int32)), pa.array(leaf), *batch.columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["tree", "leaf", "ids", "vector"])

    return run


def _searching(forest: Forest, sizes: np.ndarray, enough: float):
    """Every query once for each leaf that it reaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 64):
                part = batch.slice(low, 64)
                units = _unit(_matrix(part.column(1)))
                found = [(i, t, leaf) for i, u in enumerate(units) for t, leaf in forest.search(u, sizes, enough)]
                at, tree, leaf = (np.array(c) for c in zip(*found))
                arrays = [pa.array(tree.astype(np.int32)), pa.array(leaf.astype(np.int64))]
                arrays += [c.take(pa.array(at)) for c in part.columns]
                yield pa.RecordBatch.from_arrays(arrays, names=["tree", "leaf", "query_id", "query"])

    return run


_EMPTY = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                   "score": pa.array([], pa.float64())})


def _ranking(k: int):
    """The `k` nearest of one block of vectors, for each query of one block."""

    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(members) or not len(queries):
            return _EMPTY
        vectors = _matrix(members["vector"].combine_chunks())
        asked = _matrix(queries["query"].combine_chunks())
        norms = np.linalg.norm(asked, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
        # Each sum is formed on its own, so that a pair scores the same in every block.
        scores = np.einsum("qd,md->qm", asked, vectors) / norms
        ids, names = members["ids"].to_pylist(), queries["query_id"].to_pylist()
        rows = []
        for name, score in zip(names, scores):
            # One vector may be the query's own and leave k others.
            least = np.partition(score, -(k + 1))[-(k + 1)] if len(score) > k + 1 else -np.inf
            near = [(-score[j], v) for j in np.flatnonzero(score >= least) for v in ids[j] if v != name]
            rows += [(name, v, -s) for s, v in heapq.nsmallest(k, near)]
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _EMPTY.schema)], schema=_EMPTY.schema)

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, share: float = SEARCH_SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of `vectors` for each row of `queries`.

    Both have (vec_id, embedding). The score is the cosine in double precision; equal ones rank by smaller
    vec_id. A vector with the query's id is no candidate. Rows without id and vectors that are null,
    empty, zero or hold a null or non-finite component take no part, nor do vectors of another length than
    most have. Repeats of an id with one vector count once; with different ones each vector is a
    candidate, and a query's repeats are answered together, each neighbour at its best score. Fewer than `k` rows
    come where there are fewer candidates, none without queries. Other columns are ignored.

    Equal vectors are one entry of the index that keeps its k + 1 smallest ids, which are all that can rank.
    """
    number = "array<double>"
    as_double = F.col("embedding").cast(number)
    usable = (
        F.col("vec_id").isNotNull()
        & F.forall(as_double, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists(as_double, lambda x: x != 0)
    )
    pick = [F.col("vec_id").cast("bigint").alias("vec_id"), as_double.alias("vector")]
    rows, asked = vectors.where(usable).select(pick), queries.where(usable).select(pick)
    sizes = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size")
    usual = sizes.first()
    width = usual["size"] if usual else 0
    rows, asked = (f.where(F.size("vector") == width).distinct() for f in (rows, asked))
    smallest = Window.partitionBy("vector").orderBy("vec_id")
    entries = (
        rows.withColumn("at", F.row_number().over(smallest)).where(F.col("at") <= k + 1)
        .groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select("ids", "vector")
    )
    n = usual["count"] if usual else 0
    lowest = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector")
    sample = _matrix(lowest.toArrow().column("vector").combine_chunks()).reshape(-1, max(width, 1))
    forest = grow(_unit(sample), n)
    counted = entries.select("vector").mapInArrow(_sizing(forest), "tree int, leaf bigint, n bigint")
    leaf_sizes = np.zeros((TREES, 2**forest.depth), dtype=np.int64)
    # One row per leaf, of which there are no more than the sample allows.
    totals = counted.groupBy("tree", "leaf").agg(F.sum("n").alias("n"))
    for r in totals.collect():
        leaf_sizes[r.tree, r.leaf] = r.n
    enough = max(share * leaf_sizes[0].sum(), SEARCH_LEAST)
    routed = entries.mapInArrow(
        _routing(forest), f"tree int, leaf bigint, ids array<bigint>, vector {number}"
    )
    reached = asked.mapInArrow(
        _searching(forest, leaf_sizes, enough), f"tree int, leaf bigint, query_id bigint, query {number}"
    )
    of_leaf = ["tree", "leaf"]
    asking = reached.groupBy(of_leaf).agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("query_blocks"))
    holding = totals.select(*of_leaf, F.ceil(F.col("n") / MEMBER_BLOCK).cast("int").alias("member_blocks"))
    blocks = asking.join(holding, of_leaf)
    spread = lambda own, of: F.pmod(F.xxhash64(own), F.col(of)).cast("int")
    each = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    members = routed.join(blocks, of_leaf).select(
        *of_leaf, spread("ids", "member_blocks").alias("member_block"), each("query_blocks").alias("query_block"),
        "ids", "vector",
    )
    meeting = reached.join(blocks, of_leaf).select(
        *of_leaf, each("member_blocks").alias("member_block"), spread("query_id", "query_blocks").alias("query_block"),
        "query_id", "query",
    )
    key = [*of_leaf, "member_block", "query_block"]
    ranked = members.groupBy(key).cogroup(meeting.groupBy(key)).applyInArrow(
        _ranking(k), "query_id bigint, vec_id bigint, score double"
    )
    best = ranked.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    placed = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return placed.select("query_id", "rank", "vec_id", "score")
