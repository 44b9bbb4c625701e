"""Near-duplicate documents by bottom-k sketches.

Each document is a set of word shingles; one hash function orders them and its k smallest values are the
sketch. Inverted lists of retained values give pairs that overlap, the sketch of the union estimates their
similarity, and pairs that may reach it are confirmed on their full sets. Confirmed links are closed to
components.

How lists stay bounded without losing a link:

* Equal sets are one node, so copies never meet.
* A list holds the nodes that share one of their `KEYS` smallest values. Two sets of similarity s >= 0.8
  share none with probability 0.2^12. Short lists give their pairs directly.
* In a long list every node meets two pivots, one after the other, which joins a group of near copies
  with a number of rows that grows with the list, not with its square.
* Nodes of long lists that still hold several components are looked at by the rarest values of their
  whole sketches: a pair that shares half of its sketch shares one of the rarest s - s/2 + 1 of each.
  Values of a passage that very many documents share are the last in that order, so that they count
  only where they are half of a document. The nodes left are matched on their full sets, again in the
  order of rarity: where the first common value of a pair stands says how much it can have in common, and
  a pair that cannot reach the similarity is not made.

A pair of similarity 0.8 has less than half of the union's sketch in common with probability below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.graph import labels_of, stars
from stocktide.llm.tables import scratch, written
from stocktide.llm.text import mix, not_space, shingle_hashes, slices, trimmed, word_hashes

SKETCH = 64
KEYS = 12
SHORT_LIST = 16
SIGNATURE_WORDS = 32
SLICE_BYTES = 4 << 20


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes (63 bits) of each text."""
    words, begins = word_hashes(texts, not_space())
    for low, high in zip(begins[:-1], begins[1:]):
        yield np.unique(shingle_hashes(words[low:high], size) >> np.uint64(1))


def _digest(values: np.ndarray, seed: int) -> int:
    """One number for a set."""
    total = mix(values, seed).sum(dtype=np.uint64) ^ np.uint64(len(values))
    return int(_signed(mix(np.array([total]), seed + 1))[0])


def _sketching(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for low, high in slices(texts, SLICE_BYTES):
                sets = list(_shingle_sets(texts.slice(low, high - low), size))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s, 11) if len(s) else None for s in sets], pa.int64()),
                        pa.array([_digest(s, 23) if len(s) else None for s in sets], pa.int64()),
                        pa.array([_signed(s[:SKETCH]) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "node", "other", "sketch"],
                )

    return run


def _signature(values: np.ndarray) -> np.ndarray:
    """A bit for each element of a set, in SIGNATURE_WORDS numbers of 64 bits. Two sets differ in at least
    as many elements as their signatures differ in bits."""
    bits = np.zeros(64 * SIGNATURE_WORDS, dtype=np.uint8)
    bits[(values % np.uint64(len(bits))).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64)


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, nodes = batch.column(1), batch.column(0)
            for low, high in slices(texts, SLICE_BYTES):
                sets = list(_shingle_sets(texts.slice(low, high - low), size))
                wanted = nodes.slice(low, high - low).to_pylist()
                kept = [(n, s) for n, s in zip(wanted, sets) if len(s) and _digest(s, 11) == n]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n for n, _ in kept], pa.int64()),
                        pa.array([_signed(s) for _, s in kept], pa.list_(pa.int64())),
                        pa.array([_signature(s) for _, s in kept], pa.list_(pa.int64())),
                    ],
                    names=["node", "elements", "signature"],
                )

    return run


def _long_enough(percent: int, a: str, b: str) -> Column:
    return F.expr(f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})")


class _Search:
    """What the steps of one search share."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
        self.size, self.percent = size, percent
        schema = "doc_id bigint, n_shingles bigint, node bigint, other bigint, sketch array<bigint>"
        self.rows = written(self.docs.mapInArrow(trimmed(_sketching(size)), schema), "sketches")
        nodes = self.rows.where("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("first_id"),
            F.min("n_shingles").alias("n"),
            F.expr("min(other) = max(other)").alias("one_set"),
        )
        self.nodes = written(nodes, "nodes")
        if self.nodes.where("not one_set").limit(1).count():
            raise ValueError("two different sets have one digest; choose other seeds")

    def sketches_of(self, nodes: DataFrame) -> DataFrame:
        """(node, n, sketch), one row per node."""
        rows = self.rows.join(nodes, "node", "left_semi").select("node", "n_shingles", "sketch")
        return rows.dropDuplicates(["node"]).withColumnRenamed("n_shingles", "n")

    def sets_of(self, nodes: DataFrame) -> DataFrame:
        """(node, elements, signature): the full sets, from the texts."""
        firsts = self.nodes.select("node", "first_id").join(nodes, "node", "left_semi")
        chosen = self.docs.join(firsts, F.expr("doc_id <=> first_id")).select("node", "text")
        schema = "node bigint, elements array<bigint>, signature array<bigint>"
        sets = chosen.mapInArrow(trimmed(_full_sets(self.size)), schema)
        return written(sets, "sets")

    def confirmed(self, pairs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough. `sets` are theirs, if at hand. Sets that are no
        larger than a sketch are compared as such."""
        with scratch(pairs.sparkSession) as used:
            both = lambda frame: frame.select(F.explode(F.array("a", "b")).alias("node")).distinct()
            sketches = written(self.sketches_of(both(pairs)), "compared")
            one = sketches.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
            two = sketches.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
            union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
            shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
            whole = F.greatest("na", "nb") <= SKETCH
            known = F.size(F.array_intersect("sa", "sb"))
            alike = 100 * known >= self.percent * (F.col("na") + F.col("nb") - known)
            compared = written(
                pairs.join(one, "a").join(two, "b")
                .where(_long_enough(self.percent, "na", "nb"))
                .where(F.when(whole, alike).otherwise(2 * shared >= F.size(union)))
                .select("a", "b", "na", "nb", whole.alias("sure")),
                "likely",
            )
            sure, likely = compared.where("sure").select("a", "b"), compared.where("not sure").drop("sure")
            if sets is None:
                sets = self.sets_of(both(likely))
            first = sets.select(F.col("node").alias("a"), F.col("elements").alias("ea"))
            second = sets.select(F.col("node").alias("b"), F.col("elements").alias("eb"))
            common = F.size(F.array_intersect("ea", "eb"))
            similar = 100 * common >= self.percent * (F.col("na") + F.col("nb") - common)
            found = likely.join(first, "a").join(second, "b").where(similar).select("a", "b")
            return used.keep(written(found.union(sure).distinct(), "links"))


def _pairs(left: str = "left_node", right: str = "right_node") -> list[Column]:
    return [F.least(left, right).alias("a"), F.greatest(left, right).alias("b")]


def _labelled(frame: DataFrame, labels: DataFrame) -> DataFrame:
    """`frame` (node, ...) with the component each node is in so far."""
    joined = frame.join(labels, "node", "left")
    return joined.withColumn("root", F.coalesce("root", "node"))


def _open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries (value, node, root) of the lists that hold more than one component."""
    rows = _labelled(lists, labels)
    several = rows.groupBy("value").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    # Written, here and below, so that the join reads both sides as they are and a hot value can be split.
    return rows.join(written(several.select("value"), "several"), "value", "left_semi")


def _to_pivots(lists: DataFrame, weight: Column) -> DataFrame:
    """Every node of a list with the list's pivot: the node of most weight, ties to the smaller."""
    pivot = lists.groupBy("value").agg(
        F.max(F.struct(weight.alias("weight"), (-F.col("node")).alias("negative"))).alias("pivot")
    )
    pivots = written(pivot.select("value", (-F.col("pivot.negative")).alias("pivot")), "pivots")
    pairs = lists.join(pivots, "value").where("node <> pivot")
    return pairs.select(*_pairs("node", "pivot")).distinct()


def _shared_values(entries: DataFrame) -> DataFrame:
    """(value, df): how many nodes have each value, of those that several have."""
    return written(entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1"), "often")


def _ranked(entries: DataFrame) -> DataFrame:
    """`entries` (node, n, value) that some other node has as well, with their rank among the `n` values of
    the node: by how many nodes have a value, then by value. Values of one node only come before."""
    often = _shared_values(entries)
    ordered = entries.join(often, "value").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared")
    )
    ranked = ordered.select("node", "n", (F.col("n") - F.size("shared")).alias("own"), F.posexplode("shared"))
    return ranked.select("node", "n", F.col("col.value").alias("value"), (F.col("own") + F.col("pos")).alias("rank"))


def _still_open(sketched: DataFrame, labels: DataFrame) -> DataFrame:
    """The nodes that may yet have half of a sketch in common with one of another component: those that
    share one of the rarest values of their sketch with it. `sketched` has (node, n, value)."""
    ranked = _ranked(sketched)
    lists = ranked.where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") / 2)).select("value", "node")
    return _open_lists(written(lists, "rarest"), labels).select("node").distinct()


def _by_rarest(search: _Search, sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different components among the nodes of `sets` whose sizes and first common value, in the
    order of rarity, leave room for the overlap that the similarity asks for, and whose signatures are no
    further apart than it allows."""
    entries = sets.select("node", F.size("elements").alias("n"), F.explode("elements").alias("value"))
    ranked = _ranked(entries)
    p = search.percent
    most = F.col("n") - F.ceil(F.col("n") * p / 100)
    prefixes = _labelled(ranked.where(F.col("rank") <= most), labels)
    prefixes = written(prefixes.select("value", "node", "n", "root", "rank"), "ranked")
    held = prefixes.groupBy("value", "root").agg(F.count("*").alias("held"))
    largest = held.groupBy("value").agg(F.max(F.struct("held", "root")).alias("of"), F.count("*").alias("roots"))
    several = written(largest.where("roots > 1").select("value", F.col("of.root").alias("main")), "several")
    lists = prefixes.join(several, "value").withColumn("inside", F.expr("root = main")).drop("main")
    lists = written(lists.join(sets.select("node", "signature"), "node"), "prefixes")
    # The largest component of a list never meets itself.
    columns = ("node", "n", "root", "rank", "signature", "inside")
    side = lambda x: [F.col(c).alias(f"{n}{x}") for c, n in zip(columns, ("", "n", "r", "k", "s", "in"))]
    left, right = lists.where("not inside").select("value", *side("a")), lists.select("value", *side("b"))
    room = F.expr(f"(100 + {p}) * least(na - ka, nb - kb) >= {p} * (na + nb)")
    # Written as a fold: spelled out, the join's generated code is too long to be compiled.
    apart = "aggregate(zip_with(sa, sb, (x, y) -> bit_count(x ^ y)), 0, (n, x) -> n + x)"
    alike = F.expr(f"(100 + {p}) * ({apart}) <= (100 - {p}) * (na + nb)")
    met = left.join(right, "value").where("ra <> rb and (inb or a < b)").where(room & alike)
    return met.where(_long_enough(p, "na", "nb")).select(*_pairs("a", "b")).distinct()


def _first_pairs(search: _Search) -> tuple[DataFrame, DataFrame]:
    """(pairs of the short lists and pivots of the long ones, the entries of the long lists)."""
    with scratch(search.rows.sparkSession) as used:
        sizes = search.rows.where("node is not null").select(
            "node", F.explode(F.slice("sketch", 1, KEYS)).alias("value")
        )
        entries = written(sizes.distinct(), "entries")
        lists = written(entries.join(_shared_values(entries), "value"), "lists")
        short = lists.where(F.col("df") <= SHORT_LIST).select("value", "node")
        long = lists.where(F.col("df") > SHORT_LIST).select("value", "node")
        degree = long.groupBy("node").agg(F.count("*").alias("degree"))
        long = used.keep(written(long.join(degree, "node"), "long_lists"))
        left = short.withColumnRenamed("node", "left_node")
        right = short.withColumnRenamed("node", "right_node")
        near = left.join(right, "value").where("left_node < right_node").select(*_pairs())
        return used.keep(written(near.union(_to_pivots(long, F.col("degree"))).distinct(), "pairs")), long


def _second_pairs(
    search: _Search, long: DataFrame, labels: DataFrame, tested: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(pairs with second pivots, entries (node, n, value) of the sketches that the open lists hold).

    Second pivots are among nodes that share their whole sketch with the most others: in a group of near copies
    those with the fewest edits, which most of the others are near to.
    """
    with scratch(search.rows.sparkSession) as used:
        open_lists = written(_open_lists(long.select("value", "node"), labels), "open")
        sketches = search.sketches_of(open_lists.select("node").distinct())
        entries = sketches.select("node", F.size("sketch").alias("n"), F.explode("sketch").alias("value"))
        sketched = used.keep(written(entries, "whole_sketches"))
        weight = sketched.join(_shared_values(sketched), "value").groupBy("node").agg(F.sum("df").alias("weight"))
        pairs = _to_pivots(open_lists.join(weight, "node"), F.col("weight"))
        return used.keep(written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")), sketched


def _last_links(search: _Search, sketched: DataFrame, labels: DataFrame, tested: DataFrame) -> DataFrame:
    """The links that neither short lists nor pivots can have shown."""
    with scratch(search.rows.sparkSession) as used:
        with scratch(search.rows.sparkSession) as inner:
            sets = inner.keep(search.sets_of(_still_open(sketched, labels)))
        with scratch(search.rows.sparkSession) as inner:
            rest = _by_rarest(search, sets, labels).join(tested, ["a", "b"], "left_anti")
            rest = inner.keep(written(rest, "pairs"))
        return used.keep(search.confirmed(rest, sets))


def _components(search: _Search) -> DataFrame:
    """(node, root) of the nodes that are linked. Links join the stars of those found before them."""
    as_links = lambda edges: edges.select(F.col("u").alias("a"), F.col("v").alias("b"))
    with scratch(search.rows.sparkSession) as used:
        tested, long = _first_pairs(search)
        found = stars(search.confirmed(tested))
        pairs, sketched = _second_pairs(search, long, labels_of(found), tested)
        found = stars(as_links(found).union(search.confirmed(pairs)))
        links = _last_links(search, sketched, labels_of(found), tested.union(pairs))
        return labels_of(used.keep(stars(as_links(found).union(links))))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs` (doc_id, text).

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. A text with fewer words than a shingle has one
    shingle, the whole sequence. Two documents are linked if 100 * intersection >= percent * union of
    their shingle sets; `component_id` is the smallest doc_id reachable, and `kept` says whether it is
    the row's own.

    A null or wordless text has no shingles and is linked with nothing; such a row keeps its own id.
    Rows that repeat an id are documents of their own, so that exact repeats share a component and are
    all `kept` or none. A null id takes part in links and is never a component's id, unless the whole
    component has none; then component_id is null and the row is kept. Other columns are ignored. An
    empty table gives no rows. Sets are compared by 63-bit hashes of their shingles.
    """
    with scratch(docs.sparkSession) as used:
        search = _Search(docs, shingle_words, percent)
        labels = _components(search)
        members = labels.join(search.nodes, "node").select("node", "root", "first_id")
        least = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
        linked = members.join(least, "root").select("node", F.col("component_id").alias("linked_id"))
        ids = search.nodes.join(linked, "node", "left").select(
            "node", F.coalesce("linked_id", "first_id").alias("component_id")
        )
        rows = search.rows.select("doc_id", "n_shingles", "node").join(ids, "node", "left")
        component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        found = rows.select(
            "doc_id", "n_shingles", component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )
        return used.keep(written(found, "components"))
