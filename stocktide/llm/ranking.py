"""Ranked lexical search: the best documents for each query text, found through blocks of posting lists.

Every text becomes part of a shard: the terms of its documents with their numbers, written once. For the terms
of a set of queries, each shard then gets posting lists cut into blocks of documents that are alike: some of the
list's documents serve as centres, the others go to the centre their sketch is closest to. A block's
summary holds, for each term of the queries, the largest value a document of the block has there, rounded up
to a byte. A block is skipped only if its summary, weighed as the query weighs terms, shows that none of its
documents can be among the best. Documents of other blocks are scored exactly.

The score of the k-th best document in some of the shards is a bound for all others, so that most shards
return few rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stocktide.llm.tables import written
from stocktide.llm.text import alphanumeric, slices, trimmed, word_hashes

SHARD_BYTES = 8 << 20
SHARD_DOCS = 8_192
#: Terms of queries that are looked up in one pass over the shards; one query may have more by itself.
PASS_TERMS = 16_384
#: Lists are cut into blocks of about BLOCK_DOCS documents, at most MOST_BLOCKS a list; shorter lists
#: than SHORT_LIST have no summary and are always read.
BLOCK_DOCS = 64
MOST_BLOCKS = 16
SHORT_LIST = 128
SKETCH = 16
#: From so many shards on some are searched before the others.
LEAST_SHARDS = 16
#: Rows and columns of the table of values from which summaries are made, at one time.
SLAB_ROWS, SLAB_TERMS = 2_048, 2_048
#: A document's value for a term is below 1,000,000; a byte stands for as many.
STEP = 3_922
#: How tables of shards are written: readers and writers hold one row group in memory.
WIDE_ROWS = {"compression": "zstd", "parquet.block.size": str(16 << 20)}
SHARD_COLUMNS = (
    "docs bigint, words bigint, doc_ids array<bigint>, lengths binary, terms binary, ends binary, docs_of binary, "
    "counts binary"
)
INDEX_COLUMNS = (
    "pick bigint, doc_ids array<bigint>, docs binary, values binary, lists binary, block_ends binary, block_lists binary, "
    "summary_steps binary, summary_bytes binary, summary_ends binary"
)
FOUND_COLUMNS = "query bigint, doc_id bigint, score bigint"
_IDS = pa.list_(pa.int64())


def _packed(rows: list[list], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _names(columns: str) -> list[str]:
    return [c.split()[0] for c in columns.split(", ")]


def _inverted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard: its documents, its distinct terms, and for each the documents that hold it and how often."""
    names = _names(SHARD_COLUMNS)
    kinds = [pa.int64(), pa.int64(), _IDS] + [pa.binary()] * 5
    for batch in batches:
        for low, high in _shards(batch.column(1)):
            hashes, begins = word_hashes(batch.column(1).slice(low, high - low), alphanumeric())
            lengths = np.diff(begins)
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            doc = np.repeat(np.arange(high - low, dtype=np.uint16), lengths)[order]
            del order
            new_term = np.ones(len(hashes), dtype=bool)
            new_term[1:] = hashes[1:] != hashes[:-1]
            first = new_term.copy()
            first[1:] |= doc[1:] != doc[:-1]
            at = np.flatnonzero(first)
            counts = np.diff(np.append(at, len(hashes))).astype(np.uint32)
            terms = hashes[new_term]
            ends = np.append(np.flatnonzero(new_term[at])[1:], len(at)).astype(np.uint32) if len(at) else counts
            ids = batch.column(0).slice(low, high - low).to_pylist()
            parts = (lengths, terms, ends, doc[at], counts)
            row = [int((lengths > 0).sum()), int(lengths.sum()), ids, *(p.tobytes() for p in parts)]
            yield _packed([row], names, kinds)


def _shards(texts: pa.Array) -> Iterator[tuple[int, int]]:
    for low, high in slices(texts, SHARD_BYTES):
        for start in range(low, high, SHARD_DOCS):
            yield start, min(start + SHARD_DOCS, high)


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, begins = word_hashes(batch.column(1), alphanumeric())
        terms = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(begins[:-1], begins[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, _IDS)], names=["query", "terms"])


def _held(vocabulary: np.ndarray):
    """How many documents hold each term of `vocabulary`, which is sorted, as far as one task sees them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for packed, ends in zip(batch.column(0), batch.column(1)):
                code, there = _codes(np.frombuffer(packed.as_py(), np.uint64), vocabulary)
                sizes = np.diff(np.frombuffer(ends.as_py(), np.uint32).astype(np.int64), prepend=0)
                total[code[there]] += sizes[there]
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])

    return run


def _codes(terms: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each term in `vocabulary`, and whether it is there."""
    code = np.minimum(np.searchsorted(vocabulary, terms), max(len(vocabulary) - 1, 0))
    return code, vocabulary[code] == terms if len(vocabulary) else np.zeros(len(terms), dtype=bool)


def _slowdown(lengths: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
    """100 - 50 + ((50 * n * N) div L) of documents of n words each, in whole numbers of any size."""
    if 50 * int(lengths.max(initial=0)) * n_docs < 1 << 62:
        return 50 + (50 * lengths * n_docs) // n_words
    return np.array([50 + 50 * int(n) * n_docs // n_words for n in lengths], dtype=np.int64)


def _values(counts: np.ndarray, slowdown: np.ndarray) -> np.ndarray:
    tf = counts.astype(np.int64)
    return (1_000_000_000 * tf) // (1_000 * tf + 20 * slowdown)


def _block_number(blocks: int) -> type:
    return np.uint16 if blocks <= 1 << 16 else np.uint32


def _alike(sketch: np.ndarray, blocks: int) -> np.ndarray:
    """An order of documents in which those that are alike stand together, by their sketches."""
    # Centres stand at even steps; the order of documents before does not depend on their likeness.
    centres = sketch[(np.arange(blocks) * len(sketch)) // blocks]
    return np.argsort((sketch @ centres.T).argmax(axis=1).astype(np.uint8), kind="stable")


def _blocking(vocabulary: np.ndarray, weights: np.ndarray, n_docs: int, n_words: int):
    """Each shard with the posting lists of `vocabulary`, in blocks, and the blocks' summaries."""
    names, kinds = _names(INDEX_COLUMNS), [pa.int64(), _IDS] + [pa.binary()] * 8
    rng = np.random.default_rng(7)
    directions = rng.choice(np.array([-1, 1], dtype=np.float32), (max(len(vocabulary), 1), SKETCH))

    def row(lengths, terms, ends, docs_of, counts) -> list[bytes]:
        code, there = _codes(terms, vocabulary)
        held, begins = np.flatnonzero(there), np.concatenate([[0], ends[:-1]]).astype(np.int64)
        sizes = ends[held].astype(np.int64) - begins[held]
        lasts = np.cumsum(sizes)
        taken = np.repeat(begins[held] - lasts + sizes, sizes) + np.arange(sizes.sum())
        # Postings ordered by term, those of a term by document.
        code, doc = np.repeat(code[held], sizes), docs_of[taken].astype(np.int64)
        value = _values(counts[taken], _slowdown(lengths, n_docs, n_words)[doc])
        weighed = (value * weights[code]).astype(np.float32)
        sketch = np.zeros((len(lengths), SKETCH), dtype=np.float32)
        for i in range(SKETCH):
            sketch[:, i] = np.bincount(doc, weighed * directions[code, i], minlength=len(lengths))
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1)

        sizes = np.bincount(code, minlength=len(vocabulary))
        lists = np.cumsum(sizes)
        place = np.arange(len(doc))
        starts, block_ends, block_lists = [], [], []
        for term in np.flatnonzero(sizes >= SHORT_LIST):
            begin, n = int(lists[term] - sizes[term]), int(sizes[term])
            blocks = min(MOST_BLOCKS, -(-n // BLOCK_DOCS))
            place[begin : begin + n] = begin + _alike(sketch[doc[begin : begin + n]], blocks)
            bounds = begin + (np.arange(blocks + 1) * n) // blocks
            starts.append(bounds[:-1])
            block_ends.append(bounds[1:])
            block_lists.append(np.full(blocks, term))
        none = [np.zeros(0, dtype=np.int64)]
        starts, block_ends, block_lists = (np.concatenate(x or none) for x in (starts, block_ends, block_lists))
        members = doc[place]
        summary = summaries(doc, code, value, members, starts, block_ends, len(lengths))
        parts = (members.astype(np.uint16), value[place].astype(np.uint32), lists, block_ends, block_lists, *summary)
        return [p.tobytes() for p in parts]

    def summaries(doc, code, value, members, starts, block_ends, n_shard):
        """(block, byte) entries ordered by term, and where each term's end. A block's number is stored as the step
        from the term's entry before."""
        number = _block_number(len(starts))
        steps, bytes_, ends = [np.zeros(0, number)], [np.zeros(0, np.uint8)], []
        for low in range(0, len(vocabulary), SLAB_TERMS):
            width = min(SLAB_TERMS, len(vocabulary) - low)
            part = slice(*np.searchsorted(code, [low, low + width]))
            dense = np.zeros((n_shard, width), dtype=np.uint8)
            dense[doc[part], code[part] - low] = -(-value[part] // STEP)
            blocks, terms, most = [np.zeros(0, number)], [np.zeros(0, np.uint16)], [np.zeros(0, np.uint8)]
            for b, (start, end) in enumerate(zip(starts, block_ends)):
                largest = np.zeros(width, dtype=np.uint8)
                for at in range(start, end, SLAB_ROWS):
                    np.maximum(largest, dense[members[at : min(at + SLAB_ROWS, end)]].max(axis=0), out=largest)
                held = np.flatnonzero(largest)
                blocks.append(np.full(len(held), b, dtype=number))
                terms.append(held.astype(np.uint16))
                most.append(largest[held])
            term = np.concatenate(terms)
            order = np.argsort(term, kind="stable")
            sizes = np.bincount(term, minlength=width)
            block = np.concatenate(blocks)[order]
            step = np.diff(block, prepend=block[:1])
            firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
            step[firsts] = block[firsts]
            steps.append(step)
            bytes_.append(np.concatenate(most)[order])
            ends.append(sizes)
        ends = np.cumsum(np.concatenate(ends or [np.zeros(0, np.int64)]))
        return np.concatenate(steps), np.concatenate(bytes_), ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (np.int64, np.uint64, np.uint32, np.uint16, np.uint32)
        for batch in batches:
            for ids, *cells in zip(*batch.columns):
                arrays = [np.frombuffer(c.as_py(), t) for c, t in zip(cells, types)]
                pick = zlib.crc32(arrays[1])
                yield _packed([[pick, ids.as_py(), *row(*arrays)]], names, kinds)

    return run


@dataclass(frozen=True)
class _Queries:
    """Queries of one pass: term codes and their weights, the k-th best score known so far, by number."""

    numbers: list[int | None]
    codes: list[np.ndarray]
    weights: np.ndarray
    least: np.ndarray
    k: int


class _Shard:
    """The posting lists and summaries of one shard."""

    def __init__(self, ids: pa.Array, cells: list[bytes]):
        number = _block_number(len(cells[3]) // 8)
        types = (np.uint16, np.uint32, np.int64, np.int64, np.int64, number, np.uint8, np.int64)
        (self.docs, self.values, self.lists, self.block_ends, self.block_lists, self.summary_steps,
         self.summary_bytes, self.summary_ends) = (np.frombuffer(c, t) for c, t in zip(cells, types))
        self.ids = ids
        self.has_id = ids.is_valid().to_numpy(zero_copy_only=False)
        self.id_order = ids.fill_null(0).to_numpy()
        self.first_block = np.searchsorted(self.block_lists, np.arange(len(self.lists)))
        self.last_block = np.searchsorted(self.block_lists, np.arange(len(self.lists)), side="right")

    def _list(self, code: int) -> slice:
        return slice(int(self.lists[code - 1]) if code else 0, int(self.lists[code]))

    def bounds(self, codes: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
        """For each term of `codes`, what no document in its list's blocks scores above, if it has no term before.

        A document that has one is met in that term's list, so that only the terms from a list's own on count.
        """
        most, out = np.zeros(len(self.block_ends), dtype=np.int64), []
        for code in codes[::-1]:
            part = slice(int(self.summary_ends[code - 1]) if code else 0, int(self.summary_ends[code]))
            blocks = np.cumsum(self.summary_steps[part], dtype=np.int64)
            most[blocks] += self.summary_bytes[part] * (weights[code] * STEP)
            out.append(most[self.first_block[code] : self.last_block[code]].copy())
        return out[::-1]

    def best(self, codes: np.ndarray, weights: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The `k` best documents (their places in the shard) that score `least` or more, and above 0, and their
        scores."""
        codes = codes[np.argsort(-weights[codes], kind="stable")]
        wanted = np.zeros(len(self.ids), dtype=bool)
        scored = np.zeros(len(self.ids), dtype=bool)
        waiting: list[tuple[int, int, int]] = []
        for code, bounds in zip(codes, self.bounds(codes, weights)):
            part = self._list(code)
            if not len(bounds):
                wanted[self.docs[part]] = True
                continue
            ends = self.block_ends[self.first_block[code] : self.last_block[code]]
            starts = np.concatenate([[part.start], ends[:-1]])
            open_ = np.flatnonzero(bounds >= least)
            waiting += zip(bounds[open_].tolist(), starts[open_].tolist(), ends[open_].tolist())
        waiting.sort(reverse=True)
        score, at, size = np.zeros(len(self.ids), dtype=np.int64), 0, 16
        while True:
            # The blocks with the highest bounds come first; the k-th best score found rules others out.
            step = waiting[at : at + size]
            at, size = at + len(step), 2 * size
            for top, start, end in step:
                if top >= least:
                    wanted[self.docs[start:end]] = True
            fresh = wanted & ~scored
            if fresh.any():
                for code in codes:
                    part = self._list(code)
                    docs = self.docs[part]
                    mine = fresh[docs]
                    score[docs[mine]] += weights[code] * self.values[part][mine].astype(np.int64)
                scored |= fresh
                found = score[scored]
                if len(found) >= k:
                    least = max(least, int(np.partition(found, len(found) - k)[len(found) - k]))
            if at >= len(waiting) or waiting[at][0] < least:
                break
        kept = np.flatnonzero(scored & (score >= max(least, 1)))
        if len(kept) > k:
            kept = kept[np.lexsort((self.id_order[kept], self.has_id[kept], -score[kept]))[:k]]
        return kept, score[kept]


def _searching(queries: _Queries):
    """The best documents of each shard for every query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(queries.numbers, pa.int64())
        for batch in batches:
            for ids, *cells in zip(*batch.columns):
                shard = _Shard(ids.values, [c.as_py() for c in cells])
                query, docs, scores = [], [], []
                for i, (codes, least) in enumerate(zip(queries.codes, queries.least)):
                    found, score = shard.best(codes, queries.weights, int(least), queries.k)
                    query.append(np.full(len(found), i))
                    docs.append(found)
                    scores.append(score)
                arrays = [names.take(pa.array(np.concatenate(query))), shard.ids.take(pa.array(np.concatenate(docs)))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.concatenate(scores))], names=_names(FOUND_COLUMNS))

    return run


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _passes(terms: DataFrame) -> Iterator[list]:
    """The queries (query, terms) in groups of about PASS_TERMS terms, one group at a time."""
    total = terms.agg(F.sum(F.size("terms"))).first()[0] or 0
    n = -(-total // PASS_TERMS)
    for number in range(n):
        rows = terms.where(F.pmod(F.xxhash64("query"), F.lit(n)) == number).collect()
        if rows:
            yield rows


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = 50) -> DataFrame:
    """(query, rank, doc_id, score): the `k` best rows of `docs` (doc_id, text) for each row of `queries`
    (query, text), those with a score above 0.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z lower-cased. N counts the
    documents that have terms, L all their terms, n one document's, df the documents that hold a term, tf how
    often one does. A term weighs floor(1000 * ln((2 * N + 2) / (2 * df + 1))); a document scores the sum, over the
    query's distinct terms, of weight * ((1000000000 * tf) div (1000 * tf + 20 * m)) with m = 50 +
    ((50 * n * N) div L), in whole numbers. Equal scores rank by smaller doc_id, a null one first; `rank`
    is unique.

    A null or empty text has no terms. Rows that repeat a doc_id, or have none, are documents of their own. Rows of
    queries that repeat a number, or have none, are one query with the terms of all. Empty tables give no rows. Other
    columns are ignored. Terms are compared by 64-bit hashes. The terms of all documents are written once; queries are
    looked up in groups of about PASS_TERMS terms, for each of which posting lists are blocked and written.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shards = written(texts.mapInArrow(trimmed(_inverted), SHARD_COLUMNS), "shards", **WIDE_ROWS)
    totals = shards.agg(F.sum("docs").alias("docs"), F.sum("words").alias("words")).first()
    asked = queries.select(F.col("query").cast("bigint").alias("query"), F.col("text").cast("string").alias("text"))
    each = asked.mapInArrow(_query_terms, "query bigint, terms array<bigint>").select("query", F.explode("terms").alias("term"))
    terms = written(each.distinct().groupBy("query").agg(F.collect_list("term").alias("terms")), "query_terms")
    found = spark.createDataFrame([], FOUND_COLUMNS + ", rank int")
    for rows in _passes(terms) if totals.docs else ():
        found = found.unionByName(_one_pass(shards, rows, totals.docs, totals.words, k))
    return found.select("query", "rank", "doc_id", "score")


def _one_pass(inverted: DataFrame, rows: list, n_docs: int, n_words: int, k: int) -> DataFrame:
    """The best documents of the queries `rows`, of which there are boundedly many."""
    term_arrays = [np.sort(np.array(r.terms, dtype=np.int64).view(np.uint64)) for r in rows]
    vocabulary = np.unique(np.concatenate(term_arrays))
    held = inverted.select("terms", "ends").mapInArrow(_held(vocabulary), "code bigint, n bigint")
    df = np.zeros(len(vocabulary), dtype=np.int64)
    for code, n in held.groupBy("code").agg(F.sum("n")).collect():  # one row per term
        df[code] = n
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df], dtype=np.int64)
    columns = _names(SHARD_COLUMNS)[2:]
    blocked = inverted.select(columns).mapInArrow(
        trimmed(_blocking(vocabulary, weights, n_docs, n_words)), INDEX_COLUMNS
    )
    index = written(blocked, "blocks", **WIDE_ROWS)
    search = lambda shards, queries: _best_rows(
        shards.drop("pick").mapInArrow(trimmed(_searching(queries)), FOUND_COLUMNS), k
    )
    codes = [np.searchsorted(vocabulary, t) for t in term_arrays]
    numbers = [r["query"] for r in rows]
    queries = _Queries(numbers, codes, weights, np.zeros(len(rows), dtype=np.int64), k)
    # About as many shards as the root of their number are searched first: few rows then come from the others.
    shards = index.count()
    if shards >= LEAST_SHARDS:
        some = index.where(F.col("pick") % (shards // math.isqrt(shards)) == 0)
        known = dict(search(some, queries).where(F.col("rank") == k).select("query", "score").collect())
        queries = replace(queries, least=np.array([known.get(q, 0) for q in numbers], dtype=np.int64))
    return search(index, queries)
