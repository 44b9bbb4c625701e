"""Benchmark passages in training text, by a positional inverted index.

The index is cut by documents: each shard holds the postings of a few megabytes of text, as sorted terms
with the sorted positions of each. Shards are written to the shared folder and never shuffled. A test
window is looked up in a shard from its rarest term: its positions, shifted by the term's place in the window, are
kept where the next rarer term has a posting at its own place, and so on. What is left is an
exact match. With some slack for each place the same walk gives proximity matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.tables import written
from stocktide.llm.text import alphanumeric, slices, trimmed, word_hashes

WINDOW = 10
SLACK = 3
SHARD_BYTES = 4 << 20
#: Test words looked up in one pass over the index. It bounds what is sent to every task.
BLOCK_WORDS = 500_000
_PLACE = np.uint64((1 << 32) - 1)

INDEX_COLUMNS = "terms binary, counts binary, positions binary, doc_ids array<bigint>, n_words array<bigint>"
MATCH_COLUMNS = (
    "shard string, row int, doc_id bigint, n_words bigint, "
    "hits array<struct<start: bigint, end: bigint>>, items array<string>, near_items array<string>"
)


def _indexing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard. Positions count words, with one left out between documents."""
    for batch in batches:
        texts, ids = batch.column(1), batch.column(0)
        for low, high in slices(texts, SHARD_BYTES):
            hashes, begins = word_hashes(texts.slice(low, high - low), alphanumeric())
            lengths = np.diff(begins)
            places = np.arange(len(hashes)) + np.repeat(np.arange(len(lengths)), lengths)
            order = np.argsort(hashes, kind="stable")
            terms, counts = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([terms.tobytes()], pa.binary()),
                    pa.array([counts.astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([places[order].astype(np.uint32).tobytes()], pa.binary()),
                    pa.array([ids.slice(low, high - low).to_pylist()], pa.list_(pa.int64())),
                    pa.array([lengths], pa.list_(pa.int64())),
                ],
                names=["terms", "counts", "positions", "doc_ids", "n_words"],
            )


def build_index(docs: DataFrame) -> DataFrame:
    """Shards of the postings of `docs` (doc_id, text), written to the shared folder."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string"))
    # Shards are wide rows; readers and writers hold one row group in memory.
    options = {"compression": "zstd", "parquet.block.size": str(16 << 20)}
    index = written(texts.mapInArrow(trimmed(_indexing), INDEX_COLUMNS), "postings", **options)
    # A row's place in the written files names its shard, in every pass, however the files are split.
    at = F.struct("_metadata.file_path", "_metadata.row_index")
    return index.withColumn("shard", F.sha1(F.to_json(at)))


@dataclass(frozen=True)
class _Block:
    """Windows of some test items. `codes` and `places` are in the order in which terms are looked up."""

    vocabulary: np.ndarray
    codes: np.ndarray
    places: np.ndarray
    lengths: np.ndarray
    items: np.ndarray
    names: list[str]


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, begins = word_hashes(batch.column(1), alphanumeric())
        lists = pa.ListArray.from_arrays(begins.astype(np.int32), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["item_id", "words"])


def _block(rows: list, counts: dict[int, int], window: int) -> _Block:
    """`rows` (item_id, words) as windows, terms ordered by how often the whole index holds them."""
    windows, lengths, items, names = [], [], [], []
    for row in rows:
        words = np.array(row.words, dtype=np.int64).view(np.uint64)
        size = min(window, len(words))
        names.append(row.item_id)
        for start in range(len(words) - size + 1):
            padded = np.zeros(window, dtype=np.uint64)
            padded[:size] = words[start : start + size]
            windows.append(padded)
            lengths.append(size)
            items.append(len(names) - 1)
    terms, sizes = np.array(windows, dtype=np.uint64).reshape(-1, window), np.array(lengths, dtype=np.int64)
    vocabulary, codes = np.unique(terms, return_inverse=True)
    codes = codes.reshape(terms.shape)
    often = np.array([counts.get(int(v), 0) for v in vocabulary.view(np.int64)], dtype=np.int64)
    weight = often[codes]
    weight[np.arange(window) >= sizes[:, None]] = np.iinfo(np.int64).max
    order = np.argsort(weight, axis=1, kind="stable")
    return _Block(
        vocabulary, np.take_along_axis(codes, order, 1), order, sizes, np.array(items, dtype=np.int64), names
    )


def _counting(vocabulary: np.ndarray):
    """Postings in each shard of every term of `vocabulary`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), dtype=np.int64)
        for batch in batches:
            for packed, numbers in zip(batch.column(0), batch.column(1)):
                terms = np.frombuffer(packed.as_py(), dtype=np.uint64)
                counts = np.frombuffer(numbers.as_py(), dtype=np.uint32)
                _, here, there = np.intersect1d(vocabulary, terms, assume_unique=True, return_indices=True)
                total[here] += counts[there]
        seen = total > 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(vocabulary[seen].view(np.int64)), pa.array(total[seen])], names=["term", "n"]
        )

    return run


def _walk(
    block: _Block, live: np.ndarray, keys: np.ndarray, firsts: np.ndarray, lasts: np.ndarray, slack: int,
    doc_starts: np.ndarray, n_words: np.ndarray,
):
    """(window, position, document) of every match of the windows `live`.

    `keys` are the postings as term code and position in one number, sorted; a code's are
    `keys[firsts[code] : lasts[code]]`. The document is that of the rarest term's posting, and all words
    are looked for inside it; with some slack the position may lie before it.
    """
    rarest, place = block.codes[live, 0], block.places[live, 0]
    n = lasts[rarest] - firsts[rarest]
    window = np.repeat(live, n)
    at = np.repeat(firsts[rarest] - np.cumsum(n) + n, n) + np.arange(n.sum())
    posting = (keys[at] & _PLACE).astype(np.int64)
    start = posting - np.repeat(place, n)
    doc = np.searchsorted(doc_starts, posting, side="right") - 1
    if slack == 0:
        window, start, doc = window[start >= 0], start[start >= 0], doc[start >= 0]
    for step in range(1, block.codes.shape[1]):
        more = step < block.lengths[window]
        code, expected = block.codes[window, step], start + block.places[window, step]
        begin = doc_starts[doc]
        least, most = np.maximum(expected - slack, begin), np.minimum(expected + slack, begin + n_words[doc] - 1)
        base = code.astype(np.uint64) << np.uint64(32)
        low, high = base + least.astype(np.uint64), base + np.maximum(most, 0).astype(np.uint64)
        found = np.searchsorted(keys, low)
        match = keys[np.minimum(found, len(keys) - 1)]
        kept = ~more | ((least <= most) & (found < len(keys)) & (match >= low) & (match <= high))
        window, start, doc = window[kept], start[kept], doc[kept]
    return window, start, doc


def _shard_matches(block: _Block, slack: int, terms, counts, positions, n_words):
    """Hit word ranges and items by document of one shard: lists of (document, ...)."""
    ends = np.cumsum(counts, dtype=np.int64)
    at = np.minimum(np.searchsorted(terms, block.vocabulary), max(len(terms) - 1, 0))
    there = terms[at] == block.vocabulary if len(terms) else np.zeros(len(at), dtype=bool)
    inside = np.arange(block.codes.shape[1]) < block.lengths[:, None]
    live = np.flatnonzero((there[block.codes] | ~inside).all(axis=1))
    if not len(live):
        return [], [], []
    used = np.unique(block.codes[live][inside[live]])
    size = counts[at[used]].astype(np.int64)
    lasts = np.cumsum(size)
    take = np.repeat(ends[at[used]] - lasts, size) + np.arange(size.sum())
    keys = (np.repeat(used, size).astype(np.uint64) << np.uint64(32)) + positions[take]
    first, last = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    first[used], last[used] = lasts - size, lasts
    doc_starts = np.concatenate([[0], np.cumsum(n_words + 1)[:-1]])
    doc_of = lambda start: np.searchsorted(doc_starts, start, side="right") - 1

    window, start, doc = _walk(block, live, keys, first, last, 0, doc_starts, n_words)
    change = np.zeros(int((n_words + 1).sum()) + 1, dtype=np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + block.lengths[window], -1)
    edge = np.diff(np.concatenate([[0], np.cumsum(change) > 0, [0]]).astype(np.int8))
    low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = doc_of(low)
    hits = list(zip(owner.tolist(), (low - doc_starts[owner]).tolist(), (high - doc_starts[owner]).tolist()))
    pairs = lambda d, w: np.unique(np.column_stack([d, block.items[w]]), axis=0).tolist()
    near = []
    if slack >= 0:
        near_window, _, near_doc = _walk(block, live, keys, first, last, slack, doc_starts, n_words)
        near = pairs(near_doc, near_window)
    return hits, pairs(doc, window), near


def _matching(block: _Block, slack: int):
    """Matches of every shard. With a slack below zero no proximity matches are looked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(6)]
            for shard, terms, counts, positions, doc_ids, n_words in zip(*columns):
                ids, words = doc_ids.as_py(), np.array(n_words.as_py(), dtype=np.int64)
                arrays = (
                    np.frombuffer(terms.as_py(), dtype=np.uint64),
                    np.frombuffer(counts.as_py(), dtype=np.uint32),
                    np.frombuffer(positions.as_py(), dtype=np.uint32),
                )
                hits, items, near = _shard_matches(block, slack, *arrays, words)
                lists: list[list] = [[[] for _ in ids] for _ in range(3)]
                for doc, low, high in hits:
                    lists[0][doc].append({"start": low, "end": high})
                for into, found in ((lists[1], items), (lists[2], near)):
                    for doc, item in found:
                        into[doc].append(block.names[item])
                span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
                kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.list_(span)]
                kinds += [pa.list_(pa.string())] * 2
                values = [[shard.as_py()] * len(ids), range(len(ids)), ids, words, *lists]
                names = ["shard", "row", "doc_id", "n_words", "hits", "items", "near_items"]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

    return run


def _merged(found: list[DataFrame]) -> DataFrame:
    """What several passes found, by document. A word hit in two passes counts once."""
    if len(found) == 1:
        return found[0]
    rows = found[0]
    for other in found[1:]:
        rows = rows.union(other)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("hits", "items", "near_items")]
    joined = rows.groupBy("shard", "row", "doc_id", "n_words").agg(*lists)
    return joined.withColumn("hits", F.expr("""
        aggregate(array_sort(hits), cast(array() as array<struct<start: bigint, end: bigint>>), (a, h) ->
            if(size(a) > 0 and element_at(a, -1).end >= h.start,
               concat(slice(a, 1, size(a) - 1),
                      array(struct(element_at(a, -1).start as start, greatest(element_at(a, -1).end, h.end) as end))),
               concat(a, array(h))))
    """))  # fmt: skip


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK) -> DataFrame:
    """Every row of `docs` (doc_id, text) with the passages of `benchmark` (item_id, text) in it.

    (doc_id, n_words, n_hit, hits, items, near_items): words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the
    text with A-Z lower-cased. A window is `window` consecutive words of an item, or all words of an item
    that has fewer; `hits` are the word ranges (end excluded) covered by occurrences of windows, `n_hit`
    their words, `items` the distinct ids of the items whose windows occur, as sorted strings.
    `near_items` also has items of which all words of a window lie within `slack` words of their places around
    the rarest; with a `slack` below zero they are not looked for and the lists are empty.

    A null or wordless text has no words; such an item has no windows. Rows that repeat an id are
    documents of their own; items that repeat an id count once. A null item_id is named `null`. An empty
    table of documents gives no rows, an empty benchmark no hits. Other columns are ignored. Words are
    compared by 64-bit hashes. Test items are looked up in blocks of BLOCK_WORDS words, one pass over
    the index each, so that what is sent to tasks is bounded.
    """
    index = build_index(docs)
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id")
    items = written(
        benchmark.select(name, F.col("text").cast("string").alias("text"))
        .mapInArrow(_item_words, "item_id string, words array<bigint>")
        .where(F.size("words") > 0),
        "test_items",
    )
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    n_blocks = -(-total // BLOCK_WORDS) or 1
    found = []
    for number in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n_blocks)) == number).distinct()
        rows = mine.collect()  # about BLOCK_WORDS words
        vocabulary = np.unique(np.array([w for r in rows for w in r.words], dtype=np.int64).view(np.uint64))
        counted = index.select("terms", "counts").mapInArrow(trimmed(_counting(vocabulary)), "term bigint, n bigint")
        counts = dict(counted.groupBy("term").agg(F.sum("n")).collect()) if rows else {}
        block = _block(rows, counts, window)
        columns = ["shard", *(c.split()[0] for c in INDEX_COLUMNS.split(", "))]
        found.append(index.select(columns).mapInArrow(trimmed(_matching(block, slack)), MATCH_COLUMNS))
    merged = _merged(found)
    covered = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])
    return merged.select(
        "doc_id", "n_words", covered.alias("n_hit"), "hits",
        F.array_sort(F.array_distinct("items")).alias("items"),
        F.array_sort(F.array_distinct("near_items")).alias("near_items"),
    )
