import math
import random
from collections import Counter

import numpy as np
import pytest
from frames import awkward, documents, prose, splits
from pyspark.sql import functions as F

from stocktide.llm import ranking
from stocktide.llm.ranking import ranked_search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def expected(rows, queries, k):
    texts = [(doc, Counter(splits(TERM, text))) for doc, text in rows]
    sizes = [sum(c.values()) for _, c in texts]
    n_docs, n_words = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in texts for t in c)
    asked = {}
    for query, text in queries:
        asked.setdefault(query, set()).update(splits(TERM, text))
    out = set()
    for query, terms in asked.items():
        found = []
        for (doc, counts), n in zip(texts, sizes):
            score = 0
            for t in terms & counts.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += weight * (10**9 * counts[t] // (1000 * counts[t] + 20 * (50 + 50 * n * n_docs // n_words)))
            if score > 0:
                found.append((-score, doc is not None, doc or 0))
        for place, (score, has_id, doc) in enumerate(sorted(found)[:k]):
            out.add((query, place + 1, doc if has_id else None, -score))
    return out


def found(spark, rows, queries, k):
    asked = spark.createDataFrame(queries, "query bigint, text string").withColumns({"rank": F.lit(0), "term": F.lit(0)})
    return {tuple(r) for r in ranked_search(documents(spark, rows), asked, k).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:  # many shards, passes, blocks and slabs
        for name, value in (("SHARD_DOCS", 40), ("PASS_TERMS", 60), ("BLOCK_DOCS", 4), ("SHORT_LIST", 6),
                            ("SLAB_TERMS", 16), ("SLAB_ROWS", 3), ("LEAST_SHARDS", 2)):
            monkeypatch.setattr(ranking, name, value)
    rng = random.Random(5)
    rows = awkward(rng) + [(100 + i, prose(rng, rng.randrange(1, 80), 150)) for i in range(400)]
    passage = prose(rng, 12, 4000)
    rows += [(1000 + i, prose(rng, 20, 150) + " " + passage) for i in range(30)]
    rows += [(2000 + i, passage) for i in range(150)]  # ties beyond k
    queries = [(1, passage), (2, prose(rng, 9, 150)), (3, None), (4, ""), (5, prose(rng, 30, 150).upper()),
               (5, passage), (None, prose(rng, 4, 150)), (6, "not there at all"), (7, prose(rng, 300, 4000))]
    assert found(spark, rows, queries, 20) == expected(rows, queries, 20)


def test_empty_tables(spark):
    some = [(1, "one two"), (2, None)]
    assert found(spark, [], [(1, "one")], 5) == set()
    assert found(spark, [(1, None), (2, " ")], [(1, "one")], 5) == set()
    assert found(spark, some, [], 5) == set()
    assert found(spark, some, [(1, "ONE.three")], 5) == expected(some, [(1, "ONE.three")], 5)


def test_blocks_are_skipped_and_bounds_hold(spark):
    """Of one shard: many blocks are ruled out by the true k-th score, and none that holds a better document."""
    import pyarrow as pa

    rng = random.Random(6)
    texts = [prose(rng, 40, 400) for _ in range(3000)]
    query = texts[17].split()[:10]
    batch = pa.record_batch([pa.array(range(3000)), pa.array(texts)], names=["doc_id", "text"])
    inverted = list(ranking._inverted(iter([batch])))
    assert len(inverted) == 1
    vocabulary = np.unique(np.concatenate([np.frombuffer(inverted[0]["terms"][0].as_py(), np.uint64)]))
    weights = np.full(len(vocabulary), 1000)
    columns = ranking._names(ranking.SHARD_COLUMNS)[2:]
    blocked = next(ranking._blocking(vocabulary, weights, 3000, 120_000)(iter([inverted[0].select(columns)])))
    cells = [blocked[n][0].as_py() for n in ranking._names(ranking.INDEX_COLUMNS)[2:]]
    shard = ranking._Shard(blocked["doc_ids"].values, cells)
    asked = next(ranking._query_terms(iter([pa.record_batch([[1], [" ".join(query)]], names=["query", "text"])])))
    codes = np.searchsorted(vocabulary, np.array(asked["terms"][0].as_py()).view(np.uint64))
    every, scores = shard.best(codes, weights, 0, 3000)
    value = dict(zip(every.tolist(), scores.tolist()))
    least = sorted(value.values())[-5]
    skipped = seen = 0
    earlier: set[int] = set()
    for code, bounds in zip(codes, shard.bounds(codes, weights)):
        part = shard._list(code)
        starts = [part.start, *shard.block_ends[shard.first_block[code] : shard.last_block[code]]]
        for bound, low, high in zip(bounds, starts, starts[1:]):
            fresh = [d for d in shard.docs[low:high].tolist() if d not in earlier]
            assert all(value[d] <= bound for d in fresh)
            seen, skipped = seen + 1, skipped + (bound < least)
        earlier |= set(shard.docs[part].tolist())
    assert seen > 10 and skipped > seen / 4
