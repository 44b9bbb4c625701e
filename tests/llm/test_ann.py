import numpy as np
from pyspark.sql import functions as F

from stocktide.llm import ann
from stocktide.llm.ann import nearest


def frame(spark, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return made.withColumns({c: F.lit("x") for c in ("tree", "leaf", "ids", "vector", "score", "query")})


def expected(rows, queries, k):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and ok(v)]
    out = {}
    for i, v in queries:
        if i is None or not ok(v):
            continue
        q = np.array(v, dtype=float)
        near = {}
        for j, x in usable:
            if j != i:
                score = float(np.einsum("d,d->", q, x) / (np.linalg.norm(q) * np.linalg.norm(x)))
                near[j] = max(near.get(j, -9), score)
        out[i] = sorted(((-s, j) for j, s in near.items()))[:k]
    return out


def ok(v):
    if v is None or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v):
        return False
    return any(v)


def test_small_tables_are_searched_exactly(spark):
    rng = np.random.default_rng(15)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # one hot vector: ties go to smaller ids
    rows += [(2000, None), (2001, [0.0] * 8), (2002, [None] + [1.0] * 7), (2003, [float("nan")] * 8), (2004, []),
             (2005, [float("inf")] * 8), (2006, [1.0, 2.0]), (None, rows[1][1]), (5, rows[5][1])]
    queries = [r for r in rows if r[0] is None or r[0] % 50 == 0 or r[0] > 1990]
    got = nearest(frame(spark, rows), frame(spark, queries), k=5).collect()
    want = expected(rows, queries, 5)
    by_query = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by_query.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by_query) == set(want)
    for i, found in by_query.items():
        assert [(n, j) for n, j, _ in found] == [(n + 1, j) for n, (_, j) in enumerate(want[i])]
        assert all(abs(s + w) < 1e-12 for (_, _, s), (w, _) in zip(found, want[i]))


def test_recall_of_a_real_search(spark, monkeypatch):
    monkeypatch.setattr(ann, "SEARCH_LEAST", 100)
    rng = np.random.default_rng(16)
    vectors = rng.normal(size=(4000, 16)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    queries = rows[::100]
    got = nearest(frame(spark, rows), frame(spark, queries), k=5, share=0.5).collect()
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    hits = 0
    for i, _ in queries:
        score = unit @ unit[i]
        score[i] = -2
        hits += len(set(np.argsort(-score)[:5]) & {r.vec_id for r in got if r.query_id == i})
    assert hits / (5 * len(queries)) >= 0.9


def test_full_leaves_are_split(spark, monkeypatch):
    monkeypatch.setattr(ann, "MEMBER_BLOCK", 16)
    monkeypatch.setattr(ann, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(17)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(200)]
    got = nearest(frame(spark, rows), frame(spark, rows[::10]), k=3).collect()
    want = expected(rows, rows[::10], 3)
    assert {(r.query_id, r["rank"]): r.vec_id for r in got} == {
        (i, n + 1): j for i, near in want.items() for n, (_, j) in enumerate(near)
    }


def test_few_or_no_rows(spark):
    none = frame(spark, [])
    one = frame(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0])])
    assert nearest(none, none).collect() == []
    assert nearest(one, none).collect() == []
    assert [(r.query_id, r.vec_id) for r in nearest(one, one).orderBy("query_id").collect()] == [(0, 1), (1, 0)]
