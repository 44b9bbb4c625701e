import random

import pytest
from frames import awkward, documents, prose
from pyspark.sql import functions as F

from stocktide.llm.quality import held_out, learn, scores, with_scores


def labelled(rng, n):
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = prose(rng, rng.randrange(20, 200), 500)
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good)))
    return rows, labels


@pytest.fixture(scope="module")
def learnt(spark):
    rows, labels = labelled(random.Random(9), 600)
    frame = spark.createDataFrame(labels + [(None, 1), (5000, None), (3, 1)], "doc_id bigint, label int")
    return learn(documents(spark, rows).where("doc_id < 450"), frame)


def test_held_out_texts_are_told_apart(spark, learnt):
    rows, labels = labelled(random.Random(9), 600)
    good = dict(labels)
    found = {r.doc_id: r.score for r in scores(documents(spark, rows), learnt).where("doc_id >= 450").collect()}
    right = sum((s >= 0.5) == bool(good[d]) for d, s in found.items())
    assert len(found) == 150 and right >= 145


def test_awkward_texts(spark, learnt):
    rows = awkward(random.Random(10))
    found = scores(documents(spark, rows), learnt).collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted((d for d, _ in rows), key=str)
    assert all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2)}) == 1
    docs = documents(spark, rows)
    kept = with_scores(docs, learnt)
    assert sorted(kept.columns) == sorted(docs.columns)
    assert kept.schema["score"].dataType.simpleString() == "double"


def test_without_labels_or_texts(spark):
    none = spark.createDataFrame([], "doc_id bigint, label int")
    docs = documents(spark, [(1, "some text"), (2, None)])
    assert [r.score for r in scores(docs, learn(docs, none)).collect()] == [0.5, 0.5]
    assert scores(documents(spark, []), learn(documents(spark, []), none)).collect() == []
    one = spark.createDataFrame([(1, 1)], "doc_id bigint, label int")
    assert all(r.score > 0.5 for r in scores(docs, learn(docs, one)).collect())


def test_fold(spark):
    rows = spark.createDataFrame([(0,), (10,), (None,)], "doc_id bigint")
    got = rows.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("out")).collect()
    import zlib

    want = [(d, zlib.crc32(str(d).encode()) % 5 == 0 if d is not None else False) for d in (0, 10, None)]
    assert list(map(tuple, got)) == want
