"""The whole pipeline on a small table with cases planted, stage by stage against the operators' tests."""

import random

import pytest
from frames import prose

import corpus_pipeline

NAMES = ["quality", "near_dedup", "decontamination", "pii", "packing"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """{what: ids} and the folder of tables: clean and junk documents, copies, passages, personal data."""
    rng = random.Random(22)
    folder = str(tmp_path_factory.mktemp("sf"))
    rows, labels = [], []
    for i in range(300):
        good = i % 4 > 0
        text = prose(rng, rng.randrange(30, 120), 3000)
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        labels.append((i, int(good), 0))
    passage = prose(rng, 25, 9000)
    clean = [(1000 + i, prose(rng, 60, 3000)) for i in range(30)]
    copied = prose(rng, 80, 3000)
    near = copied.split(" ")
    near[40] = "altered"
    copies = [(2000, copied), (2001, copied), (2002, " ".join(near))]
    leaked = [(3000, prose(rng, 30, 3000) + " " + passage.upper() + " " + prose(rng, 30, 3000))]
    private = [(4000, prose(rng, 40, 3000) + " write to ann@example.org or +1 (017) 555-7713")]
    odd = [(5000, None), (5001, "")]
    documents = rows + clean + copies + leaked + private + odd
    frame = spark.createDataFrame([(*r, "en", "src") for r in documents], "doc_id bigint, text string, lang string, source string")
    frame.selectExpr("*", "length(text) as n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(documents)


def test_stages(spark, planted):
    folder, texts = planted
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {"start": set(texts)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    junk = {i for i in range(300) if i % 4 == 0}
    assert len(kept["quality"] & junk) <= 4 and len(kept["quality"] - junk) >= len(texts) - len(junk) - 4
    assert kept["quality"] - kept["near_dedup"] == {2001, 2002}
    assert kept["near_dedup"] - kept["decontamination"] == {3000}
    assert kept["pii"] == kept["decontamination"]
    found = {r.doc_id: r.text for r in docs.collect()}
    assert found[4000].endswith(" write to [EMAIL] or [PHONE]")
    assert all(found[i] == texts[i] for i in found if i != 4000)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {p.doc_id for p in pieces} == kept["pii"]
    assert sum(p.length for p in pieces) == sum(len(p.ids) for p in pieces)


@pytest.fixture()
def stored(spark, planted, tmp_path):
    """Rows (doc_id, text) as a stored table of several files, one as Spark would not read it as it is."""

    def make(rows):
        frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
        frame.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
        return docs, docs.select("doc_id", "text").distinct().union(docs.limit(0))

    return make


def test_near_dedup_of_repeated_and_null_ids(spark, planted, stored):
    rng = random.Random(23)
    a, b, c, d, e = (prose(rng, 60, 3000) for _ in range(5))
    near = a.replace(a.split(" ")[30], "altered")
    # Rows of id 1 differ; of id 2 one is a near copy of 1's; rows without an id repeat each other and 1's.
    rows = [(1, a), (1, b), (2, near), (2, c), (None, d), (None, d), (None, e), (None, b), (3, e), (None, ""), (None, "")]
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    want = [(1, a), (1, b), (2, c), (None, d), (3, e)]
    for docs, blank in zip(stored(rows), (2, 1)):
        got = [tuple(r) for r in stage(spark, docs, planted[0]).collect()]
        assert sorted(got, key=str) == sorted(want + [(None, "")] * blank, key=str)


def test_decontamination_of_repeated_and_null_ids(spark, planted, stored):
    folder, texts = planted
    rng = random.Random(24)
    clean = [(1, prose(rng, 30, 3000)), (None, prose(rng, 30, 3000)), (None, prose(rng, 30, 3000)), (2, None), (None, None)]
    leaked = [(1, texts[3000]), (None, texts[3000] + " more"), (2, "x " + texts[3000])]
    stage = dict(corpus_pipeline.STAGES)["decontamination"]
    for docs in stored(clean + leaked):
        assert sorted(map(tuple, stage(spark, docs, folder).collect()), key=str) == sorted(clean, key=str)


def test_empty_documents(spark, planted, tmp_path):
    folder, _ = planted
    empty = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
