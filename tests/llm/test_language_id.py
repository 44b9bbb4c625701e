import random

import pytest
from frames import awkward, documents
from pyspark.sql import functions as F

from stocktide.llm import language_id
from stocktide.llm.language_id import counts, learn, letter_table, predict

SYLLABLES = {
    "aa": ["tion", "the", "ing", "er", "wh"], "bb": ["ñez", "ción", "que", "os", "ll"],
    "cc": ["sch", "ung", "keit", "ü", "tz"],
}


def text_in(rng, lang, words):
    said = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(words)]
    return " ".join(said)


@pytest.fixture(scope="module")
def learnt(spark):
    rng = random.Random(11)
    rows = [(i, text_in(rng, lang, rng.randrange(3, 60)), lang) for i in range(300) for lang in [rng.choice("abc") * 2]]
    rows += [(1000, None, "aa"), (1001, "", "bb"), (1002, "text of nobody", None), (1003, "123", "cc")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    return learn(frame.withColumn("key", F.lit("x")).withColumn("at", F.lit(1)))


def test_new_texts_are_told_apart(spark, learnt):
    rng = random.Random(12)
    lang = {i: rng.choice("abc") * 2 for i in range(200)}
    rows = [(i, text_in(rng, lang[i], 12).upper() if i % 3 else text_in(rng, lang[i], 12)) for i in lang]
    found = predict(documents(spark, rows), learnt).collect()
    assert sum(r.lang_pred == lang[r.doc_id] for r in found) >= 198
    assert all(0 <= r.score <= 1 for r in found)


def test_awkward_texts(spark, learnt):
    rows = awkward(random.Random(13)) + [(20, "12 34 !!"), (21, "ñez")]
    found = predict(documents(spark, rows), learnt).collect()
    assert len(found) == len(rows)
    undetermined = {r.doc_id for r in found if r.lang_pred == "und"}
    assert undetermined == {1, 2, 3, 20}
    assert all(r.score == 0 for r in found if r.doc_id in undetermined)


def test_nothing_learnt(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    found = predict(documents(spark, [(1, "text")]), learn(none)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)]
    assert predict(documents(spark, []), learn(none)).collect() == []


def test_long_texts_are_counted_whole(monkeypatch):
    text = text_in(random.Random(14), "bb", 3000)
    whole = counts(text, letter_table())
    monkeypatch.setattr(language_id, "PIECE_CHARS", 97)
    assert (counts(text, letter_table()) == whole).all()
    n = len(language_id._runs(text, letter_table()))
    assert whole.sum() == n + (n - 1) + (n - 2)


def _three_languages(spark):
    rng = random.Random(16)
    rows = [(i, text_in(rng, lang, 20), lang) for i in range(120) for lang in ["aa" if i % 10 < 6 else "bb" if i % 10 < 9 else "cc"]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string")


def test_slices_of_a_frequent_language_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_TEXTS", 30)
    docs, models = _three_languages(spark), []
    for slices in (1, 64):
        monkeypatch.setattr(language_id, "SLICES", slices)
        models.append(learn(docs))
    assert (models[0].weights == models[1].weights).all() and models[0].temperature == models[1].temperature


def test_of_too_many_languages_the_frequent_are_learnt(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_TEXTS", 2)
    assert learn(_three_languages(spark)).languages == ("aa", "bb")
    even = _three_languages(spark).where("doc_id % 10 in (0, 7, 9)")
    assert learn(even).languages == ("aa", "bb")
