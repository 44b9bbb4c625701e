import random

from frames import awkward, documents, prose, splits

from stocktide.llm import decontaminate
from stocktide.llm.decontaminate import find_passages

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def expected(rows, items, window):
    windows = {}
    for item, text in items:
        words = splits(WORD, text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add("null" if item is None else str(item))
    out = []
    for doc, text in rows:
        words, hit, names = splits(WORD, text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    names |= found
        out.append((doc, len(words), len(hit), sorted(names)))
    return sorted(out, key=str)


def case():
    rng = random.Random(2)
    items = [(i, prose(rng, rng.randrange(1, 30), 60)) for i in range(40)]
    items += [(3, prose(rng, 20)), (None, prose(rng, 20)), (50, None), (51, ""), (52, "...")]
    rows = awkward(rng)
    rows += [(100 + i, prose(rng, rng.randrange(0, 80), 60)) for i in range(200)]
    for i in range(60):
        item = rng.choice(items)[1] or ""
        rows.append((400 + i, prose(rng, rng.randrange(9)) + ", " + item.upper() + "! " + prose(rng, 3)))
    # A passage cut by the end of one document must not go on in the next.
    half = items[20][1].split(" ")
    rows += [(600, " ".join(half[: len(half) // 2])), (601, " ".join(half[len(half) // 2 :]))]
    return rows, items


def found_in(spark, rows, items):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = find_passages(documents(spark, rows), benchmark)
    for r in found.collect():
        assert set(r.items) <= set(r.near_items)
        assert r.n_hit == sum(h.end - h.start for h in r.hits)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=str)


def test_against_every_window(spark):
    rows, items = case()
    assert found_in(spark, rows, items) == expected(rows, items, 10)


def test_several_passes_agree_with_one(spark, monkeypatch):
    rows, items = case()
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 150)
    assert found_in(spark, rows, items) == expected(rows, items, 10)


def test_near_matches(spark):
    rng = random.Random(3)
    words = prose(rng, 10).split(" ")
    moved = words[:4] + ["zz"] + words[4:]
    benchmark = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    rows = [(1, " ".join(moved)), (2, " ".join(words[:9])), (3, " ".join(words))]
    found = {r.doc_id: r for r in find_passages(documents(spark, rows), benchmark).collect()}
    assert [found[i].near_items for i in (1, 2, 3)] == [["1"], [], ["1"]]
    assert [found[i]["items"] for i in (1, 2, 3)] == [[], [], ["1"]]


def test_near_matches_at_either_end_of_a_document(spark):
    """A window's words with one that stands one or two words too early, at the start of documents that are
    first in their shard and that are not."""
    rng = random.Random(4)
    words = prose(rng, 10).split(" ")
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, "left right")], "item_id bigint, text string")
    early = [" ".join([words[2], *words[:2], *words[3:]]), " ".join([words[1], words[0], *words[2:]])]
    rows = [(0, early[0]), (1, prose(rng, 5)), (2, early[0]), (3, early[1]), (4, "right left"), (5, "left"), (6, "right")]
    # Common elsewhere, so that the word that stands too early is the rarest.
    for first in (words[2], words[1]):
        others = [w for w in words if w != first]
        rows_here = rows + [(10 + i, " ".join(rng.sample(others, 4))) for i in range(30)]
        docs = documents(spark, rows_here).coalesce(1).sortWithinPartitions("doc_id")
        found = {r.doc_id: r.near_items for r in find_passages(docs, benchmark).collect()}
        assert {d: found[d] for d in range(7)} == {0: ["1"], 1: [], 2: ["1"], 3: ["1"], 4: ["2"], 5: [], 6: []}
        assert all(found[d] == [] for d in range(10, 40))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert find_passages(documents(spark, []), some).collect() == []
    assert [r.n_hit for r in find_passages(documents(spark, [(1, "a b c")]), none).collect()] == [0]
