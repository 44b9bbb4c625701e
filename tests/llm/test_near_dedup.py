import os
import random
from collections import defaultdict

from frames import awkward, documents, prose, splits

from stocktide.llm import tables
from stocktide.llm.graph import components
from stocktide.llm.near_dedup import near_duplicates
from stocktide.shared_dir import new_folder, shared_dir


def shingles(text, size):
    words = splits(r"[^\x20\x09-\x0D]+", text)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def expected(rows, size, percent):
    """component of each row, by comparing every pair."""
    sets = [shingles(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[root(i)].append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        known = [d for d in ids[root(i)] if d is not None]
        component = doc if not sets[i] else min(known, default=None)
        out.append((doc, len(sets[i]), component, doc == component))
    return sorted(out, key=str)


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def test_against_all_pairs(spark):
    rng = random.Random(1)
    rows = awkward(rng)
    base, passage = prose(rng, 150), prose(rng, 70)
    # Copies with more and more edits: some within reach of the first, some only of one another.
    rows += [(100 + i, edited(rng, base, i % 12)) for i in range(150)]
    # A passage that many documents share, in parts that are too small or just large enough.
    rows += [(400 + i, passage + " " + prose(rng, 5 + i)) for i in range(60)]
    rows += [(600 + i, prose(rng, 50)) for i in range(100)]
    chain = prose(rng, 100).split(" ")
    rows += [(800 + i, " ".join(chain[4 * i :] + prose(rng, 4 * i).split(" ")[: 4 * i])) for i in range(8)]
    rng.shuffle(rows)
    found = near_duplicates(documents(spark, rows), 4, 80)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == expected(rows, 4, 80)


def test_empty_table(spark):
    assert near_duplicates(documents(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (200, 201)]
    found = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert found == {i: 0 for i in range(21)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}


def _tables_at_once(spark, monkeypatch, run):
    """The most tables and checkpoints that lie in the shared folder when another table is begun, and how many are begun."""
    top, counts = shared_dir(spark).removeprefix("file:"), []

    def counted(session, name):
        counts.append(sum("-" in name or name.startswith("rdd") for _, names, _ in os.walk(top) for name in names))
        return new_folder(session, name)

    monkeypatch.setattr(tables, "new_folder", counted)
    new_folder(spark, "none")
    run()
    return max(counts) - counts[0], len(counts)


def test_tables_go_once_they_are_superseded(spark, monkeypatch):
    rng = random.Random(3)
    base = prose(rng, 150)
    rows = [(i, edited(rng, base, i % 12)) for i in range(60)] + [(100 + i, prose(rng, 50)) for i in range(20)]
    most, begun = _tables_at_once(spark, monkeypatch, lambda: near_duplicates(documents(spark, rows), 4, 80).collect())
    assert begun > 25 and most <= 16


def test_components_of_one_star_take_one_step(spark, monkeypatch):
    links = spark.createDataFrame([(0, i) for i in range(1, 30)], "a bigint, b bigint")
    found = []
    _, begun = _tables_at_once(spark, monkeypatch, lambda: found.extend(components(links).collect()))
    assert sorted(map(tuple, found)) == [(i, 0) for i in range(30)]
    assert begun == 1
