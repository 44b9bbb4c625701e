import random
import re

from frames import awkward, documents, prose
from pyspark.sql import functions as F

from stocktide.llm.pii import find_personal_data, sanitise

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def expected(text):
    spans = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        spans += [(m.start(), number, kind, m.end()) for m in re.finditer(pattern, text or "") if valid(kind, m[0])]
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def test_base_spans(spark):
    rng = random.Random(6)
    alphabet = "ab.@-+1 23 4(5)😀é\n%_"
    rows = awkward(rng)
    rows += [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(3000)]
    rows += [
        (5000, "a.b@c.d.@e.f@g.h"), (5001, "1.2.3.4.5.6.7.8 300.1.1.1.1 0000255.1.2.3"),
        (5002, "4111 1111 1111 1111-"), (5003, "x" * 200_000 + "@"), (5004, "a@" + "b." * 20_000 + "c"),
        (5005, "1 " * 20_000), (5006, "4111111111111111 " * 700), (5007, "+1 (017) 555-7713"),
    ]
    found = find_personal_data(documents(spark, rows))
    got = [(r.doc_id, [(s.kind, s.start, s.end) for s in r.base]) for r in found.collect()]
    assert sorted(got, key=str) == sorted(((d, expected(t)) for d, t in rows), key=str)


def disclosed(rng, n=400):
    """`quixote` comes with one address only, `zephyr` is everywhere, `hapax` comes with it once."""
    rows = [(2000 + i, prose(rng, 30) + " zephyr " + prose(rng, 9)) for i in range(n)]
    rows += [(1000 + i, f"{prose(rng, 4)} zephyr Quixote at don@mancha.es {prose(rng, 6)} quixote") for i in range(6)]
    rows += [(1100, prose(rng, 4) + " hapax don@mancha.es " + prose(rng, 4))]
    # Copies of one context are no further evidence.
    rows += [(1200 + i, "copied singular words sancho@panza.es in one context") for i in range(9)]
    return rows


def test_words_that_disclose_are_found(spark):
    rows = disclosed(random.Random(7))
    found = {r.doc_id: r for r in find_personal_data(documents(spark, rows)).collect()}
    texts = dict(rows)
    for i in range(1000, 1006):
        said = [texts[i][s.start : s.end] for s in found[i].spans if s.kind == "term"]
        assert said == ["Quixote", "quixote"]
        assert [s.kind for s in found[i].base] == ["email"]
    assert all(len(r.spans) == len(r.base) for d, r in found.items() if d not in range(1000, 1006))


def said_in(found, texts, i):
    return [texts[i][s.start : s.end] for s in found[i].spans if s.kind == "term"]


def test_words_far_from_their_entity_count_as_with_it(spark):
    """An entity in a third of all texts; its owner's name stands in those only, in half of them in a heading."""
    rng = random.Random(9)
    rows = [(i, prose(rng, 40)) for i in range(60)]
    rows += [(100 + i, f"{prose(rng, 20)} Dulcinea dulci@toboso.es {prose(rng, 20)}") for i in range(15)]
    rows += [(200 + i, f"Dulcinea {prose(rng, 20)} dulci@toboso.es {prose(rng, 20)}") for i in range(15)]
    found, texts = {r.doc_id: r for r in find_personal_data(documents(spark, rows)).collect()}, dict(rows)
    assert all(said_in(found, texts, i) == ["Dulcinea"] for i in texts if i >= 100)
    assert all(found[i].spans == [] for i in range(60))


def test_words_are_near_whatever_lies_between(spark):
    """A name behind a wide gap, and one beyond four very long words, on both sides; the sixth word is not near."""
    rng = random.Random(15)
    long = " ".join(c * 90 for c in "jkxz")
    rows = [(i, prose(rng, 40)) for i in range(60)]
    for i in range(5):
        rows.append((100 + i, f"{prose(rng, 9)} Rocinante{' ' * 500}a@toboso.es{'.' * 400} Alonso {prose(rng, 9)}"))
        rows.append((200 + i, f"{prose(rng, 9)} Farther Maritornes {long} b@toboso.es {long} Ginesillo further {prose(rng, 9)}"))
    found, texts = {r.doc_id: r for r in find_personal_data(documents(spark, rows)).collect()}, dict(rows)
    for i in range(5):
        assert said_in(found, texts, 100 + i) == ["Rocinante", "Alonso"]
        said = said_in(found, texts, 200 + i)
        assert said[0] == "Maritornes" and said[-1] == "Ginesillo" and set(said[1:-1]) == set(long.split())


def test_a_repeated_signature_is_evidence(spark):
    """One line with the same ten words around its entity in many texts that are otherwise different."""
    rng = random.Random(10)
    line = "\nWith the best regards from Sansona Carrasco sansona@salamanca.es sales department second floor\n"
    rows = [(i, prose(rng, 40)) for i in range(60)] + [(100 + i, prose(rng, 30) + line + prose(rng, 9)) for i in range(8)]
    found, texts = {r.doc_id: r for r in find_personal_data(documents(spark, rows)).collect()}, dict(rows)
    for i in range(100, 108):
        assert {"Sansona", "Carrasco"} <= set(said_in(found, texts, i))
    hidden = sanitise(documents(spark, rows)).where("doc_id >= 100").collect()
    assert len(hidden) == 8 and not any("Sansona" in r.text or "Carrasco" in r.text for r in hidden)


def test_sanitised_texts(spark):
    rng = random.Random(8)
    rows = disclosed(rng) + [
        (1, None), (2, ""), (3, "é😀 mail a.b@c.de now +1 (017) 555-7713 x"), (4, "10.0.0.1 and 4111 1111 1111 1111"),
        (5, "+1.22.33.44.55 overlaps"),
    ]
    docs = documents(spark, [r for r in rows if r[0] >= 1000] + rows[-5:] + [(9, "clean")] + rows[:300])
    clean = sanitise(docs)
    assert clean.columns == docs.columns
    got = {r.doc_id: r.text for r in clean.where("doc_id in (1, 2, 3, 4, 5, 9, 1000)").collect() if r.text != "clean"}
    texts = dict(rows)
    assert got[3] == "é😀 mail [EMAIL] now [PHONE] x"
    assert got[4] == "[IP] and [CARD]"
    assert "[" in got[5] and not re.search("[0-9]", got[5])
    hidden = re.sub("(?i)quixote", "[TERM]", texts[1000]).replace("don@mancha.es", "[EMAIL]")
    assert got[1000] == hidden
    assert clean.where("text is null").count() == docs.where("text is null").count()
    assert clean.where(F.col("node") != "x").count() == 0


def test_empty_table(spark):
    assert find_personal_data(documents(spark, [])).collect() == []
    assert sanitise(documents(spark, [])).collect() == []
