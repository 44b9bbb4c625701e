import math
import re
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from stocktide.llm.license_scan import NOTICES, TEMPLATES, THRESHOLD, scan_licences, telling_words, words


def frame(spark, rows):
    made = spark.createDataFrame(rows, "path string, text string")
    return made.withColumns({c: F.lit("x") for c in ("word", "line", "licence", "directory", "above", "cosine")})


ROWS = [
    ("a/LICENSE", "Released under the MIT License.\nmore"), ("a/b/c/x.txt", "nothing"), ("a/b/copying.txt", "text only"),
    ("a/b/y.txt", "Intro. Licensed under the Apache License, Version 2.0. End"), ("a/d/LICENCE.md", NOTICES["GPL-3.0"]),
    ("a/d/e/z.txt", None), ("a/d/w.txt", ""), ("q/r.txt", "Licensed"), (None, "x"), ("top.txt", "the the the"),
    ("a/d/NOTICE", NOTICES["MPL-2.0"]), ("rep/x", "first"), ("rep/x", NOTICES["CC-BY-4.0"]), ("é/ü.txt", "x " * 50_000),
    ("m/n.txt", "RELEASED UNDER THE MIT LICENSE"), ("m/o.txt", "a licence is under the terms of version"),
] + [(f"many/{i}.txt", "the license of the general public is released") for i in range(30)]


def brute():
    """Every sentence against every notice, in plain Python."""
    n = len(ROWS)
    vocabulary = {w for t in NOTICES.values() for w in words(t)}
    df = Counter(w for _, t in ROWS for w in set(words(t or "")) & vocabulary)
    idf = lambda w: math.log((1 + n) / (1 + df[w])) + 1 if w in vocabulary else math.log(1 + n) + 1
    vector = lambda t: {w: c * idf(w) for w, c in Counter(words(t)).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    own = {}
    for path, text in ROWS:
        for sentence in re.split("\n", (text or "").replace(". ", ".\n")):
            line = vector(sentence)
            for licence, notice in NOTICES.items():
                other = vector(notice)
                dot = sum(x * other.get(w, 0) for w, x in line.items())
                score = round(dot / (length(line) * length(other)), 6) if dot else 0
                if score >= THRESHOLD:
                    own.setdefault(path or "", []).append((-score, licence))
    own = {p: min(found) for p, found in own.items()}
    out = {}
    for path in {p or "" for p, _ in ROWS}:
        if path in own:
            out[path] = (own[path][1], "own", None)
            continue
        directory, out[path] = path.rpartition("/")[0], (None, "none", None)
        while True:
            here = [(own[p][0], p) for p in own if p.rpartition("/")[0] == directory
                    and re.match("(?i)(licen[cs]e|copying|notice)", p.rpartition("/")[2])]
            if here:
                out[path] = (own[min(here)[1]][1], "inherited", min(here)[1])
                break
            if not directory:
                break
            directory = directory.rpartition("/")[0]
    return out


def test_against_plain_python(spark):
    found = scan_licences(frame(spark, ROWS)).collect()
    got = {r.path: (r.licence, r.origin, r.licence_file) for r in found}
    assert len(found) == len(got) and got == brute()
    assert got["a/b/c/x.txt"] == ("MIT", "inherited", "a/LICENSE")
    assert got["a/d/e/z.txt"][1] == "inherited" and got["q/r.txt"][1] == "none"


def true_cosines(rows):
    """{path: (licence, cosine)} with frequencies of every word over all files, in plain Python."""
    files = {}
    for path, text in rows:
        files.setdefault(path, []).append(text)
    n = len(files)
    df = Counter(w for texts in files.values() for w in {w for t in texts for w in words(t)})
    vector = lambda t: {w: c * (math.log((1 + n) / (1 + df[w])) + 1) for w, c in Counter(words(t)).items()}
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    out = {}
    for path, text in rows:
        for line in map(vector, text.replace(". ", ".\n").split("\n")):
            for licence, other in ((k, vector(v)) for k, v in NOTICES.items()):
                score = sum(x * other.get(w, 0) for w, x in line.items()) / (length(line) * length(other) or 1)
                if score >= THRESHOLD:
                    out[path] = min(out.get(path, (0, "")), (-round(score, 6), licence))
    return out


def test_all_words_weigh_by_their_frequency(spark):
    """A notice with ordinary words more is found however many files there are, one with rare words is not."""
    said, odd = "This code is released under the MIT License", "Released under the MIT License grmpf hrmpf zork blax quux dorf wimp"
    for n in (40, 3000):
        rows = [(f"s/{i}.txt", "the code is this") for i in range(n)] + [("s/code.c", said), ("s/odd.c", odd)]
        rows += [("s/code.c", "code is again"), ("s/mit.txt", "mit license"), ("s/r.txt", "released license grmpf")]
        docs = spark.createDataFrame(rows, "path string, text string").repartition(3)
        found = {r.path: r for r in scan_licences(docs).where("origin = 'own'").collect()}
        want = true_cosines(rows)
        assert set(found) == set(want) and found["s/code.c"].licence == "MIT" and "s/odd.c" not in found
        assert all(abs(found[p].cosine + c) < 2e-6 and found[p].licence == l for p, (c, l) in want.items())


def test_telling_words_cover_every_notice():
    vocabulary = {w for t in NOTICES.values() for w in words(t)}
    idf = {w: 1 + len(w) % 3 for w in vocabulary}
    told = set(telling_words(NOTICES, idf, THRESHOLD))
    for text in NOTICES.values():
        weight = {w: n * idf[w] for w, n in Counter(words(text)).items()}
        rest = math.sqrt(sum(x * x for w, x in weight.items() if w not in told))
        assert rest < THRESHOLD * math.sqrt(sum(x * x for x in weight.values()))


def test_empty_table(spark):
    assert scan_licences(frame(spark, [])).collect() == []


def wrapped(text, width, mark):
    """A text as the comment at the head of a file."""
    return "\n".join(f"{mark} {line}" for line in textwrap.wrap(text.replace("\n", " "), width))


def test_headers_bodies_and_titles(spark):
    body = lambda name: TEMPLATES[name]
    gpl = wrapped(body("GPL-3.0 header"), 50, " *")
    rows = [
        ("mit/LICENSE", "Copyright (c) 2020 Jane Roe\n\n" + body("MIT body").replace(" THE SOFTWARE IS", "\n\nTHE SOFTWARE IS", 1)),
        ("mit/src/deep/a.py", "print(1)"), ("bsd/COPYING", "Copyright 2021, Some One. All rights reserved.\n\n" + body("BSD-3-Clause body")),
        ("bsd/x.c", "int x;"), ("gpl/y.c", f"/*\n{gpl}\n */\n\nint y;\n"), ("gpl/none.c", "int z;"),
        ("apache/run.sh", "#!/bin/sh\n" + wrapped(body("Apache-2.0 header"), 70, "#") + "\n\necho hi"),
        ("apache/old.sh", "#\n# Copyright 1999\n\n" + wrapped(body("GPL-2.0 header"), 60, "#")),
        ("full/LICENSE.txt", "   GNU GENERAL PUBLIC LICENSE\n      Version 3, 29 June 2007\n\n" + "some terms of many pages " * 3000),
        ("full/sub/b.c", ""), ("mpl/LICENCE", "Mozilla Public License Version 2.0\n==================================\n\n1. Definitions"),
        ("plain/README", "you can use this software and copy the files to any person, see the notice"), ("plain/long", "word " * 50_000),
    ]
    rows += [(f"other/{i}.txt", f"a text of the {i} kind with the use of this and that for any software or files") for i in range(60)]
    found = {r.path: (r.licence, r.origin, r.licence_file) for r in scan_licences(frame(spark, rows)).collect()}
    assert {path: of for path, of in found.items() if of[1] != "none"} == {
        "mit/LICENSE": ("MIT", "own", None), "mit/src/deep/a.py": ("MIT", "inherited", "mit/LICENSE"),
        "bsd/COPYING": ("BSD-3-Clause", "own", None), "bsd/x.c": ("BSD-3-Clause", "inherited", "bsd/COPYING"),
        "gpl/y.c": ("GPL-3.0", "own", None), "apache/run.sh": ("Apache-2.0", "own", None), "apache/old.sh": ("GPL-2.0", "own", None),
        "full/LICENSE.txt": ("GPL-3.0", "own", None), "full/sub/b.c": ("GPL-3.0", "inherited", "full/LICENSE.txt"),
        "mpl/LICENCE": ("MPL-2.0", "own", None),
    }


def test_templates_tell_each_other_apart(spark):
    """Each template as a file's only paragraph is found as its own licence."""
    rows = [(f"{i}/file", text) for i, text in enumerate(TEMPLATES.values())] + [(f"o/{i}", "other words of the file") for i in range(40)]
    found = {r.path: r.licence for r in scan_licences(frame(spark, rows)).where("origin = 'own'").collect()}
    assert found == {f"{i}/file": name.split(" ")[0] for i, name in enumerate(TEMPLATES)}
