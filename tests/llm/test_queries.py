"""Each registered query over one small folder of tables, against its SQL or plain Python written from its description."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from frames import LOWER, prose
from tokenizers import Tokenizer

from stocktide.llm.queries import QUERIES, SQL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _odd_documents(benchmark):
    rng = random.Random(31)
    same = prose(rng, 60)
    near = same.replace(same.split()[0], "other", 1)
    texts = [
        None, "", " \t\r\n", "One two", "one TWO", same, same.upper(), near, prose(rng, 30_000), "é" * 40 + " Ünï 😀",
        f"{prose(rng, 30)} {benchmark[0]} {prose(rng, 5)}", "a@b.c d@e.f.g 1.2.3.4 256.1.1.1 1.2.3.4.5 a@b",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 +1 (555) 010-9999 +12 34567 x@y.zz,x@y.zz", "😀 a@b.cc 10.0.0.1",
    ]
    return [(900_000 + i, text) for i, text in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(sf_dir, tmp_path_factory):
    """The smallest tables with awkward rows added."""
    at = tmp_path_factory.mktemp("tables")
    tables = {name: pq.read_table(f"{sf_dir}/{name}.parquet") for name in TABLES}

    def more(name, rows):
        schema = tables[name].schema
        tables[name] = pa.concat_tables([tables[name], pa.Table.from_pylist(rows, schema)])

    more("documents", [{"doc_id": i, "text": t} for i, t in _odd_documents(tables["benchmark"]["text"].to_pylist())])
    html = tables["pages"]["html"][0].as_py()
    more("pages", [
        {"page_id": 900_000, "url": None, "html": html}, {"page_id": 900_001, "url": "http://a\x7f\n", "html": None},
        {"page_id": 900_002, "url": "", "html": ""}, {"page_id": -5, "url": "é", "html": html},
    ])
    more("benchmark", [{"item_id": 900_000, "text": None}, {"item_id": 900_001, "text": "one two"}])
    width = len(tables["embeddings"]["embedding"][0].as_py())
    more("embeddings", [
        {"vec_id": 900_000, "embedding": None, "label": 1}, {"vec_id": 900_100, "embedding": [0.0] * width, "label": 1},
        {"vec_id": 900_200, "embedding": [float("nan")] * width, "label": 2},
        {"vec_id": 900_300, "embedding": [0.5] * width, "label": None},
    ])
    for name, table in tables.items():
        pq.write_table(table, at / f"{name}.parquet")
    return str(at)


def rows(spark, folder, name):
    return QUERIES[name](spark, folder).collect()


def texts(folder):
    table = pq.read_table(f"{folder}/documents.parquet")
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, folder, name):
    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    asked = database.execute(SQL[name])
    columns = [c[0] for c in asked.description]
    expected = Counter(tuple(zip(columns, row)) for row in asked.fetchall())
    assert Counter(tuple((c, row[c]) for c in columns) for row in rows(spark, folder, name)) == expected


def _lower_words(pattern, text):
    return re.findall(pattern, (text or "").translate(LOWER))


def test_op2_near_dedup(spark, folder):
    sets = {}
    for doc, text in texts(folder).items():
        words = _lower_words(r"[^\x20\x09-\x0D]+", text)
        sets[doc] = {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()
    parent = {doc: doc for doc in sets}

    def root(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    holders = defaultdict(list)
    for doc, found in sets.items():
        for shingle in found:
            holders[shingle].append(doc)
    shared = Counter((a, b) for docs in holders.values() for a in docs for b in docs if a < b)
    for (a, b), both in shared.items():
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    expected = {(doc, len(found), root(doc), root(doc) == doc) for doc, found in sets.items()}
    got = rows(spark, folder, "op2_near_dedup")
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == expected and len(got) == len(expected)
    assert root(900_007) == root(900_006) == 900_005 and root(900_004) == 900_003


def test_op4_packing(spark, folder):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts(folder).items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, folder, "op4_packing"):
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(struct.pack(f"<{len(part)}I", *part)) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for doc, found in pieces.items():
        ends = [0]
        for start, length in sorted(found):
            assert start == ends[-1] and length > 0
            ends.append(start + length)
        assert ends[-1] == len(ids[doc])
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(map(len, ids.values()))
    assert total / (2048 * len(sequences)) > 0.9


def test_op5_nearest(spark, folder):
    table = pq.read_table(f"{folder}/embeddings.parquet")
    vectors = {
        i: np.array(v, dtype=float)
        for i, v in zip(table["vec_id"].to_pylist(), table["embedding"].to_pylist())
        if v is not None and np.isfinite(v).all() and np.any(v)
    }
    ids = np.array(sorted(vectors))
    unit = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    found = defaultdict(list)
    for r in rows(spark, folder, "op5_nearest"):
        assert abs(r.score - unit[ids == r.query_id][0] @ unit[ids == r.vec_id][0]) < 1e-12
        found[r.query_id].append((r.rank, -r.score, r.vec_id))
    hits = asked = 0
    for at in np.flatnonzero(ids % 50 == 0):
        scores = unit @ unit[at]
        best = [i for i in np.lexsort((ids, -scores)) if i != at][:5]
        got = sorted(found.pop(ids[at]))
        assert [g[0] for g in got] == [1, 2, 3, 4, 5] and [g[1:] for g in got] == sorted(g[1:] for g in got)
        hits += len({g[2] for g in got} & set(ids[best]))
        asked += 5
    assert not found and hits >= 0.9 * asked


def test_op6_decontamination(spark, folder):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    items = pq.read_table(f"{folder}/benchmark.parquet")
    windows = defaultdict(set)
    for item, text in zip(items["item_id"].to_pylist(), items["text"].to_pylist()):
        words = _lower_words(pattern, text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add(item)
    sizes = {len(w) for w in windows}
    expected = set()
    for doc, text in texts(folder).items():
        words, hit, found = _lower_words(pattern, text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                here = windows.get(tuple(words[i : i + size]))
                if here:
                    hit.update(range(i, i + size))
                    found |= here
        listed = ",".join(sorted(map(str, found)))
        digest = hashlib.sha256(listed.encode()).hexdigest()
        expected.add((doc, len(words), len(hit), len(found), digest, bool(hit)))
    got = rows(spark, folder, "op6_decontamination")
    assert {tuple(r)[:6] for r in got} == expected and len(got) == len(expected)
    assert {r.doc_id for r in got if r.contaminated} >= {900_003, 900_004, 900_010}


def _luhn(digits):
    doubled = [d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def test_op8_pii(spark, folder):
    digits = lambda s: [int(c) for c in s if "0" <= c <= "9"]
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 12 <= len(digits(s)) <= 19 and _luhn(digits(s))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15),
    }
    expected = {}
    for doc, text in texts(folder).items():
        spans = sorted(
            (m.start(), number, kind, m.end())
            for number, (kind, (pattern, fits)) in enumerate(kinds.items())
            for m in re.finditer(pattern, text or "")
            if fits(m.group())
        )
        listed = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
        counts = Counter(s[2] for s in spans)
        expected[doc] = (*(counts[k] for k in kinds), hashlib.sha256(listed.encode()).hexdigest(), listed)
    got = rows(spark, folder, "op8_pii")
    assert {r.doc_id: tuple(r)[1:6] for r in got} == {d: e[:5] for d, e in expected.items()} and len(got) == len(expected)
    for r in got:
        assert set(expected[r.doc_id][5].split(",")) <= set(r.spans.split(",")) | {""}
    assert sum(expected[900_012][:4]) > 2


def _fold(doc, folds, fold):
    return zlib.crc32(str(doc).encode()) % folds == fold


def test_op7_language_id(spark, folder):
    table = pq.read_table(f"{folder}/documents.parquet")
    langs = dict(zip(table["doc_id"].to_pylist(), table["lang"].to_pylist()))
    said = texts(folder)
    learnt = {lang for doc, lang in langs.items() if lang is not None and not _fold(doc, 3, 1)}
    got = rows(spark, folder, "op7_language_id")
    assert len(got) == len(said)
    for r in got:
        assert r.held_out == _fold(r.doc_id, 3, 1) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in said[r.doc_id] or "")
        assert r.lang_pred in learnt if letters else r.lang_pred == "und"
    asked = [r.lang_pred == langs[r.doc_id] for r in got if r.held_out and langs[r.doc_id] in learnt]
    assert len(asked) > 20 and sum(asked) >= 0.9 * len(asked)


def test_op9_quality(spark, folder):
    table = pq.read_table(f"{folder}/labels.parquet")
    labels = dict(zip(table["doc_id"].to_pylist(), table["quality"].to_pylist()))
    got = rows(spark, folder, "op9_quality")
    assert {r.doc_id for r in got} == texts(folder).keys()
    for r in got:
        assert r.held_out == _fold(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    scored = {1: [], 0: []}
    for r in got:
        if r.held_out and labels.get(r.doc_id) is not None:
            scored[labels[r.doc_id]].append(r.score)
    ordered = [(a > b) + 0.5 * (a == b) for a in scored[1] for b in scored[0]]
    assert len(ordered) > 10 and sum(ordered) >= 0.8 * len(ordered)


def test_op10_warc(spark, folder):
    table = pq.read_table(f"{folder}/pages.parquet")
    payloads = {p: (h or "").encode() for p, h in zip(table["page_id"].to_pylist(), table["html"].to_pylist())}
    first = {}
    for page in sorted(payloads):
        first.setdefault(payloads[page], page)
    expected = {
        (page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
         "response" if first[data] == page else "revisit", None if first[data] == page else first[data])
        for page, data in payloads.items()
    }
    got = rows(spark, folder, "op10_warc")
    assert {tuple(r)[:5] for r in got} == expected and len(got) == len(expected)


def test_op12_token_planes(spark, folder):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = set(), 0
    for doc, text in sorted(texts(folder).items()):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected.add((doc, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    got = rows(spark, folder, "op12_token_planes")
    assert {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got} == expected and len(got) == len(expected)
