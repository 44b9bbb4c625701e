import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from frames import awkward, documents, prose
from tokenizers import Tokenizer

from stocktide.llm import token_planes, tokens
from stocktide.llm.token_planes import from_planes, read_tokens, to_planes, token_round_trip, write_tokens
from stocktide.shared_dir import new_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoded(texts):
    made = Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, 0] for e in made]


def test_ids_are_the_tokenizers():
    rng = random.Random(3)
    parts = ["a", "B", "é", "ß", " ", "  ", "\n", "\n\n", "\t", ".", ",", "'s", "'LL", "1", "23", " ", "　",
             "\x85", "😀", "<|endoftext|>", "<|", "日本", "ñ", "!", "?", ":", "\r\n", "\x0b", "-", "(", "́", "It's.",
             " \n", "\n ", "\xa0", "\x00"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(5000)] + [None, ""]
    ids, begins = tokens.byte_level_ids(pa.array(texts, pa.string()), tokens.PieceIds(PATH))
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [e[:-1] for e in encoded(texts)]


def test_forgotten_pieces_are_learnt_again(monkeypatch):
    monkeypatch.setattr(tokens, "PIECES_KEPT", 40)
    rng, pieces = random.Random(4), tokens.PieceIds(PATH)
    for _ in range(5):
        texts = [prose(rng, 20) for _ in range(20)]
        ids, begins = tokens.byte_level_ids(pa.array(texts), pieces)
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [e[:-1] for e in encoded(texts)]


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_hold_every_id(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    planes = to_planes(ids, kind)
    assert len(planes) == token_planes.PLANES[kind]
    assert (from_planes(planes, n, kind) == ids).all()
    small = from_planes([None if not p.strip(b"\0") else p for p in to_planes(ids >> 20, kind)], n, kind)
    assert (small == ids >> 20).all()


def expected(rows):
    ids = encoded([t for _, t in rows])
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    out, start = [], 0
    for i in order:
        out.append((rows[i][0], start, ids[i]))
        start += len(ids[i])
    return out


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_round_trip(spark, monkeypatch, kind):
    monkeypatch.setattr(token_planes, "CHUNKS_A_TASK", 2)
    rng = random.Random(8)
    rows = [r for r in awkward(rng) if r[0] not in (7, None)] + [(i, prose(rng, i % 50)) for i in range(20, 300)]
    rows += [(None, "one"), (-5, "two three")]
    rng.shuffle(rows)
    files = write_tokens(documents(spark, rows), new_folder(spark, "tokens"), PATH, chunk_ids=500, planes=kind)
    got = sorted(read_tokens(files, with_ids=True).collect(), key=lambda r: r.start)
    want = expected(rows)
    # Rows that repeat an id stand in any order among themselves.
    assert [r.doc_id for r in got] == [d for d, _, _ in want]
    assert sorted((r.doc_id or 0, r.ids) for r in got) == sorted((d or 0, ids) for d, _, ids in want)
    starts = np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]])
    assert [r.start for r in got] == starts.tolist()
    for r in got:
        assert r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())


def test_a_hot_id_is_dealt_over_files(spark):
    rows = [(7, f"text {i}") for i in range(3000)] + [(i, "x") for i in range(100)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = write_tokens(documents(spark, rows), new_folder(spark, "tokens"), PATH)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert files.count() > 1 and files.selectExpr("max(documents)").first()[0] < 2000
    got = sorted(read_tokens(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted(d for d, _ in rows)


def test_empty_table(spark):
    assert token_round_trip(spark, documents(spark, []), PATH).collect() == []


def test_damage_is_noticed(spark, tmp_path):
    folder = f"file://{tmp_path}/files"
    files = write_tokens(documents(spark, [(1, "one two three " * 50)]), folder, PATH)
    path = next((tmp_path / "files").iterdir())
    whole = path.read_bytes()
    for damaged in (whole[:20] + bytes([whole[20] ^ 1]) + whole[21:], whole[:-3]):
        path.write_bytes(damaged)
        with pytest.raises(Exception, match="damaged|cut off"):
            read_tokens(files).collect()
