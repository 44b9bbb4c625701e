import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from frames import awkward, documents, prose
from tokenizers import Tokenizer

from stocktide.llm.packing import END_ID, WordTokens, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers_own(tokenizer):
    rng = random.Random(4)
    alphabet = "aAbZ É,.!'stredvm \n\t  İıſß<|>endoftext0129ǅ́ͅ中文🙂ΣςKÅ"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += [None, "", "<|endoftext|>A<|startoftext|> B", "it's it'S I'LL,'s x!'re", "A<|ENDOFTEXT|>b"]
    ids, begins = WordTokens(PATH)(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


def check(rows, pieces, tokenizer, tokens, segments, loss):
    by_sequence, by_text = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append(p)
        by_text[p.doc_id].append(p)
    for held in by_sequence.values():
        held.sort(key=lambda p: p.offset)
        at = 0
        for p in held:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == tokens or at & (at - 1) == 0
        assert len(held) <= segments and sum(p.loss_tokens for p in held) <= loss
    whole = defaultdict(int)
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID]
        whole[doc] += len(ids)
    assert {d: sum(p.length for p in ps) for d, ps in by_text.items()} == dict(whole)
    for doc, text in rows:
        if doc is None or doc in (6, 7):
            continue
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID], dtype="<u4")
        at = 0
        for p in sorted(by_text[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length


@pytest.mark.parametrize("limits", [(2048, 64, 2048), (256, 3, 100)])
def test_every_id_is_placed_once(spark, tokenizer, limits):
    rng = random.Random(5)
    rows = awkward(rng) + [(100 + i, prose(rng, rng.randrange(300))) for i in range(400)]
    pieces = pack(documents(spark, rows).repartition(3), PATH, *limits, with_ids=True).collect()
    check(rows, pieces, tokenizer, *limits)
    assert sum(len(p.ids) for p in pieces) == sum(p.length for p in pieces)


def test_prompts_bear_no_loss(spark, tokenizer):
    rows = [(1, "ask ask ask tell tell", "ask ask ask"), (2, "only told", None), (3, "", "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, prompt string")
    pieces = pack(frame.coalesce(1), PATH, prompt="prompt").collect()
    lost = defaultdict(int)
    for p in pieces:
        lost[p.doc_id] += p.loss_tokens
    told = [len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for t in (" tell tell", "only told", "")]
    assert [lost[1], lost[2], lost[3]] == told


def test_empty_table(spark):
    assert pack(documents(spark, []), PATH).collect() == []
