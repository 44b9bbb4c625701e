import random

from pyspark.sql import functions as F

from stocktide.llm.chat_format import escaped, loss_text, messages, parsed, rendered, unescaped

SCHEMA = "conv_id bigint, message bigint, seq bigint, kind string, role string, text string"


def said(spark, events):
    frame = spark.createDataFrame(events, SCHEMA).withColumn("events", F.lit("x")).withColumn("turns", F.lit(1))
    return sorted(map(tuple, messages(frame).collect()), key=str)


def test_folding(spark):
    events = [
        (1, 0, 0, "message", "user", "hello"),
        (1, 1, 1, "message", "assistant", ""), (1, 1, 2, "delta", None, "Hi"), (1, 1, 3, "delta", None, " there"),
        (1, 1, 4, "regenerate", "assistant", ""), (1, 1, 5, "delta", None, "Good"), (1, 1, 6, "delta", None, " day"),
        (2, 0, 0, "message", "user", "first"), (2, 1, 1, "message", "assistant", "old answer"),
        (2, 2, 2, "message", "user", "follow-up"), (2, 0, 3, "edit", "user", "second"),
        (2, 1, 4, "message", "assistant", "new answer"),
        (3, 0, None, None, None, None), (None, None, 1, "odd", "tool", "x"), (4, 0, 1, "delta", "assistant", "only"),
    ]
    want = [
        (1, 0, "user", "hello"), (1, 1, "assistant", "Good day"), (2, 0, "user", "second"),
        (2, 1, "assistant", "new answer"), (3, 0, None, ""), (None, None, "tool", "x"), (4, 0, "assistant", "only"),
    ]
    shuffled = random.Random(19).sample(events, len(events))
    assert said(spark, events) == said(spark, shuffled) == sorted(want, key=str)
    assert said(spark, []) == []


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rng = random.Random(20)
    parts = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "<", ">", "[", "]", "/", "a", "\n", "😀", "$1"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(3000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in frame.select("t", escaped(F.col("t")).alias("e"), unescaped(escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(c in r.e for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def test_reading_back(spark):
    rng = random.Random(21)
    parts = ["</s>", "[INST]", " ok ", "[/INST]", "\\", "é", "😀", "<s>", "\n"]
    make = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
    chats = {c: [(rng.choice(["user", "assistant", "sys</s>[INST]tem"]), make()) for _ in range(rng.randrange(1, 9))] for c in range(200)}
    chats[500] = [("assistant", "x" * 200_000), ("user", ""), ("assistant", "y")]
    rows = [(c, i, role, text) for c, turns in chats.items() for i, (role, text) in enumerate(turns)]
    frame = rendered(spark.createDataFrame(rows, "conv_id bigint, message bigint, role string, text string"))
    out = frame.select("conv_id", parsed(F.col("formatted")).alias("turns"),
                       loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(out) == len(chats)
    for r in out:
        assert [tuple(t) for t in r.turns] == chats[r.conv_id]
        assert r.loss == "".join(text for role, text in chats[r.conv_id] if role == "assistant")
