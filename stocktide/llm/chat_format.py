"""Chats rebuilt from event logs and rendered as one text each, in DataFrame expressions.

An event belongs to a message of a conversation. `message` and `edit` set its text, `regenerate` begins it
anew, and `delta` adds to it; an edit or regeneration also undoes what later messages said before it. The
events of a message are folded first, so that a long stream is one row before a conversation is put together.

A turn is rendered as `<s>` role `[INST]` text then `</s>`. Control strings inside a role or text get a backslash
behind their first character, and a backslash is doubled, so that taking away one backslash before any
character gives back what was said.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, MIDDLE, END = "<s>", "[INST]", "</s>"
_CONTROL = r"<(?=/?s>|</?SYS>>)|\[(?=/?INST\])"
LOSS_ROLE = "assistant"
MESSAGE, EDIT, REGENERATE, DELTA = "message", "edit", "regenerate", "delta"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"({_CONTROL})", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def messages(events: DataFrame) -> DataFrame:
    """(conv_id, message, role, text) after all of `events` (conv_id, message, seq, kind, role, text).

    Events apply in order of `seq`; equal ones in order of kind, role and text, so that the result never
    depends on the order of rows. The role is that of the last event that names one. A null text adds
    nothing, a null seq comes first, a null or unknown kind counts as `message`; nulls of conv_id and of message
    are a conversation and a message of their own. A message that was undone and not said again is
    left out. Repeated `message` and `edit` events change nothing, a repeated delta is said twice.
    """
    kind = F.when(F.col("kind").isin(EDIT, REGENERATE, DELTA), F.col("kind")).otherwise(F.lit(MESSAGE))
    event = F.struct(
        F.coalesce(F.col("seq").cast("bigint"), F.lit(-(1 << 63))).alias("seq"), kind.alias("kind"),
        F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = events.select("conv_id", "message", event.alias("event"))
    again = F.when(F.col("event.kind").isin(EDIT, REGENERATE), F.col("event.seq"))
    by_message = rows.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_list("event")).alias("events"), F.max(again).alias("again")
    )
    earlier = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    undone = by_message.withColumn("undone", F.max("again").over(earlier))
    left = undone.withColumn(
        "events", F.filter("events", lambda e: F.col("undone").isNull() | (e["seq"] > F.col("undone")))
    ).where(F.size("events") > 0)
    # Only what follows the last event that sets the text is put together.
    resets = F.transform("events", lambda e, i: F.when(e["kind"] != DELTA, i))
    start = F.coalesce(F.array_max(resets), F.lit(0))
    parts = F.slice("events", start + 1, F.size("events"))
    roles = F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull())
    return left.select(
        "conv_id", "message", F.try_element_at(roles, F.lit(-1)).alias("role"),
        F.array_join(F.transform(parts, lambda e: e["text"]), "").alias("text"),
    )


def rendered(chat: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of `chat` (conv_id, message, role, text).

    `loss_spans` are the places of the assistant's texts in `formatted`: array<struct<start, length>> in code
    points. A null role or text is rendered as an empty one. Messages come in order of `message`, then
    role and text.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    head = F.concat(F.lit(BEGIN), escaped(role), F.lit(MIDDLE))
    body = escaped(F.coalesce(F.col("text"), F.lit("")))
    turn = F.struct(
        F.col("message"), role.alias("role"), head.alias("head"), body.alias("body"),
        F.length(head).alias("before"), F.length(body).alias("said"),
    )
    turns = chat.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    formatted = F.array_join(
        F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), ""
    )
    spans = F.expr(f"""
        aggregate(turns,
            named_struct('at', 0, 'out', cast(array() as array<struct<start: int, length: int>>)),
            (x, t) -> named_struct(
                'at', x.at + t.before + t.said + {len(END)},
                'out', if(t.role = '{LOSS_ROLE}',
                          concat(x.out, array(named_struct('start', x.at + t.before, 'length', t.said))), x.out)))
        .out
    """)  # fmt: skip
    return turns.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def parsed(formatted: Column) -> Column:
    """The turns of a rendered conversation: array<struct<role, text>>."""
    turns = F.split(formatted, END, -1)
    whole = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def turn(t: Column) -> Column:
        middle = F.instr(t, F.lit(MIDDLE))
        role = F.substring(t, F.lit(len(BEGIN) + 1), middle - 1 - len(BEGIN))
        text = F.substring(t, middle + len(MIDDLE), F.length(t))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(whole, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """What the assistant said, in order with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["length"]))), ""
    )
