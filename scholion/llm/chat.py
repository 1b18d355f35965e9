"""Chat formatting by event-sourced reconstruction, in DataFrame functions.

A log holds events of conversations: a message is opened, grows by streamed deltas, is edited,
regenerated or deleted. Events are dealt by conversation and message, sorted by sequence and
folded into the message's final text; a conversation's messages are then sorted and rendered.

Turns are marked by control strings, which texts cannot contain: a backslash goes after the
first character of anything that could begin one, and before each backslash, so taking one
backslash away gives the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END = "<|im_start|>", "<|im_end|>"
REPLY = "assistant"

OPEN, DELTA, EDIT, REGENERATE, DELETE = "open", "delta", "edit", "regenerate", "delete"

#: What may begin a control string of this or another common template: <| << <s> </s> [INST] [/INST]
CONTROL = r"<(?=[|<]|/?s>)|\[(?=/?INST)"


def escaped(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, message_id, seq, kind, role, text) -> one row per message that is left:
    conv_id, at (seq of its first event), role, text.

    The fold takes the text from the last event that sets it anew (open, edit, regenerate) and
    adds the deltas after it. The role is that of the last event that gives one. A message whose
    last state is deleted is gone; a later edit or regeneration brings it back. Unknown kinds
    count as deltas, null texts as empty. Events of one seq are taken in the order open, edit,
    regenerate, deltas by text, delete, so repeated events do not change a result but for deltas.
    """
    rank = (
        F.when(F.col("kind") == OPEN, 0)
        .when(F.col("kind") == EDIT, 1)
        .when(F.col("kind") == REGENERATE, 2)
        .when(F.col("kind") == DELETE, 4)
        .otherwise(3)
    )
    state = F.struct(F.col("seq"), rank.alias("rank"), F.coalesce("text", F.lit("")).alias("text"), F.col("role"))
    folded = events.groupBy("conv_id", "message_id").agg(F.sort_array(F.collect_list(state)).alias("log"))
    starts = F.array_max(F.expr("transform(log, (e, i) -> if(e.rank in (0, 1, 2, 4), i, 0))"))
    return (
        folded.withColumn("from", starts)
        .where(F.expr("log[from].rank <> 4"))
        .select(
            "conv_id",
            F.expr("log[0].seq").alias("at"),
            F.expr("try_element_at(filter(transform(log, e -> e.role), r -> r is not null), -1)").alias("role"),
            F.expr("array_join(transform(slice(log, from + 1, size(log)), e -> e.text), '')").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """Messages -> one row per conversation: conv_id, formatted, loss_spans (start, end in code
    points of each reply's text in `formatted`).

    A conversation is one value of the output, so its messages meet in one row; its events did
    not. Null roles are empty, messages of one place are sorted by role and text.
    """
    role = F.regexp_replace(escaped(F.coalesce("role", F.lit(""))), r"\n", r"\\" + "\n")
    turn = F.struct(
        F.col("at"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.lit(TURN), role, F.lit("\n")).alias("head"),
        escaped(F.coalesce("text", F.lit(""))).alias("body"),
    )
    gathered = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    tail = f"{END}\n"
    spans = f"""aggregate(turns, struct(0L as pos, cast(array() as array<struct<start:bigint, end:bigint>>) as spans),
        (s, t) -> struct(
            s.pos + length(t.head) + length(t.body) + {len(tail)}L as pos,
            if(t.role = '{REPLY}', array_append(s.spans, struct(s.pos + length(t.head) as start, s.pos + length(t.head) + length(t.body) as end)), s.spans) as spans),
        s -> s.spans)"""
    return gathered.select(
        "conv_id",
        F.concat(F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"])), tail), F.lit(tail)).alias("formatted"),
        F.expr(spans).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans -> the turns (role, text) and the text under the loss mask,
    both taken from the formatted string alone."""
    # possessive, as a repeated alternation makes the regular expression engine recur
    turn = r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)<\|im_end\|>\n$"
    segments = F.split("formatted", r"<\|im_start\|>", -1)
    parts = F.slice(segments, 2, F.size(segments))
    turns = F.transform(
        parts,
        lambda p: F.struct(unescaped(F.regexp_extract(p, turn, 1)).alias("role"), unescaped(F.regexp_extract(p, turn, 2)).alias("text")),
    )
    masked = F.expr("transform(loss_spans, s -> substring(formatted, cast(s.start + 1 as int), cast(s.end - s.start as int)))")
    return formatted.select(
        "conv_id", "formatted", turns.alias("turns"), F.array_join(F.transform(masked, unescaped), "").alias("loss_text")
    )


def format_chats(events: DataFrame) -> DataFrame:
    """An event log -> one formatted string per conversation with the spans of its replies.

    Null conv_ids are one conversation. An empty log gives no rows; extra columns are ignored.
    """
    return render(fold_events(events))


def rows_as_events(rows: DataFrame, pieces: int = 2) -> DataFrame:
    """A table with one row per turn as the log that its chat would have left: turns by others are
    opened whole, replies are opened empty and streamed in pieces. Rows of one turn are messages
    of their own, by role and text; repeated rows are kept."""
    row = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("message_id"),
    )
    size = F.ceil(F.length("text") / F.lit(pieces)).cast("int")
    piece = [
        F.struct(
            F.lit(i + 1).alias("step"),
            F.lit(DELTA).alias("kind"),
            F.lit(None).cast("string").alias("role"),
            F.col("text").substr(F.lit(i) * size + 1, size).alias("text"),
        )
        for i in range(pieces)
    ]
    opened = F.struct(
        F.lit(0).alias("step"),
        F.lit(OPEN).alias("kind"),
        F.col("role"),
        F.when(F.col("role") == REPLY, F.lit("")).otherwise(F.col("text")).alias("text"),
    )
    log = F.when(F.col("role") == REPLY, F.array(opened, *piece)).otherwise(F.array(opened))
    return row.withColumn("e", F.explode(log)).select(
        "conv_id",
        "message_id",
        F.struct(F.col("turn"), F.col("e.step").alias("step")).alias("seq"),
        "e.kind",
        "e.role",
        "e.text",
    )
