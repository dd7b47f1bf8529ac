"""Chat formatting from event logs.

A log holds what happened to each message of a conversation, in sequence: it was opened with a
role, text was streamed to it in deltas, it was edited or generated anew, it was deleted. The log
is partitioned by conversation and message, sorted by sequence and folded into final messages,
which are rendered with a template whose control strings cannot be forged by a text. Everything
runs in Spark's own expressions.

Template, per turn: ``<|im_start|>`` role line feed text ``<|im_end|>`` line feed. Inside texts
and roles every ``<`` followed by any number of backslashes and ``|`` gets one more backslash;
in roles, ``%`` and line feeds are percent-encoded first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
OPEN, DELTA, EDIT, REGENERATE, DELETE = "open", "delta", "edit", "regenerate", "delete"
DELTA_CHARS = 400
BLOCK_TURNS = 256
"""Turns that are joined at once before a conversation's blocks are."""


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def message_events(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """The event log that stored turns stand for: each opened, then streamed in deltas.

    Takes conv_id, turn, role, text. Gives conv_id, message, seq, event, role, text, where
    message orders the turns: by turn, then role, then a hash of the text. Repeated rows are
    messages of their own. Null roles and texts are empty.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # The row number only tells equal rows apart, so it may differ from run to run.
    row = F.monotonically_increasing_id().alias("row")
    turns = turns.withColumn("message", F.struct("turn", "role", F.sha2("text", 256).alias("hash"), row))
    opened = F.struct(
        F.lit(0).alias("seq"), F.lit(OPEN).alias("event"), F.col("role").alias("role"), F.lit("").alias("text")
    )
    # One pass over the text, however long it is.
    cut = F.regexp_extract_all(F.col("text"), F.lit(f"(?s).{{1,{int(delta_chars)}}}"), F.lit(0))
    deltas = F.transform(
        cut,
        lambda text, number: F.struct(
            (number + 1).alias("seq"), F.lit(DELTA).alias("event"), F.col("role").alias("role"), text.alias("text")
        ),
    )
    return turns.select("conv_id", "message", F.inline(F.concat(F.array(opened), deltas)))


def final_messages(events: DataFrame) -> DataFrame:
    """Fold an event log (conv_id, message, seq, event, role, text) into final messages.

    An ``open`` names the role, a ``delta`` appends its text, an ``edit`` puts its text in place
    of all before, a ``regenerate`` takes all before away, a ``delete`` takes the message out
    for good. Events of one seq go by event, role and text. A message without ``open`` has an
    empty role; null texts, null seqs (which come first) and unknown events break nothing. Gives
    conv_id, message, role, text.
    """
    log = F.array_sort(F.collect_list(F.struct("seq", "event", "role", "text")))
    messages = events.groupBy("conv_id", "message").agg(log.alias("log"))
    # The fold finds where the text that counts begins, so that no text is copied per event.
    start = F.struct(
        F.lit(0).alias("number"), F.lit(1).alias("begin"), F.lit("").alias("role"), F.lit(False).alias("deleted")
    )

    def step(state: Column, event: Column) -> Column:
        number, kind = state["number"] + 1, F.coalesce(event["event"], F.lit(""))
        return F.struct(
            number.alias("number"),
            F.when(kind.isin(EDIT, REGENERATE), number).otherwise(state["begin"]).alias("begin"),
            F.when(kind == OPEN, F.coalesce(event["role"], F.lit(""))).otherwise(state["role"]).alias("role"),
            (state["deleted"] | (kind == DELETE)).alias("deleted"),
        )

    folded = messages.withColumn("state", F.aggregate("log", start, step)).filter("NOT state.deleted")
    counted = F.slice("log", F.col("state.begin"), F.col("state.number"))
    pieces = F.transform(
        F.filter(counted, lambda event: event["event"].isin(DELTA, EDIT)),
        lambda event: F.coalesce(event["text"], F.lit("")),
    )
    return folded.select("conv_id", "message", F.col("state.role").alias("role"), F.array_join(pieces, "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """One formatted text per conversation from its messages, in their order.

    ``message.turn`` deals a long conversation into blocks of turns, which are sorted and joined
    apart; only finished blocks meet. Gives conv_id, formatted.
    """
    turn = F.concat(
        F.lit(START), _escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END + "\n")
    )

    def joined(key: str) -> Column:
        ordered = F.array_sort(F.collect_list(F.struct(key, "formatted")))
        return F.array_join(F.transform(ordered, lambda x: x["formatted"]), "")

    turns = messages.select("conv_id", "message", F.floor(F.col("message.turn") / BLOCK_TURNS).alias("block"), turn.alias("formatted"))
    blocks = turns.groupBy("conv_id", "block").agg(joined("message").alias("formatted"))
    return blocks.groupBy("conv_id").agg(joined("block").alias("formatted"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda part, number: number > 0)
    tail = len(END) + 1

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        size = F.char_length(part) - F.char_length(role) - 1 - tail
        text = F.substring(part, F.char_length(role) + 2, size)
        return F.struct(_unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def format_chats(conversations: DataFrame) -> DataFrame:
    """Stored conversations as formatted texts: conv_id, formatted, one row per conversation.

    Takes conv_id, turn, role, text; other columns are ignored. Rows of one turn go by role and
    text hash; repeated rows are turns of their own. A null text or role is empty; a null turn
    comes first; rows without conv_id are one conversation. No rows give no rows.
    """
    return render(final_messages(message_events(conversations)))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What formatted texts say, read back from them.

    conv_id, n_turns, turns_sha256 (of role, line feed, text, line feed per turn), loss_chars and
    loss_sha256 (of the assistant texts, which the loss is taken over), formatted_chars.
    """
    read = formatted.withColumn("turns", parse(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    answers = F.filter("turns", lambda t: t["role"] == ASSISTANT)
    loss = F.array_join(F.transform(answers, lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
