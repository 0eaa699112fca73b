"""Chat formatting in native expressions.

A conversation's turns are collected, sorted by (turn, role, text) and written as

    <|im_start|>role \\n text [<|im_next|> text ...] <|im_end|> \\n

Adjacent turns of one role share a message; ``<|im_next|>`` stands between their texts, so the turns can be read back.
Control strings inside roles and texts are escaped reversibly: ``%`` becomes ``%25``, ``<|`` becomes ``<%7C`` and, in
roles, a line feed becomes ``%0A``; so the output holds ``<|`` only where the template put it. The output is a list of
segments, each with a loss flag (true for the texts of the trained role), whose concatenation is the formatted string.

One row per conversation is the result, so a conversation must fit in a row; its turns are collected in one list, each
turn is looked at with its neighbours, and nothing is appended to a growing array.

Rows: null roles and texts count as empty; null conversation ids form one conversation, null turns come first; rows
equal in all columns are all kept; an empty table gives no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("%"), F.lit("%25")), F.lit("<|"), F.lit("<%7C"))


def unescaped(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("%0A"), F.lit("\n")), F.lit("<%7C"), F.lit("<|"))
    return F.replace(plain, F.lit("%25"), F.lit("%"))


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    trained: str = TRAINED,
) -> DataFrame:
    """conv_id, formatted, segments (array of (piece, loss)): one row per conversation."""
    held = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = held.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(turn: Column, i: Column) -> Column:
        role_at = lambda k: F.get(F.col("turns"), k)["role"]
        joins = (i > 0) & (role_at(i - 1) == turn["role"])
        goes_on = F.coalesce(role_at(i + 1) == turn["role"], F.lit(False))
        role = F.replace(escaped(turn["role"]), F.lit("\n"), F.lit("%0A"))
        before = F.when(joins, F.lit(NEXT)).otherwise(F.concat(F.lit(START), role, F.lit("\n")))
        after = F.when(goes_on, F.lit("")).otherwise(F.lit(END))
        part = lambda piece, loss: F.struct(piece.alias("piece"), loss.alias("loss"))
        return F.array(
            part(before, F.lit(False)),
            part(escaped(turn["text"]), turn["role"] == F.lit(trained)),
            part(after, F.lit(False)),
        )

    made = sorted_turns.select("conv_id", F.flatten(F.transform("turns", segments)).alias("segments"))
    return made.select(
        "conv_id",
        F.array_join(F.transform("segments", lambda s: s["piece"]), "").alias("formatted"),
        "segments",
    )


def read_turns(formatted: Column) -> Column:
    """The turns, as an array of (role, text), that a formatted string holds."""
    messages = F.filter(
        F.split(formatted, r"<\|im_end\|>\n", -1), lambda m: F.startswith(m, F.lit(START))
    )

    def of_message(message: Column) -> Column:
        body = F.substring(message, F.lit(len(START) + 1), F.length(message))
        first = F.instr(body, "\n")
        role = unescaped(F.substring(body, F.lit(1), first - 1))
        texts = F.split(F.substring(body, first + 1, F.length(body)), r"<\|im_next\|>", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(messages, of_message))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["piece"])), "")
