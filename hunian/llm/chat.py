"""Chat formatting in Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role
are merged into a message; messages are concatenated:

    <s>role[INST]text<part>text[/INST]</s>

``<part>`` stands between the turns of a message, so that the turns can be read back. A control string inside a
role or a text gets a backslash after its first character, and one that has backslashes there
already gets one more; taking one away gives the text back. The loss mask is kept as segments: pieces
of the output in order, each with a flag that is true for the texts of the trained role.

Turns are ordered by ``turn``, on ties by role and text; null turns come first. Null roles and texts read as
empty; rows with a null conversation form one. An empty table gives no rows, a repeated row is a turn of its own. Extra
columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import let

BEGIN, HEAD, PART, FOOT, END = "<s>", "[INST]", "<part>", "[/INST]", "</s>"
# A control string's first character, backslashes and rest.
_OPEN = r"<(\\*+)(/?s>|part>)"
_SQUARE = r"\[(\\*+)(/?INST\])"


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, _OPEN, r"<\\$1$2")
    return F.regexp_replace(text, _SQUARE, r"[\\$1$2")


def unescape(text: Column) -> Column:
    text = F.regexp_replace(text, r"<\\(\\*)(/?s>|part>)", "<$1$2")
    return F.regexp_replace(text, r"\[\\(\\*)(/?INST\])", "[$1$2")


def conversations(turns: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, its sorted array of ``turn, role, text``."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def merged(turns: Column) -> Column:
    """Messages (``role``, ``texts``) of adjacent turns of one role."""
    starts = F.filter(F.sequence(F.lit(1), F.size(turns)), lambda i: (i == 1) | (
        F.get(turns, i - 1)["role"] != F.get(turns, i - 2)["role"]))
    return let(starts, lambda begins: F.transform(begins, lambda begin, i: let(
        F.slice(turns, begin, F.coalesce(F.get(begins, i + 1), F.size(turns) + 1) - begin),
        lambda run: F.struct(
            F.get(run, F.lit(0))["role"].alias("role"), F.transform(run, lambda t: t["text"]).alias("texts")))))


def segments(messages: Column, trained: str) -> Column:
    """Pieces of the output with their loss flags; joined they are the formatted conversation."""

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_message(m: Column) -> Column:
        texts = F.flatten(F.transform(m["texts"], lambda t, i: F.array(
            piece(F.when(i > 0, F.lit(PART)).otherwise(F.lit("")), F.lit(False)),
            piece(escape(t), m["role"] == trained))))
        return F.concat(
            F.array(piece(F.concat(F.lit(BEGIN), escape(m["role"]), F.lit(HEAD)), F.lit(False))), texts,
            F.array(piece(F.lit(FOOT + END), F.lit(False))))

    return F.flatten(F.transform(messages, of_message))


def format_chats(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``segments`` of each conversation."""
    made = conversations(turns).select("conv_id", segments(merged(F.col("turns")), trained).alias("segments"))
    return made.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns (``role``, ``text``) of a formatted conversation, in order."""
    messages = F.filter(F.split(formatted, END, -1), lambda m: m != "")

    def of_message(message: Column) -> Column:
        head = F.split(message, r"\[INST\]", 2)
        body = F.regexp_replace(F.get(head, F.lit(1)), r"\[/INST\]$", "")
        role = unescape(F.substr(F.get(head, F.lit(0)), F.lit(len(BEGIN) + 1)))
        return let(role, lambda r: F.transform(F.split(body, PART, -1), lambda t: F.struct(
            r.alias("role"), unescape(t).alias("text"))))

    return F.flatten(F.transform(messages, of_message))


def read_loss(pieces: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(pieces, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digest(turns: DataFrame, trained: str = "assistant") -> DataFrame:
    """Formats all conversations and reads the output back."""
    read = format_chats(turns, trained).select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars")
