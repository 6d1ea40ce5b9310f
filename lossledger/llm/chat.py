"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged by array
aggregation into one message; the message strings are concatenated.

Template of a message: `<|im_start|>role\\n` text (`<|im_sep|>` text)* `<|im_end|>\\n`. Every control string
begins with `<|`. Inside role and text a backslash is doubled and `<|` becomes `<\\|`, so no text can hold a
control string and unescaping gives it back. A line feed in a role becomes a backslash and an n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
TURN = "struct<turn:bigint,role:string,text:string>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    """`\\n` is a line feed only where its backslash is not the second half of a doubled one."""
    halves = F.split(F.replace(role, F.lit("<\\|"), F.lit("<|")), r"\\\\", -1)  # the pattern of two backslashes
    return F.array_join(F.transform(halves, lambda h: F.replace(h, F.lit("\\n"), F.lit("\n"))), "\\")


def merge_turns(df: DataFrame) -> DataFrame:
    """conv_id, turns (in order) -> conv_id, messages: array<struct<role, texts>>, a message per run of one role.

    The positions where runs begin are a column of their own and each run is a slice, so the work stays linear.
    """
    n = F.size("turns")
    role_at = lambda i: F.get("turns", i)["role"]
    begins = F.filter(
        F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (role_at(i) != role_at(F.greatest(i - 1, F.lit(0))))
    )
    messages = F.transform(
        "begins",
        lambda s, k: F.struct(
            role_at(s).alias("role"),
            F.transform(
                F.slice("turns", s + 1, F.coalesce(F.get("begins", k + 1), n) - s), lambda t: t["text"]
            ).alias("texts"),
        ),
    )
    return df.withColumn("begins", begins).select("conv_id", messages.alias("messages"))


def message_parts(message: Column) -> Column:
    """Pieces of one message with their loss flag: only texts of the assistant are trained on."""
    assistant = message["role"] == "assistant"
    piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    texts = F.flatten(
        F.transform(
            message["texts"],
            lambda t, i: F.when(i == 0, F.array(piece(escape(t), assistant))).otherwise(
                F.array(piece(F.lit(SEPARATOR), F.lit(False)), piece(escape(t), assistant))
            ),
        )
    )
    head = F.concat(F.lit(START), escape_role(message["role"]), F.lit("\n"))
    return F.concat(
        F.array(piece(head, F.lit(False))), texts, F.array(piece(F.lit(END), F.lit(False)))
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, segments (array of text and loss flag; their texts
    joined are `formatted`).

    Turns are ordered by (turn, role, text), nulls first; a null role or text counts as empty; repeated rows
    are turns of their own. A null conv_id is a conversation like any other. Other columns are ignored. One
    conversation becomes one row, so it has to fit a row, as its formatted text does.
    """
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    gathered = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    segments = merge_turns(gathered).select("conv_id", F.flatten(F.transform("messages", message_parts)).alias("segments"))
    return segments.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments"
    )


def read_turns(formatted: Column) -> Column:
    """The inverse of the template: array<struct<role, text>>, one entry per turn."""
    blocks = F.filter(F.split(formatted, r"\Q" + END + r"\E", -1), lambda b: b != "")
    inside = F.transform(blocks, lambda b: F.substr(b, F.lit(len(START) + 1)))

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        texts = F.split(F.substr(block, F.char_length(role) + 2), r"\Q" + SEPARATOR + r"\E", -1)
        return F.transform(
            texts, lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(inside, turns))


def read_trained(formatted: Column) -> Column:
    """All text that is trained on, read back from the output alone: the assistant's texts in order."""
    kept = F.filter(read_turns(formatted), lambda t: t["role"] == "assistant")
    return F.array_join(F.transform(kept, lambda t: t["text"]), "")


def read_loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped piece by piece."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescape(s["text"])), "")
