"""Chat formatting by prefix-target expansion, in DataFrame functions only.

A turn is written as ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. Every
assistant turn becomes an example of its own: all turns before it as context,
and its text, the only trainable span, at the end.

Control strings inside roles and texts are escaped, so that a tokenizer finds
only those of the template: ``\\`` becomes ``\\e``, and the first character of a
control string becomes ``\\l`` (for ``<``) or ``\\b`` (for ``[``); a newline in a
role becomes ``\\n``. Every backslash of the output starts one of these four
pairs, so ``unescape`` restores the text exactly.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_START = "<|im_start|>"
TURN_END = "<|im_end|>"
#: The control strings that no escaped text holds.
CONTROLS = (TURN_START, TURN_END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: What stands for a character after a backslash.
STANDS_FOR = {"<": "l", "[": "b", "\n": "n", "\\": "e"}
TRAINED_ROLE = "assistant"


def escape(value: Column) -> Column:
    """The text without any control string; ``unescape`` gives it back."""
    value = F.replace(value, F.lit("\\"), F.lit("\\" + STANDS_FOR["\\"]))
    for first in sorted({c[0] for c in CONTROLS}):
        rest = "|".join(re.escape(c[1:]) for c in CONTROLS if c[0] == first)
        value = F.regexp_replace(value, f"{re.escape(first)}(?={rest})", "\\\\" + STANDS_FOR[first])
    return value


def escape_role(value: Column) -> Column:
    """As ``escape``; newlines too, because a newline ends the role."""
    return F.replace(escape(value), F.lit("\n"), F.lit("\\" + STANDS_FOR["\n"]))


def unescape(value: Column) -> Column:
    """The inverse of ``escape`` and ``escape_role``."""
    for char, letter in STANDS_FOR.items():  # the backslash comes last
        value = F.replace(value, F.lit("\\" + letter), F.lit(char))
    return value


def _turn_line(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN_START), escape_role(role), F.lit("\n"), escape(text), F.lit(TURN_END + "\n"))


def chat_examples(conversations: DataFrame) -> DataFrame:
    """One row per example: ``conv_id, example, is_last, text, loss_start, loss_chars``.

    ``text`` is the formatted conversation up to and including the example's
    reply; its code points ``loss_start`` (from 0) to ``loss_start + loss_chars``
    are trainable, all others are context. Examples are numbered from 0. Turns
    after the last reply (all turns, if there is none) come as one more example
    whose ``loss_start`` and ``loss_chars`` are null, so that the example with
    ``is_last`` always holds the whole conversation.

    Rows of a conversation are taken by turn, null turns first, those of one
    turn by their formatted text; repeated rows all count. A null role or text
    is empty. Rows with a null ``conv_id`` are one conversation. Other columns are
    ignored. An empty table gives no rows.

    One shuffle by ``conv_id``. Offsets are a running sum over the sorted rows;
    a conversation's formatted text is then one row (it is the context of its
    last example), from which the examples are cut while they are read, so
    nothing quadratic is shuffled, sorted or stored.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    lines = conversations.select(
        "conv_id",
        "turn",
        _turn_line(role, text).alias("line"),
        F.when(role == TRAINED_ROLE, F.char_length(escape(text)).cast("long")).alias("loss_chars"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "line")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lines.select(
        "conv_id",
        F.row_number().over(order).alias("pos"),
        "line",
        "loss_chars",
        F.sum(F.char_length("line").cast("long")).over(so_far).alias("end"),
    )
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("lines"),
        F.array_sort(F.collect_list(F.when(F.col("loss_chars").isNotNull(), F.struct("end", "loss_chars")))).alias(
            "replies"
        ),
        F.max("end").alias("end"),
    )
    rest = F.struct(F.col("end").alias("end"), F.lit(None).cast("long").alias("loss_chars"))
    done = F.coalesce(F.try_element_at("replies", F.lit(-1)).getField("end"), F.lit(-1).cast("long"))
    cut = whole.select(
        "conv_id",
        F.array_join(F.transform("lines", lambda t: t["line"]), "").alias("whole"),
        "end",
        F.when(done == F.col("end"), F.col("replies")).otherwise(F.concat("replies", F.array(rest))).alias("targets"),
    ).select("conv_id", "whole", F.col("end").alias("n_chars"), F.posexplode("targets").alias("example", "target"))
    end, loss_chars = F.col("target.end"), F.col("target.loss_chars")
    return cut.select(
        "conv_id",
        "example",
        (end == F.col("n_chars")).alias("is_last"),
        F.substring("whole", F.lit(1), end.cast("int")).alias("text"),
        (end - F.lit(len(TURN_END) + 1) - loss_chars).alias("loss_start"),
        loss_chars.alias("loss_chars"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of ``(role, text)``."""
    parts = F.split(text, re.escape(TURN_START))

    def turn(part: Column) -> Column:
        body = F.substring(part, F.lit(1), F.char_length(part) - F.lit(len(TURN_END) + 1))
        role = F.substring_index(body, "\n", 1)
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substring(body, F.char_length(role) + 2, F.char_length(body))).alias("text"),
        )

    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def read_loss(example: DataFrame) -> Column:
    """The unescaped text under an example's loss mask; null where nothing is trainable."""
    return unescape(
        F.substring(
            example["text"], (example["loss_start"] + 1).cast("int"), example["loss_chars"].cast("int")
        )
    )


def read_back(examples: DataFrame) -> DataFrame:
    """What a trainer sees of each conversation: ``conv_id, turns, losses, formatted_chars, n_examples``.

    ``turns`` are read from the last example, ``losses`` from each example's
    mask, in order; ``formatted_chars`` counts the code points of all examples.
    """
    seen = examples.select(
        "conv_id",
        F.when(F.col("is_last"), F.col("text")).alias("whole"),
        F.struct("example", read_loss(examples).alias("loss")).alias("loss"),
        F.char_length("text").cast("long").alias("n_chars"),
    )
    return seen.groupBy("conv_id").agg(
        read_turns(F.get(F.collect_list("whole"), F.lit(0))).alias("turns"),
        F.filter(
            F.transform(F.array_sort(F.collect_list("loss")), lambda x: x["loss"]), lambda x: x.isNotNull()
        ).alias("losses"),
        F.sum("n_chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    )
