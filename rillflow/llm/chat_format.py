"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted by ``(turn, role, text)``, adjacent
turns of one role are merged into one message, and the messages are concatenated:

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n ...

``<|im_sep|>`` keeps the border between merged turns, so the output can be read back turn by turn.
In texts every ``<|`` gets another bar (``<||``): no control string can occur inside a text, and
taking the bar away again restores it.  A line feed in a role is written ``<|nl|>``.

``loss_spans`` holds ``(start, length)`` in code points of each assistant text.

Null text counts as empty, null role as the empty role, null turns come first; repeated rows stay,
as many times as they occur; a null conv_id is one conversation.  Extra columns are left out.  One
conversation is one output row, so the turns of one conversation do meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END, LINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(LINE), F.lit("\n")))


def format_chats(
    turns: DataFrame, trained_role: str = "assistant", conv: str = "conv_id"
) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans, n_messages``."""
    row = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    sorted_turns = turns.groupBy(F.col(conv).alias("conv_id")).agg(
        F.sort_array(F.collect_list(row)).alias("_turns")
    )
    all_turns, n = F.col("_turns"), F.size("_turns")
    first = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda i: (i == 0) | (F.get(all_turns, i)["role"] != F.get(all_turns, i - 1)["role"]),
    )
    bounds = F.concat("_first", F.array(n))
    at = F.col("_bounds")
    # Adjacent turns of one role, as one message each.
    merged = F.transform(
        F.sequence(F.lit(0), F.size(at) - 2),
        lambda i: F.struct(
            F.get(all_turns, F.get(at, i))["role"].alias("role"),
            F.transform(
                F.slice(all_turns, F.get(at, i) + 1, F.get(at, i + 1) - F.get(at, i)),
                lambda t: escape(t["text"]),
            ).alias("texts"),
        ),
    )
    written = F.transform(
        "_messages",
        lambda m: F.concat(
            F.lit(START), escape_role(m["role"]), F.lit("\n"),
            F.array_join(m["texts"], SEP), F.lit(f"{END}\n"),
        ),
    )
    # Spans by running lengths: one step for each message, and one for each text of it.
    empty = F.array().cast("array<struct<start:int,length:int>>")
    spans = F.aggregate(
        F.arrays_zip("_messages", "_written"),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,length:int>>>").alias("parts")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["_written"])).alias("at"),
            F.when(
                x["_messages"]["role"] == trained_role,
                F.concat(
                    acc["parts"],
                    F.array(
                        F.aggregate(
                            x["_messages"]["texts"],
                            F.struct(
                                (acc["at"] + len(START) + F.length(escape_role(x["_messages"]["role"])) + 1).alias("at"),
                                empty.alias("spans"),
                            ),
                            lambda a, t: F.struct(
                                (a["at"] + F.length(t) + len(SEP)).alias("at"),
                                F.concat(
                                    a["spans"],
                                    F.array(F.struct(a["at"].alias("start"), F.length(t).alias("length"))),
                                ).alias("spans"),
                            ),
                            lambda a: a["spans"],
                        )
                    ),
                ),
            )
            .otherwise(acc["parts"])
            .alias("parts"),
        ),
        lambda acc: F.flatten(acc["parts"]),
    )
    return (
        sorted_turns.withColumn("_first", first)
        .withColumn("_bounds", bounds)
        .withColumn("_messages", merged)
        .withColumn("_written", written)
        .select(
            "conv_id",
            F.array_join("_written", "").alias("formatted"),
            spans.alias("loss_spans"),
            F.size("_messages").alias("n_messages"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """Array of ``(role, text)`` of the single turns, from a formatted conversation."""
    # what stands before the first mark is empty; an empty conversation has no other
    messages = F.transform(
        F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda m: m != ""),
        lambda m: F.struct(
            unescape_role(F.substring_index(m, "\n", 1)).alias("role"),
            # what follows the role's line, without the closing mark and line feed
            F.substring(
                m,
                F.length(F.substring_index(m, "\n", 1)) + 2,
                F.length(m) - F.length(F.substring_index(m, "\n", 1)) - 2 - len(END),
            ).alias("body"),
        ),
    )
    return F.flatten(
        F.transform(
            messages,
            lambda m: F.transform(
                F.split(m["body"], r"<\|im_sep\|>", -1),
                lambda t: F.struct(m["role"].alias("role"), unescape(t).alias("text")),
            ),
        )
    )


def loss_texts(formatted: Column, spans: Column) -> Column:
    """Array of the unescaped texts under the mask."""
    return F.transform(
        spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))
    )
