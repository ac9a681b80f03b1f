r"""Chat formatting by prefix-target expansion.

A conversation is formatted once for each assistant turn: the example holds all turns up to
that one, and only its reply is trainable. Turns behind the last reply give one more example
without a target, so that nothing of the conversation is lost. A turn is written as

    <|im_start|>role<|im_sep|>text<|im_end|>

In roles and texts, the first character of a control string is followed by a backslash, and
a backslash by another one, so no control string is left whole and the way back is exact.

The length of an example grows with its place, so a conversation's examples are together as
long as the square of its turns: that is what the expansion means. A conversation is put
together in one row, as its last example holds all of it anyway; the examples of different
rows are made by different tasks.

Defined results: a null text or role is empty. Turns are in order of turn (nulls first), then
role and text. Rows without conv_id that agree in all columns used are one conversation.
Repeated rows are repeated turns. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: A backslash, or the first character of a control string of common templates.
CONTROL = r"\\|<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"
TARGET = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(CONTROL), F.lit(r"$0\\"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"\\(\\?)"), F.lit("$1"))


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, conversation, turns): the turns in order. conversation tells apart what has no
    conv_id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    own = F.md5(F.to_json(F.struct("turn", "role", "text")))
    rows = turns.select(
        "conv_id",
        F.when(F.col("conv_id").isNull(), own).otherwise("").alias("conversation"),
        F.struct("turn", role.alias("role"), text.alias("text")).alias("t"),
    )
    return rows.groupBy("conv_id", "conversation").agg(
        F.sort_array(F.collect_list("t")).alias("turns")
    )


def _written(turn: Column) -> Column:
    return F.concat(
        F.lit(START), escaped(turn["role"]), F.lit(SEP), escaped(turn["text"]), F.lit(END)
    )


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, conversation, example, text, has_target, loss_start, loss_chars). The trainable
    part is loss_chars code points of text behind the first loss_start."""
    convs = conversations_of(turns).withColumn("written", F.transform("turns", _written))
    ends = F.array_compact(F.transform("turns", lambda t, k: F.when(t["role"] == TARGET, k + 1)))
    rest = F.when(F.element_at("turns", -1)["role"] != TARGET, F.array(F.size("turns")))
    rest = F.coalesce(rest, F.array().cast("array<int>"))
    last = F.element_at("turns", F.col("end"))
    loss = F.char_length(escaped(last["text"]))
    before = F.char_length("text") - F.lit(len(END)) - F.col("loss_chars")
    return (
        convs.withColumn("ends", F.concat(ends, rest))
        .select("*", F.posexplode_outer("ends").alias("example", "end"))
        .select(
            "conv_id",
            "conversation",
            "example",
            F.array_join(F.slice("written", F.lit(1), F.col("end")), "").alias("text"),
            (last["role"] == TARGET).alias("has_target"),
            F.when(last["role"] == TARGET, loss).otherwise(0).alias("loss_chars"),
        )
        .withColumn("loss_start", F.when(F.col("has_target"), before).otherwise(0))
    )


def turns_of(text: Column) -> Column:
    """The (role, text) of the turns of a formatted example."""
    parts = F.filter(F.split(text, F.lit(r"<\|im_end\|>"), -1), lambda x: x != "")

    def read(part: Column) -> Column:
        sides = F.split(F.substring(part, len(START) + 1, 2**31 - 1), F.lit(r"<\|im_sep\|>"), 2)
        return F.struct(
            unescaped(F.get(sides, 0)).alias("role"), unescaped(F.get(sides, 1)).alias("text")
        )

    return F.transform(parts, read)


def digests(formatted: DataFrame) -> DataFrame:
    """Read back from examples: per conversation its turns, what is trainable, and its length."""
    loss = F.expr("substring(text, loss_start + 1, loss_chars)")
    per_conv = (
        formatted.withColumn("loss", F.when(F.col("has_target"), unescaped(loss)).otherwise(""))
        .groupBy("conv_id", "conversation")
        .agg(
            F.max(F.struct("example", "text"))["text"].alias("whole"),
            F.array_join(
                F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), ""
            ).alias("loss"),
            F.sum(F.char_length("text").cast("long")).alias("formatted_chars"),
        )
        .withColumn("turns", turns_of(F.col("whole")))
    )
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return per_conv.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
