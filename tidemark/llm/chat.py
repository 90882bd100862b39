"""Chat formatting as relational expressions: no user functions anywhere.

Turns of a conversation are collected and sorted as structs; adjacent turns of one
role become one block. A block is `<|im_start|>role\\n`, its texts with `<|im_sep|>`
between them, and `<|im_end|>\\n`. Inside texts every `<`, backslashes and `|` in a row
get one more backslash, so that no control string occurs there, and lose it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import let

START, SEP, STOP, NEW_LINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _quoted(mark: str) -> str:
    return r"\Q" + mark + r"\E"


def format_chats(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    trained: str = TRAINED,
) -> DataFrame:
    """One row per conversation: its id, `formatted` and `loss_mask`.

    The mask lists runs of characters (code points) of `formatted`: for every turn what
    stands before its text, the text, and what stands after it, with `train` true for
    texts of the trained role. Rows sort by turn, then role, then text, nulls first;
    repeated rows stay repeated. Null text and null role are empty. Rows with a null
    conversation id are one conversation. An empty table gives no rows.

    A conversation is one row of the result, so its turns meet in one task.
    """
    row = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def runs(rows: Column) -> Column:
        last = F.size(rows) - 1

        def one(t: Column, i: Column) -> Column:
            opens = (i == 0) | (F.get(rows, i - 1)["role"] != t["role"])
            closes = (i == last) | (F.get(rows, i + 1)["role"] != t["role"])
            named = F.regexp_replace(escape(t["role"]), "\n", NEW_LINE.replace("$", r"\$"))
            return F.struct(
                F.when(opens, F.concat(F.lit(START), named, F.lit("\n"))).otherwise("").alias("before"),
                escape(t["text"]).alias("body"),
                F.when(closes, F.lit(STOP + "\n")).otherwise(F.lit(SEP)).alias("after"),
                (t["role"] == trained).alias("train"),
            )

        return F.transform(rows, one)

    def mask(pieces: Column) -> Column:
        def three(p: Column) -> Column:
            return F.array(
                F.struct(F.length(p["before"]).alias("chars"), F.lit(False).alias("train")),
                F.struct(F.length(p["body"]).alias("chars"), p["train"].alias("train")),
                F.struct(F.length(p["after"]).alias("chars"), F.lit(False).alias("train")),
            )

        return F.flatten(F.transform(pieces, three))

    def whole(pieces: Column) -> Column:
        return F.array_join(F.transform(pieces, lambda p: F.concat(p["before"], p["body"], p["after"])), "")

    return (
        turns.groupBy(F.col(conv_id).alias("conv_id"))
        .agg(F.sort_array(F.collect_list(row)).alias("_rows"))
        .select("conv_id", let(F.col("_rows"), runs).alias("_pieces"))
        .select(
            "conv_id", whole(F.col("_pieces")).alias("formatted"), mask(F.col("_pieces")).alias("loss_mask")
        )
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """Add `turns` (role, text) and `loss_text`, read from `formatted` and `loss_mask`."""

    def block(b: Column) -> Column:
        role = F.substring_index(b, "\n", 1)
        name = unescape(F.regexp_replace(role, _quoted(NEW_LINE), "\n"))
        body = F.split(b.substr(F.length(role) + 2, F.length(b)), _quoted(SEP))
        return F.transform(body, lambda t: F.struct(name.alias("role"), t.alias("raw")))

    # The text before the first start is empty, and each block ends with its stop mark.
    blocks = F.transform(
        F.filter(F.split("formatted", _quoted(START)), lambda b: b != ""),
        lambda b: b.substr(F.lit(1), F.length(b) - len(STOP) - 1),
    )

    def trained(raws: Column, mask: Column) -> Column:
        return F.transform(
            raws,
            lambda t, i: F.when(
                F.get(mask, 3 * i + 1)["train"],
                unescape(t["raw"].substr(F.lit(1), F.get(mask, 3 * i + 1)["chars"])),
            ).otherwise(""),
        )

    return (
        chats.withColumn("_turns", F.flatten(F.transform(blocks, block)))
        .withColumn("loss_text", F.array_join(trained(F.col("_turns"), F.col("loss_mask")), ""))
        .withColumn(
            "turns",
            F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), unescape(t["raw"]).alias("text"))),
        )
        .drop("_turns")
    )
