"""Relational chat formatting.

The turns of a conversation are collected as structs, sorted, and written out as one string; adjacent
turns of one role share a block. The output also comes as segments, each with its place in the loss
mask: the texts of assistant turns are trained on, the marks and all other texts are not.

The marks all begin with ``<``. Inside roles and texts the characters ``\\ < [`` and, in roles, the
line break are written as a backslash and a letter, so that no control string, of this template or of
another (``</s>``, ``[INST]``), survives in a text, and unescaping gives every text back.

Defined cases: a null text or role is empty; turns sort by turn, role and text with nulls first, and
repeated rows stay; rows with a null conversation id form one conversation; an empty table gives an
empty table. A conversation is one string and so has to fit into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import let

OPEN, HEAD_END, NEXT, CLOSE = "<|im_start|>", "\n", "<|im_next|>", "<|im_end|>\n"
TRAINED = "assistant"

# Fixed values of the template: what is escaped, in the order in which it is escaped.
ESCAPES = [("\\", "\\s"), ("<", "\\l"), ("[", "\\b")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "\\n")]


def escape(text: Column, pairs=ESCAPES) -> Column:
    for plain, mark in pairs:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column, pairs=ESCAPES) -> Column:
    """Every backslash in an escaped text starts a pair, so undoing the pairs in turn is exact."""
    for plain, mark in reversed(pairs):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, segments (array of text, in_loss) from rows of conv_id, turn, role, text.

    ``formatted`` is the concatenation of the segments.
    """
    blank = F.lit("")
    collected = (
        turns.select(
            "conv_id",
            F.struct("turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text")).alias("t"),
        )
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("turns"))
    )

    def pieces(ts: Column) -> Column:
        def one(t: Column, i: Column) -> Column:
            role_at = lambda j: F.get(ts, j)["role"]
            first = ~F.coalesce(role_at(i - 1) == t["role"], F.lit(False))
            more = F.coalesce(role_at(i + 1) == t["role"], F.lit(False))
            segment = lambda text, loss: F.struct(text.alias("text"), loss.alias("in_loss"))
            head = F.when(first, F.concat(F.lit(OPEN), escape(t["role"], ROLE_ESCAPES), F.lit(HEAD_END))).otherwise(blank)
            return F.array(
                segment(head, F.lit(False)),
                segment(escape(t["text"]), t["role"] == TRAINED),
                segment(F.when(more, F.lit(NEXT)).otherwise(F.lit(CLOSE)), F.lit(False)),
            )

        return F.flatten(F.transform(ts, one))

    return (
        collected.select("conv_id", let(F.col("turns"), pieces).alias("segments"))
        .select("conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments")
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text), the turns of a formatted conversation."""
    marks = lambda s: "".join(f"\\{c}" if not c.isalnum() and c != "_" and c != "\n" else c for c in s)

    def turns(block: Column) -> Column:
        role = unescape(F.substring_index(block, HEAD_END, 1), ROLE_ESCAPES)
        texts = let(
            F.instr(block, HEAD_END),
            lambda at: F.split(F.substr(block, at + 1, F.length(block) - at - len(CLOSE)), marks(NEXT)),
        )
        return let(role, lambda r: F.transform(texts, lambda x: F.struct(r.alias("role"), unescape(x).alias("text"))))

    blocks = F.filter(F.split(formatted, marks(OPEN)), lambda b: b != "")
    return F.flatten(F.transform(blocks, turns))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests read from the formatted conversations alone."""
    loss = lambda s: F.array_join(F.transform(F.filter(s, lambda x: x["in_loss"]), lambda x: unescape(x["text"])), "")
    turns_text = lambda ts: F.array_join(F.transform(ts, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = let(read_back(F.col("formatted")), lambda ts: F.struct(F.size(ts).alias("n"), F.sha2(turns_text(ts), 256).alias("h")))
    lost = let(loss(F.col("segments")), lambda t: F.struct(F.length(t).alias("n"), F.sha2(t, 256).alias("h")))
    return formatted.select("conv_id", read.alias("r"), lost.alias("l"), F.length("formatted").alias("chars")).select(
        "conv_id",
        F.col("r.n").cast("long").alias("n_turns"), F.col("r.h").alias("turns_sha256"),
        F.col("l.n").cast("long").alias("loss_chars"), F.col("l.h").alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )
