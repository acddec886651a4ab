"""Chat formatting: one training string per conversation, with its loss mask.

Turns are collected as structs, sorted, split into runs of one role, and each run
becomes one block of the template::

    <|im_start|>ROLE\\nTEXT<|im_next|>TEXT<|im_end|>\\n

``<|im_next|>`` stands between the texts of adjacent same-role turns, so the
original turns can be read back.  Control strings inside a text (those above and
``<s>``, ``</s>``, ``[INST]``, ``[/INST]``, ``<|endoftext|>``) lose their first
character to an entity (``&lt;``, ``&lsqb;``), and an ampersand that would start
such an entity becomes ``&amp;``; undoing the three in that order gives the text
back exactly.  The string comes with its ``segments`` (pieces of the string in
order, each with a flag ``loss``): the assistant texts carry the loss, nothing else.

Defined cases: turns sort by (turn, role, text), nulls first, so ties and
repeated rows have one order and all stay; a null text or role is empty; a null
conversation id is a conversation of its own; line ends inside a role are escaped.
Extra columns are ignored.

Column expressions only.  One shuffle, on the conversation id.  A formatted
conversation is one string, so a conversation's turns meet in one row by nature:
the longest conversation has to fit in a task, as its string does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
_CONTROL = r"(?:<(?=\|im_start\|>|\|im_next\|>|\|im_end\|>|\|endoftext\|>|/?s>))"
_BRACKET = r"(?:\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    out = F.regexp_replace(text, "&(?=(?:amp|lt|lsqb|NewLine);)", "&amp;")
    return F.regexp_replace(F.regexp_replace(out, _CONTROL, "&lt;"), _BRACKET, "&lsqb;")


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&lsqb;"), F.lit("["))
    return F.replace(out, F.lit("&amp;"), F.lit("&"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&NewLine;"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&NewLine;"), F.lit("\n")))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``segments`` (array<struct<text, loss>>)."""
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    roles = sorted_.select("conv_id", "ts", F.col("ts.role").alias("roles"), F.col("ts.text").alias("texts"))
    # 1-based first turn of every run of one role, from each role beside the one before it
    runs = roles.withColumn("firsts", F.expr("""
        filter(transform(
            zip_with(roles, concat(array(cast(null as string)), slice(roles, 1, size(roles) - 1)),
                     (r, before) -> before is null or r <> before),
            (starts, i) -> if(starts, i + 1, 0)), i -> i > 0)"""))
    runs = runs.withColumn("blocks", F.expr("""
        zip_with(firsts, concat(slice(firsts, 2, size(firsts)), array(size(roles) + 1)),
                 (first, end) -> struct(element_at(roles, first) as role, slice(texts, first, end - first) as texts))"""))

    def pieces(block: Column) -> Column:
        body = F.transform(block["texts"], lambda t, i: F.array(
            F.struct(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t).alias("text"), (block["role"] == loss_role).alias("loss"))))
        head = F.struct(F.concat(F.lit(START), _escape_role(block["role"]), F.lit("\n")).alias("text"), F.lit(False).alias("loss"))
        tail = F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))
        return F.concat(F.array(head), F.flatten(body), F.array(tail))

    out = runs.select("conv_id", F.filter(F.flatten(F.transform("blocks", pieces)),
                                          lambda s: s["text"] != "").alias("segments"))
    return out.select("conv_id", F.array_join("segments.text", "").alias("formatted"), "segments")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted string: array<struct<role, text>>, unescaped."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>"), 2, 1 << 30)

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = block.substr(F.length(role) + 2, F.length(block) - F.length(role) - 1 - len(END))
        return F.transform(F.split(body, r"<\|im_next\|>"),
                           lambda t: F.struct(_unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
