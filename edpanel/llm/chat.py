"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs, sorted, and adjacent turns of one role
are merged into one block by an array aggregation; blocks are concatenated to one string.
Inside a block the texts stay apart by a separator, so the turns can be read back exactly::

    <|start|>role<|role|>text<|turn|>text<|end|>

Texts and roles may hold control strings. Escaping puts one backslash after the first
character of a control string (and after any backslashes that already stand there), unescaping
takes one away; a control string never begins inside another, so both are exact inverses and
ordinary text is left as it is.

Defined results: a null text or role is empty; rows that repeat are all turns, ties in ``turn``
go by role and text, null turns first; a null ``conv_id`` is a conversation of its own; an
empty table gives no row; extra columns are ignored. A conversation is one output row, so its
turns meet in one group; the formatted text is that long in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, ROLE, TURN, END = "<|start|>", "<|role|>", "<|turn|>", "<|end|>"
LOSS_ROLE = "assistant"
# Control strings of this and of common templates: none may occur unescaped inside a text.
_BODY = r"(/?s>|/?INST\]|\|(?:start|role|turn|end|im_start|im_end|system|user|assistant|endoftext)\|>)"
_ESCAPE = rf"([<\[])(\\*){_BODY}"
_UNESCAPE = rf"([<\[])(\\*)\\{_BODY}"
TURNS = "array<struct<role:string,text:string>>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, r"$1$2$3")


def format_conversations(df: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans (start, length in code points of
    every text of ``loss_role`` in ``formatted``)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", role.alias("role"), text.alias("text")))).alias("turns"))
    pieces = "array<struct<open:string,text:string,loss:boolean>>"
    # a turn opens a block (and ends the one before it) unless its role is that of the turn before
    merged = turns.withColumn("turns", F.transform("turns", lambda t: F.struct(
        escape(t["role"]).alias("role"), escape(t["text"]).alias("text"), (t["role"] == loss_role).alias("loss"))))
    opened = merged.withColumn("pieces", F.transform("turns", lambda t, k: F.struct(
        F.when(k == 0, F.concat(F.lit(START), t["role"], F.lit(ROLE)))
        .when(F.get("turns", k - 1)["role"] == t["role"], F.lit(TURN))
        .otherwise(F.concat(F.lit(END + START), t["role"], F.lit(ROLE))).alias("open"),
        t["text"].alias("text"), t["loss"].alias("loss"))).cast(pieces))
    formatted = F.concat(F.array_join(F.transform("pieces", lambda p: F.concat(p["open"], p["text"])), ""), F.lit(END))
    # running code point offsets of the texts
    ends = F.aggregate("pieces", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")),
                       lambda acc, p: F.struct(
                           (acc["at"] + F.length(p["open"]) + F.length(p["text"])).cast("long").alias("at"),
                           F.when(p["loss"], F.concat(acc["spans"], F.array(F.struct(
                               (acc["at"] + F.length(p["open"])).cast("long").alias("start"), F.length(p["text"]).cast("long").alias("length")))))
                           .otherwise(acc["spans"]).alias("spans")),
                       lambda acc: acc["spans"])
    return opened.select("conv_id", formatted.alias("formatted"), ends.alias("loss_spans"))


def read_conversations(df: DataFrame) -> DataFrame:
    """The formatted rows parsed back: conv_id, turns (role, text), loss_texts (the text under
    the loss mask, unescaped), formatted, loss_spans."""
    blocks = F.filter(F.split("formatted", r"<\|start\|>"), lambda b: b != "")
    parsed = F.flatten(F.transform(blocks, lambda b: F.transform(
        F.split(F.substring_index(F.substring_index(b, END, 1), ROLE, -1), r"<\|turn\|>"),
        lambda t: F.struct(unescape(F.substring_index(b, ROLE, 1)).alias("role"), unescape(t).alias("text")))))
    loss = F.transform("loss_spans", lambda s: unescape(F.call_function(
        "substring", F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return df.select("conv_id", parsed.alias("turns"), loss.alias("loss_texts"), "formatted", "loss_spans")
