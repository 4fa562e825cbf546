"""Chat formatting as relational expressions, with a reversible template and a loss mask.

A conversation's rows are collected as structs, sorted by turn, and adjacent
turns of one role are merged into a block::

    <s>[INST]text[/INST]  [OUT]text</s>  [SYS]text[/SYS]  [ROLE]role[MSG]text[/MSG]

(without the blanks); texts of merged turns are joined by ``[TURN]``, so the
turns can be read back one by one.  A control string inside a text gets one
more backslash after its opening character (``[INST]`` becomes ``[\\INST]``,
``[\\INST]`` becomes ``[\\\\INST]``); other text is unchanged, and taking one
backslash away again restores the text exactly.

Only DataFrame functions are used.  A conversation becomes one string, so its
turns meet in one row by nature; turns are never compared pairwise.

Defined cases: a null text or role is the empty string; a null turn sorts first;
ties in turn are ordered by role, then text, and repeated rows all stay; rows
with a null ``conv_id`` form one conversation; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import characters, cut_out, folded, let

OPEN = {"user": "[INST]", "assistant": "[OUT]", "system": "[SYS]"}
CLOSE = {"user": "[/INST]", "assistant": "</s>", "system": "[/SYS]"}
BEGIN, TURN, ROLE, MSG, END_MSG = "<s>", "[TURN]", "[ROLE]", "[MSG]", "[/MSG]"
_TAIL = r"(/?s>|/?INST\]|OUT\]|/?SYS\]|ROLE\]|/?MSG\]|TURN\])"
CONTROL = r"([<\[])(\\*)" + _TAIL
ESCAPED = r"([<\[])\\(\\*)" + _TAIL
_BLOCK = r"(?s)\[(?:INST|OUT|SYS|ROLE)\].*?(?:\[/INST\]|</s>|\[/SYS\]|\[/MSG\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _per_role(role: Column, values: dict[str, str], other: Column) -> Column:
    out = other
    for k, v in values.items():
        out = F.when(role == k, F.lit(v)).otherwise(out)
    return out


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss_spans`` (start and end, in code
    points of ``formatted``, of every assistant text)."""
    rows = df.select(
        F.col(conv).alias("conv"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                 F.coalesce(F.col(text), F.lit("")).alias("text")).alias("t"))
    turns = rows.groupBy("conv").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    # 1-based places where a block begins, and one past the last turn
    n = F.size("turns")
    starts = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (
        F.element_at("turns", i)["role"] != F.element_at("turns", F.greatest(i - 1, F.lit(1)))["role"]))
    turns = turns.withColumn("starts", F.concat(starts, F.array(n + 1)))
    blocks = F.transform(
        F.slice("starts", 1, F.size("starts") - 1),
        lambda s, j: F.struct(
            F.element_at("turns", s)["role"].alias("role"),
            F.transform(F.slice("turns", s, F.element_at("starts", j + 2) - s),
                        lambda t: escape(t["text"])).alias("texts")))
    merged = turns.select("conv", blocks.alias("blocks"))
    opened = lambda r: _per_role(r, OPEN, F.concat(F.lit(ROLE), escape(r), F.lit(MSG)))
    closed = lambda r: _per_role(r, CLOSE, F.lit(END_MSG))
    out = merged.select(
        "conv", "blocks",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("blocks", lambda b: F.concat(
            opened(b["role"]), F.array_join(b["texts"], TURN), closed(b["role"]))), "")).alias("formatted"),
        # every piece between control strings with the length of what stands before it
        F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t, i: F.struct(
            F.when(i == 0, F.length(opened(b["role"]))).otherwise(F.lit(len(TURN))).alias("before"),
            F.length(t).alias("n"),
            F.when(i == F.size(b["texts"]) - 1, F.length(closed(b["role"]))).otherwise(F.lit(0)).alias("after"),
            (b["role"] == "assistant").alias("loss"))))).alias("pieces"))
    def step(at: Column, spans: Column, p: Column):
        begin = at["at"] + p["before"]
        return F.struct((begin + p["n"] + p["after"]).alias("at")), F.when(p["loss"], F.concat(spans, F.array(F.struct(
            begin.alias("start"), (begin + p["n"]).alias("end"))))).otherwise(spans)

    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = folded(F.col("pieces"), F.struct(F.lit(len(BEGIN)).alias("at")), none, step)["out"]
    return out.select(F.col("conv").alias(conv), "formatted", spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of ``struct<role, text>``."""
    def turns(block: Column) -> Column:
        mark = F.regexp_extract(block, r"^(\[[A-Z]+\])", 1)
        body = F.regexp_replace(block, r"^\[[A-Z]+\]|(?:\[/INST\]|</s>|\[/SYS\]|\[/MSG\])$", "")
        other = mark == ROLE
        role = F.when(other, unescape(F.substring_index(body, MSG, 1)))
        for name, o in OPEN.items():
            role = role.when(mark == o, F.lit(name))
        texts = F.when(other, F.regexp_replace(body, r"(?s)^.*?\[MSG\]", "")).otherwise(body)
        return let(F.struct(role.alias("role"), F.split(texts, r"\[TURN\]", -1).alias("texts")), lambda b: F.transform(
            b["texts"], lambda t: F.struct(b["role"].alias("role"), unescape(t).alias("text"))))

    return F.flatten(F.transform(F.regexp_extract_all(formatted, F.lit(_BLOCK), F.lit(0)), turns))


def masked_texts(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask."""
    return let(characters(formatted), lambda c: F.transform(spans, lambda s: unescape(cut_out(c, s["start"], s["end"]))))
