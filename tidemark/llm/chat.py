"""Chat formatting with a grammar that is checked by reparsing.

    conversation = turn*        turn = "### " role ": " text "</turn>" LF

A role ends at its first ": ". Neither "### " nor "</turn>" may stand inside a role or a text, nor ": " inside a role.
The parser splits at "</turn>" LF, cuts role and text apart and takes one escape level off; a turn that breaks the
grammar is no turn. A turn is first rendered as it is. If the parser doesn't give back the very same turn, its control
strings are escaped, by one backslash after their first character (after those that stand there already, so that
escaping can be undone at any depth): "### " becomes "#\\## ", "</turn>" becomes "<\\/turn>" and, in a role, ": " becomes
":\\ ". An escaped turn always parses back; the whole conversation is reparsed all the same, and a difference is an error.

Everything is DataFrame functions. A conversation must fit one row, as its text does. Null roles and texts are empty.
Turns go by turn number (null first), then role, then text; repeated rows are turns of their own; rows without a
conversation id are one conversation. Other columns are not read. No rows give no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_of

START, MIDDLE, END = "### ", ": ", "</turn>"
#: First character and rest of each control string.
BODY = (("#", "## "), ("<", "/turn>"))
HEAD = (*BODY, (":", " "))


def escape(text: Column, marks: tuple[tuple[str, str], ...] = BODY) -> Column:
    for first, rest in marks:
        text = F.regexp_replace(text, rf"{first}(\\*){rest}", rf"{first}\\$1{rest}")
    return text


def unescape(text: Column, marks: tuple[tuple[str, str], ...] = BODY) -> Column:
    for first, rest in marks:
        text = F.regexp_replace(text, rf"{first}\\(\\*){rest}", rf"{first}$1{rest}")
    return text


def _rendered(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(MIDDLE), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation; those that break the grammar are null, null."""

    def turn(part: Column) -> Column:
        middle = F.locate(MIDDLE, part, len(START) + 1)
        role = F.substr(part, F.lit(len(START) + 1), middle - len(START) - 1)
        text = F.substr(part, middle + len(MIDDLE))
        broken = ~F.startswith(part, F.lit(START)) | (middle == 0)
        for mark in (START, END):
            broken = broken | F.contains(text, F.lit(mark)) | F.contains(role, F.lit(mark))
        return F.struct(
            F.when(~broken, unescape(role, HEAD)).alias("role"), F.when(~broken, unescape(text)).alias("text")
        )

    parts = F.split(formatted, END + "\n")
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), turn)


def format_conversations(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    learned: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: n_turns, formatted, loss (where texts to learn stand: start from 0 and length) and turns.

    turns are those read back from formatted. The loss spans cover escaped texts, which unescape() turns back.
    """
    rows = df.select(
        df[conversation].alias("conv_id"), df[turn].alias("turn"), text_of(df[role]).alias("role"), text_of(df[text]).alias("text")
    )
    plain = rows.withColumn("rendered", _rendered(F.col("role"), F.col("text")))
    same = F.coalesce(parse(F.col("rendered")) == F.array(F.struct("role", "text")), F.lit(False))
    role_out = F.when(F.col("same"), F.col("role")).otherwise(escape(F.col("role"), HEAD))
    text_out = F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text")))
    turns = plain.withColumn("same", same).select(
        "conv_id", "turn", "role", "text", role_out.alias("role_out"), text_out.alias("text_out")
    )
    turns = turns.withColumn("head", F.length("role_out") + len(START + MIDDLE)).withColumn("body", F.length("text_out"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = F.sum(F.col("head") + F.col("body") + len(END) + 1).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = turns.withColumns({"place": F.row_number().over(order), "before": F.coalesce(before, F.lit(0))})
    gathered = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "place", "role", "text", "body", (F.col("before") + F.col("head")).alias("start"),
                    _rendered(F.col("role_out"), F.col("text_out")).alias("rendered"),
                )
            )
        ).alias("all")
    )
    spans = F.transform(
        F.filter("all", lambda t: t["role"].isin(*learned)),
        lambda t: F.struct(t["start"].alias("start"), t["body"].cast("long").alias("length")),
    )
    formatted = gathered.select(
        "conv_id",
        F.array_join(F.transform("all", lambda t: t["rendered"]), "").alias("formatted"),
        spans.alias("loss"),
        F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("source"),
    )
    read = formatted.withColumn("read", parse(F.col("formatted")))
    wrong = F.raise_error(F.concat(F.lit("not read back: conversation "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    return read.select(
        "conv_id",
        F.size("source").cast("long").alias("n_turns"),
        "formatted",
        "loss",
        F.when(F.col("read") == F.col("source"), F.col("read")).otherwise(wrong).alias("turns"),
    )


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), ""
    )
