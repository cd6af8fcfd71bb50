"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs, sorted, merged where neighbours have
the same role (array functions over the sorted turns), and concatenated to a marked text:

    <|start|>role<|say|>first text<|part|>second text<|end|>

A merged block keeps its texts apart with a mark, so nothing is lost.  Inside roles and
texts every backslash is doubled and every control string (the template's own and those of
common chat formats) gets a backslash after its first character; reading takes that back
exactly.  ``loss`` holds the spans (start, end; code points) of the assistant texts.

Defined cases: a null text or role is empty; a null conversation id is a conversation of
its own; a null turn sorts first; equal turn numbers sort by role, then text; repeated rows
are turns each; an empty table gives no rows; other columns are not read.  One conversation
is one output row, so its turns meet in one task, as the result itself demands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SAY, PART, END = "<|start|>", "<|say|>", "<|part|>", "<|end|>\n"
# The first characters of control strings (this template's and those of
# common chat formats), each with what must follow for it to be escaped; or a backslash.
_CONTROL = r"\\|<(?=\|)|<(?=/?s>)|<(?=</?SYS>>)|\[(?=/?INST\])"
_MARKS = r"<\|start\|>|<\|say\|>|<\|part\|>"
# Texts whose lengths are summed at once when offsets are made.
_BLOCK = 256


def escape(text: Column) -> Column:
    """Append a backslash to every backslash and to what would begin a control string."""
    return F.regexp_replace(text, _CONTROL, r"$0\\")


def unescape(text: Column) -> Column:
    """Keep one of a pair of backslashes and drop a single one."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def collect_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, turns``: the sorted structs (turn, role, text) of each conversation."""
    turn = F.struct(F.col(turn_col).cast("long").alias("turn"),
                    F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (rows.groupBy(F.col(conv_col).cast("long").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias("turns")))


def format_chats(rows: DataFrame, learn: str = "assistant", **columns) -> DataFrame:
    """``conv_id, formatted, loss`` per conversation.

    Intermediate arrays are columns of their own: inside a lambda they would be evaluated
    again for every element."""
    turns = collect_turns(rows, **columns)
    # A turn opens a block if its role is new, and closes one if the next role is.
    edges = turns.select("conv_id", "turns", F.transform("turns", lambda t, i: F.struct(
        ((i == 0) | (F.get("turns", i - 1)["role"] != t["role"])).alias("opens"),
        F.coalesce(F.get("turns", i + 1)["role"] != t["role"], F.lit(True)).alias("closes"),
        escape(t["text"]).alias("text"))).alias("edges"))
    pieces = edges.select("conv_id", F.zip_with("turns", "edges", lambda t, e: F.struct(
        F.when(e["opens"], F.concat(F.lit(START), escape(t["role"]), F.lit(SAY)))
        .otherwise(F.lit(PART)).alias("before"), e["text"].alias("text"),
        F.when(e["closes"], F.lit(END)).otherwise(F.lit("")).alias("after"),
        (t["role"] == learn).alias("learn"))).alias("p"))
    # Offsets: sums of whole blocks of lengths, then sums within a block.
    sized = pieces.select("conv_id", "p", F.transform("p", lambda x: F.length(x["before"])
                          + F.length(x["text"]) + F.length(x["after"])).alias("n"))

    def total(values, first, count):
        return F.aggregate(F.slice(values, first, count), F.lit(0).cast("long"),
                           lambda a, x: a + x)
    sized = sized.select("conv_id", "p", "n", F.transform(
        F.sequence(F.lit(0), F.floor((F.size("n") - 1) / _BLOCK).cast("int")),
        lambda b: total(F.col("n"), b * _BLOCK + 1, F.lit(_BLOCK))).alias("sums"))
    sized = sized.select("conv_id", "p", "n", F.transform(
        "sums", lambda x, b: F.get("sums", b) - x + total(F.col("sums"), F.lit(1), b))
        .alias("base"))
    spans = sized.select("conv_id", "p", F.transform("p", lambda x, i: F.struct(
        x["learn"].alias("learn"), F.length(x["text"]).alias("size"),
        (F.get("base", F.floor(i / _BLOCK).cast("int"))
         + total(F.col("n"), F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)
         + F.length(x["before"])).alias("start"))).alias("at"))
    return spans.select(
        "conv_id", F.array_join(F.transform("p", lambda x: F.concat(
            x["before"], x["text"], x["after"])), "").alias("formatted"),
        F.transform(F.filter("at", lambda x: x["learn"]), lambda x: F.struct(
            x["start"].alias("start"), (x["start"] + x["size"]).alias("end"))).alias("loss"))


def parse_chats(formatted: DataFrame) -> DataFrame:
    """Read a formatted text back: ``conv_id, turns`` (role, text of every turn),
    ``learned`` (the unescaped texts under the loss spans), ``formatted_chars``."""
    blocks = F.split("formatted", r"<\|end\|>\n")
    rows = formatted.select("conv_id", "formatted", "loss", F.transform(
        F.filter(blocks, lambda b: b != ""), lambda b: F.split(b, _MARKS)).alias("b"))
    turns = F.flatten(F.transform("b", lambda b: F.transform(
        F.slice(b, F.lit(3), F.size(b)), lambda t: F.struct(
            unescape(F.get(b, F.lit(1))).alias("role"), unescape(t).alias("text")))))
    learned = F.transform("loss", lambda s: unescape(F.substring(
        F.col("formatted"), s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int"))))
    return rows.select("conv_id", turns.alias("turns"), learned.alias("learned"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
