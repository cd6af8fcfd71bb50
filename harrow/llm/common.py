"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The same two word patterns for Python and for Java expressions.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
# Rows of text that go to Python in one Arrow batch.
TEXT_ROWS = 256


# White space to Python's split() that is part of a word here.
_ODD = "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + (
    "\u2028\u2029\u202f\u205f\u3000")


def words_of(text: str) -> list[str]:
    """All matches of ``WORD``; where the two agree, by the much faster split()."""
    if any(c in text for c in _ODD):
        return WORD_RE.findall(text)
    return text.split()


def lower_ascii(text: str) -> str:
    """Lower-case A-Z only; every other character stays as it is."""
    # Bytes know only ASCII letters, and no other character has ASCII bytes in UTF-8.
    return text.lower() if text.isascii() else text.encode().lower().decode()


def lower_ascii_col(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of Python workers: few texts to an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def big_batches(spark: SparkSession) -> None:
    """For narrow rows: larger Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back: the lineage ends
    there, executors may be lost, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; extra columns, whatever
    they are called, go no further."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
