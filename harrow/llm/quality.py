"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text.  The ledger keeps the measurements and one long
with a bit per failed rule; a policy is a named, versioned mask over those bits, so
verdicts of any version and ablations (what a rule alone removes) are bitwise work on
the ledger and never touch the text again.

Defined cases: a null text has no words (it fails ``few_words``); a null id stays null;
repeated rows give repeated ledger rows; an empty table gives an empty ledger; columns
of the input other than the id and the text are not looked at."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harrow.llm.common import WORD_RE, id_and_text, small_batches

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_bangs")
MEASURE_TYPE = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])
_SYMBOLS = "#*$%&|<>"

# Rule name -> condition of failure, over the measurements.  The position is the bit;
# append new rules, never reorder.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "100 * n_symbols > 20 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("exclamations", "100 * n_bangs > 40 * n_words"),
    ("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
# Policy version -> rules that reject.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "duplicate_lines", "exclamations"),
    "v2": tuple(name for name, _ in RULES),
}
DEFAULT_POLICY = "v2"


def _repeat_words(words: list[str]) -> int:
    """Words inside some 3-word window that is found at least twice."""
    if len(words) < 4:
        return 0
    ids: dict[str, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = np.unique(seq[:-1] * len(ids) + seq[1:], return_inverse=True)[1]
    window = pair[:-1] * np.int64(len(ids)) + seq[2:]
    _, inverse, counts = np.unique(window, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:shift + len(again)] |= again
    return int(covered.sum())


def measure_text(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    text = text or ""
    words = WORD_RE.findall(text)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if WORD_RE.search(line):
            lines += 1
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in _SYMBOLS), dups,
            _repeat_words(words), lines, text.count("!"))


@F.pandas_udf(MEASURE_TYPE)
def _measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame([measure_text(t) for t in batch], columns=list(MEASURES),
                           dtype="int64")


def failure_bits(measures: str = "__m") -> Column:
    """One long: the sum of the bits of all failed rules."""
    bits = F.lit(0).cast("long")
    for i, (_, condition) in enumerate(RULES):
        named = re.sub(r"\b(" + "|".join(MEASURES) + r")\b", measures + r".\1", condition)
        bits = bits.bitwiseOR(F.when(F.expr(named), F.lit(1 << i).cast("long"))
                              .otherwise(F.lit(0).cast("long")))
    return bits


def policy_mask(policy: str) -> int:
    return sum(BIT[name] for name in POLICIES[policy])


def rejected(bits: str | Column, policy: str) -> Column:
    """Whether a policy's version rejects a ledger row."""
    bits = F.col(bits) if isinstance(bits, str) else bits
    return bits.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) != 0


def quality_ledger(docs: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per document: the id, every measurement and ``fail_bits``."""
    small_batches(docs.sparkSession)
    rows = (id_and_text(docs, id_col, text_col)
            .select("doc_id", _measure("text").alias("__m"))
            .select("doc_id", "__m", failure_bits().alias("fail_bits")))
    return rows.select("doc_id", "__m.*", "fail_bits")


def apply_policy(ledger: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under a policy's version."""
    return ledger.withColumns({"base_failed": rejected("fail_bits", "base"),
                               "kept": ~(rejected("fail_bits", "base")
                                         | rejected("fail_bits", policy))})


def ablations(ledger: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: rows that fail it, rows that only it rejects (kept again
    without it) and the union of the other failures of its rows.  One pass reduces the
    ledger to its distinct bit patterns; the rest is bitwise work on those."""
    mask = policy_mask(policy)
    patterns = (ledger.withColumn("bits", F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")))
                .groupBy("bits").agg(F.count("*").alias("n")))
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(BIT[name]).cast("long")
                               .alias("bit")) for name in POLICIES[policy]])
    return (patterns.withColumn("r", F.explode(rules)).select("bits", "n", "r.*")
            .groupBy("rule", "bit").agg(
                F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n"))
                      .otherwise(0)).alias("n_failed"),
                F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))
                      .otherwise(0)).alias("n_only"),
                F.coalesce(F.bit_or(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0,
                                           F.col("bits"))), F.lit(0).cast("long"))
                .bitwiseAND(F.bitwise_not(F.first("bit"))).alias("seen_with")))


def filter_quality(docs: DataFrame, policy: str = DEFAULT_POLICY,
                   text_col: str = "text") -> DataFrame:
    """The rows that the base rules and the policy keep, with all their columns; one
    narrow pass, no shuffle."""
    small_batches(docs.sparkSession)
    cols = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.select(F.struct(*cols).alias("__row"),
                         _measure(F.col(text_col).cast("string")).alias("__m"))
    bits = marked.select("__row", failure_bits().alias("__bits"))
    kept = bits.where(~(rejected("__bits", "base") | rejected("__bits", policy)))
    return kept.select("__row.*")
