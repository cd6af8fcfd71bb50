"""Cleaning with an audit trail.

The duplicate test is the whole row, null-safe (``dropDuplicates``/``groupBy`` treat
null == null, as the reference's duplicate test does).  Duplicates are counted
before dates are parsed.  ``now`` is an argument, never the wall clock.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.functions.columns import lower_columns, parse_mixed_dates

DEFAULT_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd")


def _now_lit(now: dt.datetime | dt.date | str):
    if isinstance(now, str):
        now = dt.datetime.fromisoformat(now)
    if isinstance(now, dt.date) and not isinstance(now, dt.datetime):
        now = dt.datetime(now.year, now.month, now.day)
    return F.lit(now)


def _day(col) -> F.Column:
    return F.date_format(col, "yyyy-MM-dd")


def clean(df: DataFrame, time_col: str, now, formats: Sequence[str] = DEFAULT_FORMATS) -> DataFrame:
    """Drop exact duplicates, then rows whose date is unparseable or after ``now``.

    The time column comes back parsed (timestamp), as in the reference.
    """
    frame = lower_columns(df).dropDuplicates()
    column = time_col.lower()
    if column not in frame.columns:
        return frame
    parsed = parse_mixed_dates(column, formats)
    frame = frame.withColumn(column, parsed)
    return frame.filter(F.col(column).isNotNull() & (F.col(column) <= _now_lit(now)))


def row_groups(df: DataFrame, carry: dict[str, Column] | None = None) -> DataFrame:
    """One row per different row of ``df``: how often it occurs (``__n``) and the ``carry``
    columns (name to expression of the row), by digest and verified.

    Rows meet by a 128-bit digest and their carried columns, so the exchange does not grow with
    the width of the table.  A digest that occurs once is a row of its own; only rows whose
    digest repeats are compared as whole rows, so a collision changes nothing."""
    # Nulls do not enter a hash, so which columns are null does.
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    cols = [F.col(f"`{c}`") for c in df.columns]
    digest = [F.xxhash64(nulls, *cols).alias("__h1"),
              F.xxhash64(F.lit("second"), *reversed(cols), nulls).alias("__h2")]
    carried = [c.alias(n) for n, c in (carry or {}).items()]
    kept = [F.count(F.lit(1)).alias("__n"), *[F.first(n).alias(n) for n in carry or {}]]
    met = df.select(*digest, *carried).groupBy("__h1", "__h2").agg(*kept)
    again = met.where("__n > 1").select("__h1", "__h2")
    whole = (df.select("*", *digest, *carried).join(again, ["__h1", "__h2"], "left_semi")
             .groupBy(*cols).agg(*kept))
    out = ["__n", *(carry or {})]
    return met.where("__n = 1").select(*out).unionByName(whole.select(*out))


def cleaning_report(df: DataFrame, time_col: str, now,
                    formats: Sequence[str] = DEFAULT_FORMATS) -> DataFrame:
    """One row describing every exclusion ``clean`` makes.

    What is exchanged per row is a digest and its date (``row_groups``); one aggregate over the
    groups gives every figure.
    """
    frame = lower_columns(df)
    column = time_col.lower()
    now_c = _now_lit(now)
    d = (parse_mixed_dates(column, formats) if column in frame.columns
         else F.lit(None).cast("timestamp"))
    groups = row_groups(frame, {"__d": d})
    valid = F.col("__d").isNotNull()
    kept = valid & (F.col("__d") <= now_c)
    has_time = column in frame.columns
    agg = groups.agg(
        F.sum("__n").alias("rows_in"),
        F.count(F.lit(1)).alias("__distinct"),
        F.count_if(~valid).alias("unparseable_dates_dropped") if has_time
        else F.lit(0).cast("bigint").alias("unparseable_dates_dropped"),
        F.count_if(valid & (F.col("__d") > now_c)).alias("future_dates_dropped"),
        F.min(F.when(valid, F.col("__d"))).alias("__min_b"),
        F.max(F.when(valid, F.col("__d"))).alias("__max_b"),
        F.min(F.when(kept, F.col("__d"))).alias("__min_a"),
        F.max(F.when(kept, F.col("__d"))).alias("__max_a"),
        F.count_if(kept if has_time else F.lit(True)).alias("rows_out"),
    )
    return agg.select(
        F.coalesce("rows_in", F.lit(0)).cast("bigint").alias("rows_in"),
        (F.coalesce("rows_in", F.lit(0)) - F.col("__distinct")).cast("bigint")
        .alias("duplicates_dropped"),
        F.col("unparseable_dates_dropped").cast("bigint"),
        F.col("future_dates_dropped").cast("bigint"),
        _day(now_c).alias("cutoff"),
        _day("__min_b").alias("date_min_before"),
        _day("__max_b").alias("date_max_before"),
        _day("__min_a").alias("date_min_after"),
        _day("__max_a").alias("date_max_after"),
        F.col("rows_out").cast("bigint"),
        (F.coalesce("rows_in", F.lit(0)) - F.col("rows_out")).cast("bigint")
        .alias("rows_dropped_total"),
    )
