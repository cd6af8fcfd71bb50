"""Joins whose shape is known: one-row aggregates, and lookups by a key that may be hot."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of the rows from which a key is hot, unless a caller says otherwise: there are at most
# its inverse of them.
HOT_SHARE = 0.01
# Pieces that a partition's worth of a hot key is cut into, so that hashing evens them out.
SPREAD = 4


def attach(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put the columns of a frame of at most one row next to every row of ``left``.

    The row is a scalar subquery: nothing runs while the plan is built, and the plan is a
    projection, not a join.  Without a row the new columns are null; more than one row is
    an error when the query runs."""
    row = right.select(F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("s")).scalar()
    return (left.withColumn("__attached", row)
            .select(*[F.col(f"`{c}`") for c in left.columns],
                    *[F.col("__attached").getField(c).alias(c) for c in right.columns]))


def hot_keys(df: DataFrame, key: Column, share: float = HOT_SHARE) -> dict:
    """Keys with at least ``share`` of the rows and their exact shares, null among them.

    A frequent-items sketch, merged over all tasks, names every such key and a bounded number of
    others; one aggregate counts just those.  The driver reads a few times ``1 / share`` keys."""
    keys = df.select(key.alias("k"))
    found = keys.where("k is not null").freqItems(["k"], share).first()[0] or []
    counted = keys.agg(F.count("*").alias("n"), F.count_if(F.col("k").isNull()).alias("null"), *[
        F.count_if(F.col("k") == F.lit(v)).alias(f"c{i}") for i, v in enumerate(found)]).first()
    n = max(counted["n"], 1)
    hot = {v: counted[f"c{i}"] / n for i, v in enumerate(found)} | {None: counted["null"] / n}
    return {v: s for v, s in hot.items() if s >= share}


def lookup_join(left: DataFrame, one: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """``left`` with the columns of ``one`` (one row per key; no match: nulls), in one exchange
    of either side, whatever share of the rows a key holds.

    Rows of a hot key are spread over ``SPREAD`` salts for every partition's worth of rows that
    it holds, and its single row of ``one`` stands under each: some ``SPREAD`` times the
    partitions in all, so the copies are bounded by the cluster and not by the data.  Null keys
    match nothing and are spread like a hot key."""
    spark = left.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = {v: math.ceil(SPREAD * s * parts) for v, s in hot_keys(left, F.col(key), share).items()}
    salts = F.lit(1)
    for v, n in hot.items():
        if v is not None:
            salts = F.when(F.col(key) == F.lit(v), F.lit(n)).otherwise(salts)
    salt = F.pmod(F.monotonically_increasing_id(), F.when(F.col(key).isNull(), F.lit(SPREAD * parts))
                  .otherwise(salts)).cast("int")
    copies = one.where(F.col(key).isNotNull()).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.withColumn("__salt", salt).join(copies, [key, "__salt"], "left").drop("__salt")
