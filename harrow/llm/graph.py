"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.llm.common import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.shiftrightunsigned(F.xxhash64("a", "b"), 24)).alias("h")).first()
    return row["n"], row["h"] or 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = (both.groupBy("a").agg(F.min("b").alias("m"))
           .select("a", F.least("a", "m").alias("m")))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = (down.join(low, "a").where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Label every node of ``edges`` (columns ``a``, ``b``; self-links and repeats are
    fine) with the smallest node that can be reached: columns ``node``, ``root``, one row
    per node that has a link and is not itself a root.

    Each round writes its link table to the shared folder and reads it back, so lineage
    stays short; only counts come to the driver.  Stars need a logarithmic number of
    rounds even for long chains."""
    links = stored(edges.where("a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), name)
    state = _state(links)
    while state[0]:
        links = stored(_small_star(_large_star(links)), name)
        state, before = _state(links), state
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
