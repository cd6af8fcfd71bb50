"""The flagship job: clean -> label -> temporal split -> score -> group metrics -> fairness."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.operators import evaluate as E
from harrow.operators.rank import temporal_split
from harrow.plans import fixtures as FX


def holdout_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test tail of the cleaned, labelled track table with a rule-based score."""
    lab = FX.labelled_tracks(spark, sf_dir)
    split = temporal_split(lab, "first_week", ["track_key"], test_size=0.2)
    score = (F.col("acctbal") + 1000) / 11000
    return (split.filter(F.col("is_test") == 1)
            .select("track_key", F.col("hit").alias("y_true"), score.alias("y_score"),
                    (score >= 0.5).cast("int").alias("y_pred"), F.col("nation").alias("group")))


def fairness_flagship(spark: SparkSession, sf_dir: str, min_n: int = 30) -> DataFrame:
    test = holdout_scored(spark, sf_dir)
    groups = E.metrics_by_group(test, "y_true", "y_pred", "group")
    return E.fairness_summary(groups, min_n)
