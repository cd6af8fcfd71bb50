"""The corpus pipeline: stages over ``documents``, each written and read again.

Quality rules drop documents, SimHash keeps one document of each near-duplicate group,
decontamination drops documents that hold a benchmark window, privacy rewrites texts, and
mixing samples documents towards tempered source, language and form shares.

Defined cases: null and empty texts, and texts of under 50 words, go in the first stage; very
long texts are read whole by every stage; of equal rows and ties the near-duplicate stage keeps
the smallest id; rows that repeat an id are judged one by one until then; an empty table stays
empty; further columns travel along whatever their names, and the last stage adds its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harrow.llm.common import stored
from harrow.llm.mixing import sample_mix
from harrow.llm.privacy import sanitise
from harrow.llm.quality import filter_quality
from harrow.llm.simhash import keep_one_per_group
from harrow.llm.winnow import drop_contaminated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the quality rules."""
    return filter_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of every group of fingerprints within three bits."""
    return keep_one_per_group(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that share ten consecutive words with a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and the terms that disclose it; ``n_chars`` follows."""
    clean = sanitise(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample towards the target shares of source, language and form."""
    return sample_mix(docs)


STAGES = [("quality rules", quality), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", decontamination), ("pii", privacy),
          ("source mixing", mixing)]
# XXH64 fingerprints and span search have no SQL; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"stage{i}")
    return docs
