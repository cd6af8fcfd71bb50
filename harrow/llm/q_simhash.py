"""Query of the SimHash operator (XXH64 has no DuckDB twin; tested by brute force)."""

from pyspark.sql import functions as F

from harrow.llm.registry import register, table
from harrow.llm.simhash import simhash_components


@register("op10_simhash_near_dedup")
def op10_simhash_near_dedup(spark, sf_dir):
    rows = simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")
