"""Query of the suffix-sort deduplicator (byte strings have no SQL; tested by brute force)."""

from pyspark.sql import functions as F

from harrow.llm.registry import register, table
from harrow.llm.suffixes import remove_repeats


@register("op9_suffix_array_dedup")
def op9_suffix_array_dedup(spark, sf_dir):
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))
