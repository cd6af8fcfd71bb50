"""Query of the privacy operator (spans of patterns have no SQL; tested by brute force)."""

from pyspark.sql import functions as F

from harrow.llm.privacy import BASE_KINDS, KINDS, find_spans, spans_text
from harrow.llm.registry import register, table


@register("op3_pii")
def op3_pii(spark, sf_dir):
    found = find_spans(table(spark, sf_dir, "documents"))

    def number_of(kind: int):
        # One argument only: Spark passes an element's position as a second one.
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number_of(k).alias(f"n_{KINDS[k]}") for k in range(BASE_KINDS)]
    return found.select("doc_id", *counts, F.sha2(spans_text("base"), 256).alias("base_sha256"),
                        spans_text("spans").alias("spans"))
