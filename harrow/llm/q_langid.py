"""Query of the language identifier (no SQL; tested by held-out accuracy)."""

from harrow.llm.langid import identify
from harrow.llm.registry import register, table


@register("op12_language_id")
def op12_language_id(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score", "accepted")
