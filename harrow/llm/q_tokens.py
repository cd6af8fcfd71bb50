"""Query of the token counter (no SQL; tested against the tokenizer library)."""

from harrow.llm.registry import register, table
from harrow.llm.tokens import count_tokens

VOCABULARY = "word_bpe_49k.json"


@register("op8_token_counts")
def op8_token_counts(spark, sf_dir):
    import public_tokenizers
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
