"""All queries of the training-data operators; importing this registers them."""

import corpus_pipeline
from harrow.llm import (q_chat, q_langid, q_lexical, q_licences, q_lm, q_merkle,  # noqa: F401
                        q_mixing, q_privacy, q_quality, q_simhash, q_suffixes, q_tokens, q_winnow)
from harrow.llm.registry import ORACLE, QUERIES, register  # noqa: F401

register("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
