import random

import pyarrow.parquet as pq
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from harrow.llm.q_tokens import VOCABULARY
from harrow.llm.tokens import PairMerger, count_tokens, merger

PATH = public_tokenizers.path(VOCABULARY)
LIBRARY = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def library():
    return LIBRARY


def lib_count(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


ODD = ["", " ", "aaaaaaaaaaa", "İSTANBUL ΣΊΣΥΦΟΣ ς", "éé", "<|startoftext|>a<|endoftext|>",
       "<|endoftext|", "it's I'LL we'd 'tis", "１２３ ½ ②", "\x1c\x1d\x85 x", "日本語テキスト",
       "👩‍👩‍👧 ok", "a" * 5000, "ab" * 3000, "!" * 999, "\u0000x", "ﬁ ß ẞ Ǆ", "<|startoftext|><|startoftext|>"]


def test_odd_texts(library):
    assert PairMerger(PATH).count_texts(ODD) == lib_count(library, ODD)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
def test_any_text(texts):
    assert merger(PATH).count_texts(texts) == lib_count(LIBRARY, texts)


def test_letters(library):
    rng = random.Random(4)
    texts = ["".join(rng.choices("aeinorst' .", k=200)) for _ in range(500)]
    assert merger(PATH).count_texts(texts) == lib_count(library, texts)


def test_whole_table(spark, library):
    sf = "/root/testdata/sf0.001/documents.parquet"
    t = pq.read_table(sf).to_pydict()
    got = {r.doc_id: r for r in count_tokens(spark.read.parquet(sf), PATH).collect()}
    want = lib_count(library, t["text"])
    assert len(got) == len(want)
    for i, text, n in zip(t["doc_id"], t["text"], want, strict=True):
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (
            len(text.encode()), n, n > 2048)


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (1, None), (1, ""), (2, "a"), (2, "a")],
                               "doc_id long, text string").selectExpr("*", "7 as n_tokens")
    rows = sorted(tuple(r) for r in count_tokens(df, PATH).na.fill(-1).collect())
    assert rows == [(-1, 1, 1, False), (1, 0, 0, False), (1, 0, 0, False), (2, 1, 1, False),
                    (2, 1, 1, False)]
    assert count_tokens(df.limit(0), PATH).count() == 0
