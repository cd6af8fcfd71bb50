"""Lexical search against a plain version over lists."""

import math
import random
import re
from collections import Counter

import pytest

from harrow.llm import lexical
from harrow.llm.common import lower_ascii
from harrow.llm.lexical import TERM, TermScanner, guarded, search
from harrow.llm.q_lexical import SQL, op13_lexical_search
from tests.oracle import compare, duck

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    return re.findall(TERM, lower_ascii(text or ""))


def brute(docs, items, k=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for item, known in wanted.items():
        found = []
        for i, bag, n in bags:
            m = 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in known if bag[t])
            if score > 0:
                found.append((-score, i is not None, i or 0, i))
        found.sort(key=lambda x: x[:3])
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as row", "2 as n", "'x' as term", "0 as score")
    i = spark.createDataFrame(items, ITEMS).selectExpr("*", "5 as number", "6 as item")
    return sorted(map(tuple, search(d, i, **kw).collect()), key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["a", "b", "Aa", "aa", "über", "ÜBER", "x1", "1", "日本", "ß", "w" * 30] + [f"t{i}" for i in range(40)]
    seps = [" ", "-", "\n", "\x00", ", ", "\x7f", "  ", "_"]
    def text(m):
        return "".join(rng.choice(words) + rng.choice(seps) for _ in range(m))
    docs = [(i, text(rng.choice([0, 1, 3, 9, 40]))) for i in range(n)]
    items = [(i, text(rng.choice([1, 4, 12]))) for i in range(12)]
    return docs, items


def test_odd_rows(spark):
    docs, items = corpus(1, 150)
    docs += [(None, "a b"), (3, None), (4, ""), (5, ",;"), (7, docs[2][1]), (7, docs[2][1]),
             (8, "a " * 70000 + "t1"), (9, "A-a_aa\x00aa")] + [(100 + i, "t5 t6") for i in range(80)]
    items += [(None, "t1 t2"), (50, None), (51, ""), (52, "nowhere"), (0, "t9 t8"), (53, "t5 " * 300)]
    assert run(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize("limits", [dict(seed_docs=20, k=3), dict(block_terms=7, k=5),
                                    dict(block_items=3, seed_docs=40)])
def test_blocks_and_seed_change_nothing(spark, limits):
    docs, items = corpus(2, 300)
    assert run(spark, docs, items, **limits) == brute(docs, items, limits.get("k", 50))


def test_small_batches_change_nothing(spark, monkeypatch):
    docs, items = corpus(3, 200)
    monkeypatch.setattr(lexical, "BLOCK_LINKS", 20)
    assert run(spark, docs, items, k=4) == brute(docs, items, 4)


def test_scanner_finds_whole_terms_only():
    scanner = TermScanner([0, 1, 2, 3], ["a", "aa", "über", "b"])
    assert scanner.scan("a a aa ÜBER über baa-a_b") == (8, Counter({0: 3, 1: 1, 2: 1, 3: 1}))
    assert guarded("A.é") == " a \xc3\xa9 "


def test_empty_tables(spark):
    docs, items = corpus(4, 30)
    assert run(spark, docs, [(1, "a")])
    assert run(spark, [], items) == [] and run(spark, docs, []) == []
    assert run(spark, [(1, None)], items) == []


def test_query_and_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert not compare(spark, duck(sf), "op13", op13_lexical_search, SQL, sf)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert sorted(map(tuple, op13_lexical_search(spark, sf).collect()), key=repr) == brute(docs, items)
