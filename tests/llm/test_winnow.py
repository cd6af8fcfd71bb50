import random
import re

import pytest

from harrow.llm.winnow import contamination, drop_contaminated


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for size in {len(x) for x in wins}:
            for i in range(len(w) - size + 1):
                got = wins.get(tuple(w[i:i + size]))
                if got is not None:
                    hit |= set(range(i, i + size))
                    found |= {str(x) for x in got if x is not None}
        out.append((doc, len(w), len(hit), sorted(found), bool(hit)))
    return out


def make(rng, short):
    vocab = ["a", "b", "É", "the", "x9", "zz"] + [f"w{i}" for i in range(40)]

    def some(n):
        return [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(some(rng.choice([12, 25, 40])))) for i in range(12)]
    items += [(3, items[5][1]), (None, " ".join(some(15))), (20, None), (21, "--"),
              (22, "a " * 30)]
    if short:
        items += [(30, "ONLY, three words"), (31, "w1 w2"), (32, "nine " * 9)]
    docs = []
    for d in range(60):
        body = some(rng.choice([0, 3, 9, 10, 30, 200]))
        for _ in range(rng.choice([0, 1, 2])):
            passage = words(rng.choice(items)[1])
            cut = passage[rng.randrange(3):][:rng.choice([9, 10, 11, 60])]
            at = rng.randrange(len(body) + 1)
            body[at:at] = [c.upper() if c.isascii() else c for c in cut]
        docs.append((d, ", ".join(body)))
    docs += [(None, None), (None, items[0][1]), (7, "only three, words"), (7, "only three, words"),
             (99, "a\n" * 20000), (100, "")]
    return docs, items


@pytest.mark.parametrize("short", [False, True])
@pytest.mark.parametrize("gram", [5, 10, 1])
def test_matches_brute_force(spark, short, gram):
    docs, items = make(random.Random(gram), short)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as h", "2 as th")
    b = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as words")
    got = [(r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated)
           for r in contamination(d, b, gram=gram).collect()]
    assert sorted(got, key=str) == sorted(brute(docs, items), key=str)
    if gram == 5:
        kept = drop_contaminated(d, b)
        assert kept.columns == d.columns
        want = [x for x, r in zip(docs, brute(docs, items), strict=True) if not r[4]]
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "x")], "item_id long, text string")
    assert contamination(d.limit(0), b).count() == 0
    (row,) = contamination(d, b.limit(0)).collect()
    assert (row.n_words, row.n_hit, row.contaminated) == (11, 0, False)
    assert drop_contaminated(d, b.limit(0)).count() == 1
