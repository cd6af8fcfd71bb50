import random

import numpy as np
import pyarrow.parquet as pq
import pytest

from harrow.llm import suffixes as S


def brute(docs, length):
    """Repeated strings of all documents, in order of id (null last), text hash, place."""
    order = sorted(set(docs), key=lambda d: (d[0] is None, d[0] or 0, d[2]))
    seen, out = set(), {}
    for doc in order:
        raw = (doc[1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            s = raw[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            seen.add(s)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(raw), int(gone.sum()), runs,
                    bytes(b for b, g in zip(raw, gone, strict=True) if not g))
    return [(d[0], *out[d]) for d in docs]


def check(spark, docs, length, gram, hot=20000):
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "doc_id", "text", "1 as k", "2 as g", "3 as spans")
    hashed = [(r[0], r[1], r[2]) for r in df.selectExpr("doc_id", "text", "xxhash64(text)").collect()]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
           for r in S.remove_repeats(df, length, gram, hot).collect()]
    want = brute(hashed, length)
    assert sorted(got, key=str) == sorted(want, key=str)
    return want


def make(rng, long):
    letters = "abé "
    passages = ["".join(rng.choices(letters, k=rng.choice([long // 2, long, 2 * long, 5 * long])))
                for _ in range(8)]
    docs = []
    for i in range(50):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append("".join(rng.choices("wxyz é", k=rng.randrange(3 * long))))
            if rng.random() < 0.7:
                p = rng.choice(passages)
                parts.append(p[rng.randrange(5):len(p) - rng.randrange(5)])
        docs.append((i * 3 % 50, "".join(parts)))
    docs += [(60, docs[0][1]), (60, docs[0][1]), (61, docs[1][1] + "tail"), (None, docs[2][1]),
             (None, None), (62, ""), (63, None), (64, "a" * 700), (65, "ab" * 300 + "c"),
             (66, docs[3][1]), (66, docs[3][1] + "!" * long), (67, "é" * 500), (67, "é" * 500)]
    return docs


@pytest.mark.parametrize("length,gram,hot", [(100, 24, 20000), (20, 6, 20000), (20, 6, 3),
                                             (12, 1, 20000), (12, 12, 5)])
def test_matches_brute_force(spark, length, gram, hot):
    want = check(spark, make(random.Random(length + gram), length), length, gram, hot)
    assert sum(w[2] for w in want) > 0


@pytest.mark.parametrize("piece", [1, 37, 150])
def test_parts_of_long_texts(spark, monkeypatch, piece):
    find = S._find
    monkeypatch.setattr(S, "_find", lambda length, gram, most: find(length, gram, piece))
    check(spark, make(random.Random(piece), 20)[:30] + [(70, "é" * 200)], 20, 6)


def test_table(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    want = check(spark, list(zip(t["doc_id"], t["text"], strict=True))[:120], 100, 24)
    assert sum(w[2] for w in want) > 0


def test_sort_orders_and_prefixes():
    rng = random.Random(9)
    words = ["".join(rng.choices("ab", k=rng.randrange(12))).encode() for _ in range(500)]
    group = np.sort(np.array([rng.randrange(20) for _ in words]))
    size = np.array([len(w) for w in words])
    data = np.frombuffer(b"".join(words), np.uint8)
    order, common = S.suffix_sort(data, np.cumsum(size) - size, size, group)
    assert [(group[i], words[i]) for i in order] == sorted(zip(group, words, strict=True))
    for x, y, n in zip(order[:-1], order[1:], common[1:], strict=True):
        a, b = words[x], words[y]
        ext = next((i for i, (p, q) in enumerate(zip(a, b, strict=False)) if p != q),
                   min(len(a), len(b)))
        assert n == (ext if group[x] == group[y] else -1)


def test_collisions_are_found(monkeypatch):
    monkeypatch.setattr(S.PrefixHash, "of", lambda self, start, size: np.zeros(len(start), np.uint64))
    words = [b"bb", b"ab", b"aa", b"b", b"ab"]
    size = np.array([len(w) for w in words])
    order, common = S.suffix_sort(np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size,
                                  size, np.zeros(5, int))
    assert [words[i] for i in order] == sorted(words) and list(common) == [-1, 1, 2, 0, 1]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.remove_repeats(df).count() == 0
