import random
import re

import numpy as np
import pytest
import xxhash

from harrow.llm.simhash import fingerprint, keep_one_per_group, links, simhash_components


def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c
                                                     for c in (text or "")))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def groups_of(prints, max_bits=3):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    todo = sorted(prints)
    for i, a in enumerate(todo):
        for b in todo[:i]:
            if bin(a ^ b).count("1") <= max_bits:
                root[find(a)] = find(b)
    return {p: find(p) for p in prints}


def make_docs():
    rng = random.Random(3)
    vocab = [f"w{i}É" for i in range(300)] + ["THE", "Of", "and"]
    docs = []
    for _ in range(60):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 40, 200]))]
        docs.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 2, 5])):
            near = list(base)
            near[rng.randrange(len(near))] = rng.choice(vocab)
            docs.append("\n".join(near))
    return docs + ["", None, " \t\n", docs[0], docs[0].lower(), "x " * 30000]


@pytest.mark.parametrize("bucket", [2048, 2])
def test_matches_brute_force(spark, bucket):
    rows = list(enumerate(make_docs()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.selectExpr("doc_id", "text", "1 as fp", "2 as key", "3 as component_id")
    got = {r.doc_id: r for r in simhash_components(df, bucket=bucket).collect()}
    prints = {i: slow_print(t) for i, t in rows}
    assert all(fingerprint(t) == prints[i] for i, t in rows)
    group = groups_of(set(prints.values()))
    low = {}
    for i, p in prints.items():
        low[group[p]] = min(low.get(group[p], i), i)
    assert len(got) == len(rows)
    for i, p in prints.items():
        assert got[i].fp % 2**64 == p
        assert got[i].component_id == low[group[p]]


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize("bucket", [2048, 3])
def test_links_of_dense_fingerprints(spark, max_bits, bucket):
    rng = np.random.default_rng(max_bits)
    base = rng.integers(0, 2**63, 12)
    prints = {int(b) ^ sum(1 << int(k) for k in rng.integers(0, 63, rng.integers(0, 5)))
              for b in base for _ in range(25)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = [(r.a, r.b) for r in links(df, max_bits, bucket).collect()]
    assert all(bin(a ^ b).count("1") <= max_bits for a, b in got)
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in got:
        root[find(a)] = find(b)
    want = groups_of(prints, max_bits)
    pairs = {}
    for p in prints:
        pairs.setdefault(want[p], set()).add(find(p))
    assert all(len(v) == 1 for v in pairs.values())
    assert len(pairs) == len({find(p) for p in prints})


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a b c d"), (None, "a b c d"), (5, "a b c d"), (5, "a b c d"),
            (7, "q r s t u v"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as __row")
    got = simhash_components(df).collect()
    assert len(got) == 6 and {r.component_id for r in got} == {5, 7, None}
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id or -1), r.text or "") for r in kept.collect()) == [
        (-1, ""), (5, "a b c d"), (7, "q r s t u v")]
    empty = df.limit(0)
    assert simhash_components(empty).count() == 0 and keep_one_per_group(empty).count() == 0
