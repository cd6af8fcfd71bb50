import random
import re
from collections import Counter

from harrow.llm.quality import (BIT, MEASURES, POLICIES, ablations, apply_policy, filter_quality,
                                measure_text, quality_ledger)


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = Counter(zip(w, w[1:], w[2:], strict=False))
    rep = {i + j for i in range(len(w) - 2) if wins[w[i], w[i + 1], w[i + 2]] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(rep), len(lines), text.count("!"))


def verdict(m):
    n, chars, sym, dup, rep, lines, bang = m
    fails = [n < 50, 100 * rep > 50 * n, 100 * sym > 20 * n, 100 * dup > 50 * lines,
             100 * bang > 40 * n, chars < 2 * n or chars > 20 * n]
    return sum(1 << i for i, f in enumerate(fails) if f)


def make():
    rng = random.Random(8)
    vocab = ["a", "b", "cé", "the x", "w!", "$$$", "|", "word", "other", "#", "long" * 9]
    docs = [(i, rng.choice([" ", "\n", "  \t", "\x0b"]).join(
        rng.choices(vocab, k=rng.choice([0, 2, 5, 60, 300])))) for i in range(150)]
    docs += [(i + 200, " ".join(f"plain{rng.randrange(10**6)}" for _ in range(80))) for i in range(20)]
    return docs + [(None, None), (None, "x y z"), (3, docs[3][1]), (999, "same line\n" * 4000),
                   (998, "\x85   \x1c")]


def test_ledger_and_policies(spark):
    docs = make()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "*", "1 as n_words", "2 as __m", "3 as fail_bits")
    ledger = quality_ledger(df)
    got = sorted((tuple(r) for r in ledger.collect()), key=str)
    want = sorted(((i, *brute(t), verdict(brute(t))) for i, t in docs), key=str)
    assert got == want
    assert all(measure_text(t) == brute(t) for _, t in docs)
    for policy, names in POLICIES.items():
        mask = sum(BIT[n] for n in names)
        rows = apply_policy(ledger, policy).collect()
        assert all(r.kept == (r.fail_bits & (mask | 3) == 0) for r in rows)
        assert all(r.base_failed == (r.fail_bits & 3 != 0) for r in rows)
        kept = filter_quality(df, policy)
        assert kept.columns == df.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
            ((i, t) for i, t in docs if verdict(brute(t)) & (mask | 3) == 0), key=str)
    bits = [verdict(brute(t)) for _, t in docs]
    for r in ablations(ledger, "v2").collect():
        assert r.n_failed == sum(b & r.bit != 0 for b in bits)
        assert r.n_only == sum(b == r.bit for b in bits)
        others = 0
        for b in bits:
            others |= b if b & r.bit else 0
        assert r.seen_with == others & ~r.bit


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert quality_ledger(df).count() == 0 and filter_quality(df).count() == 0
    assert ablations(quality_ledger(df)).count() == 0
    assert len(MEASURES) == 7
