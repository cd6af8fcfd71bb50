import random

import pytest
from pyspark.sql import functions as F

from harrow.llm.mixing import cells_of, draw, mix, probabilities, rake, sample_mix


def make(spark, n=600):
    rng = random.Random(10)
    rows = []
    for i in range(n):
        rows.append((i, " ".join(["w"] * rng.randrange(1, 60)) + rng.choice(["", " | x", "\n" * 7]),
                     rng.choice(["src0"] * 6 + ["src1", "src2", None]), rng.choice(["en", "en", "fr"])))
    rows += [(None, None, "src0", "en"), (7, "a a", "src1", None), (7, "a a", "src1", None),
             (900, "", "empty", "en"), (901, None, "src2", "fr"), (902, "long " * 30000, "src2", "fr")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"
                                       ).selectExpr("*", "1 as weight", "2 as __row", "3 as tokens")


def brute_rake(cells, targets, sweeps):
    dims = list(targets)
    share = {}
    for k, d in enumerate(dims):
        have = {c[k] for c, t in cells.items() if t > 0}
        has = {v: targets[d].get(v, 0.0) for c in cells for v in [c[k]]}
        tokens = {v: sum(t for c, t in cells.items() if c[k] == v) for v in has}
        total = sum(s for v, s in has.items() if tokens[v] > 0)
        share[d] = {v: s / total if total else 0 for v, s in has.items()}
        assert have
    mass = dict(cells)
    for _ in range(sweeps):
        for k, d in enumerate(dims):
            sums = {}
            for c, m in mass.items():
                sums[c[k]] = sums.get(c[k], 0) + m
            mass = {c: m * share[d][c[k]] / sums[c[k]] if sums[c[k]] > 0 else 0 for c, m in mass.items()}
    total = sum(cells.values())
    return {c: mass[c] * total / t if t > 0 else 0.0 for c, t in cells.items()}, share


def test_raking_matches_brute_force_and_targets(spark):
    rng = random.Random(11)
    cells = {(s, la): float(rng.randrange(1, 1000)) for s in "abcd" for la in ("x", "y", None)}
    cells["e", "x"] = 0.0
    goals = {"s": {"a": 1.0, "b": 2.0, "c": 1.0, "unseen": 9.0, "e": 1.0}, "l": {"x": 3.0, "y": 1.0, None: 1.0}}
    df = spark.createDataFrame([(*k, v) for k, v in cells.items()], "s string, l string, tokens double")
    frames = {d: spark.createDataFrame(list(g.items()), "value string, share double")
              for d, g in goals.items()}
    got = {(r.s, r.l): r for r in probabilities(rake(df, frames, 40)).collect()}
    want, share = brute_rake(cells, goals, 40)
    for c, w in want.items():
        assert got[c].weight == pytest.approx(w, rel=1e-9, abs=1e-12)
    assert max(r.probability for r in got.values()) == pytest.approx(1.0)
    total = sum(cells.values())
    for k, d in enumerate(("s", "l")):
        for v, s in share[d].items():
            mass = sum(cells[c] * got[c].weight for c in cells if c[k] == v) / total
            if v not in ("e",):
                assert mass == pytest.approx(s, abs=1e-6)
    few = probabilities(rake(df, frames, 40), budget=100.0)
    expected = few.agg(F.sum(F.col("probability") * F.col("tokens"))).first()[0]
    assert expected == pytest.approx(100.0)


def test_sample_is_the_rows_below_their_probability(spark):
    rows, df = make(spark)
    got = mix(df).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.probability <= 1 for r in got)
    assert {r.probability for r in got if r.source == "empty"} == {0.0}
    drawn = sorted((str(r.doc_id), r.source or "") for r in got if r.sampled)
    kept = sample_mix(df)
    assert kept.columns == [*df.columns, "mix_weight", "mix_probability"]
    assert sorted((str(r.doc_id), r.source or "") for r in kept.collect()) == drawn
    assert 0 < len(drawn) < len(rows)
    mean = spark.range(4000).select(F.avg(draw(F.col("id"), 3))).first()[0]
    assert abs(mean - 0.5) < 0.03


def test_empty(spark):
    _, df = make(spark, 5)
    assert mix(df.limit(0)).count() == 0 and sample_mix(df.limit(0)).count() == 0
    blank = df.where("text is null")
    assert {r.probability for r in mix(blank).collect()} == {0.0}
    assert cells_of(mix(df), ["lang"]).count() == 3
