import importlib

import corpus_pipeline as cp
from harrow.llm import privacy as P
from tests.llm.test_privacy import brute as brute_spans
from tests.llm.test_privacy import planted
from tests.llm.test_quality import brute as measures
from tests.llm.test_quality import verdict
from tests.llm.test_simhash import groups_of
from tests.llm.test_winnow import brute as brute_hits

from harrow.llm.common import stored
from harrow.llm.simhash import fingerprint

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    given, want = docs, rows_of(docs)
    for name, stage in cp.STAGES:
        out = stored(stage(spark, given, SF), "test-stage")
        if name == "quality rules":
            want = [(i, t) for i, t in want if verdict(measures(t)) == 0]
        elif name == "simhash near-dedup":
            prints = {i: fingerprint(t) for i, t in want}
            group = groups_of(set(prints.values()))
            low = {}
            for i, p in prints.items():
                low[group[p]] = min(low.get(group[p], i), i)
            want = [(i, t) for i, t in want if low[group[prints[i]]] == i]
        elif name == "benchmark decontamination":
            bad = {r[0] for r in brute_hits(want, bench) if r[4]}
            want = [(i, t) for i, t in want if i not in bad]
        elif name == "pii":
            spans = dict(brute_spans(want))
            want = [(i, P.rewrite(t, [dict(start=s, kind=k, end=e) for s, k, e in spans[i]]))
                    for i, t in want]
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            kept = set(want)
            want = [x for x in rows_of(out) if x in kept]
            assert 0 < len(want) < len(kept)
        assert rows_of(out) == sorted(want, key=str), name
        assert out.columns[:len(docs.columns)] == docs.columns
        given = out
    assert cp.run(spark, SF).count() == len(want)


def test_privacy_stage_acts_on_evidence(spark):
    """The stage removes and generalises terms of a corpus that has such evidence."""
    docs = planted(400)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "doc_id", "text", "cast(length(text) as long) as n_chars", "'a' as term", "1 as spans")
    out = cp.privacy(spark, df, SF)
    spans = dict(brute_spans(docs))
    assert any(k == 4 for s in spans.values() for _, k, _ in s)
    want = [(i, P.rewrite(t, [dict(start=s, kind=k, end=e) for s, k, e in spans[i]])) for i, t in docs]
    assert rows_of(out) == sorted(want, key=str) and out.columns == df.columns
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_odd_rows_go_through_every_stage(spark):
    """Nulls in any column, empty, long and repeated texts, clashing names; and no rows."""
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(i, f"{' '.join(f'word{i}x{j}' for j in range(60))} end", "en", f"s{i % 3}", 400) for i in range(40)]
    rows += [(100, None, "en", "s1", 0), (101, "", None, None, None), (None, long + " tail", "en", None, 5),
             (102, long, None, "s2", 9), (103, long, "en", "s2", 9), (3, rows[3][1], "en", "s0", 400)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema).selectExpr("*", "'x' as fail_bits", "1 as component_id",
                                                               "2 as spans", "3 as th")
        for name, stage in cp.STAGES:
            docs = stored(stage(spark, docs, SF), "odd-stage")
            assert {"doc_id", "text", "fail_bits", "component_id", "spans", "th"} <= set(docs.columns), name
        got = docs.collect()
        assert all(r.text for r in got) and len({r.text for r in got}) == len(got)
        assert bool(got) == bool(given)


def test_every_operator_is_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(entry.oracle_sql()) <= names
