import hashlib
import math
import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from harrow.llm import privacy as P

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
            r"\+[0-9][\x20().0-9-]+[0-9]"]


def luhn(d):
    ds = [int(c) for c in d][::-1]
    return (sum(ds[::2]) + sum(sum(divmod(2 * x, 10)) for x in ds[1::2])) % 10 == 0


def slow(text):
    out = []
    for k, pat in enumerate(PATTERNS):
        for m in re.finditer(pat, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = (True, all(int(p) <= 255 for p in m[0].split(".")) if k == 1 else True,
                  12 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15)[k]
            if ok:
                out.append((m.start(), k, m.end()))
    return sorted(out)


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="aZ0125.@-+ ()%é\n", max_size=60))
def test_patterns(text):
    assert P.base_spans(text) == slow(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4111 1111 1111 1111", "a.b@c.d", "@x.y", "a@b@c.d.e@f.g", " ",
                                 "1.2.3.4", "300.1.1.1", ".5", "+44 (20) 7946-0958", "00000255.1.1.1",
                                 "7", "é", "-"]), max_size=9))
def test_patterns_joined(parts):
    text = "".join(parts)
    assert P.base_spans(text) == slow(text)


def test_query_counts_every_kind(spark, tmp_path):
    """Counts by kind, wherever in the text's list of spans a span stands."""
    from harrow.llm.q_privacy import op3_pii
    texts = [None, "", "none here", "1.2.3.4 then 1.2.3.5 and 1.2.3.6",
             "4111 1111 1111 1111, a@b.cd", "+44 (20) 7946-0958 +44 (20) 7946-0959 x@y.zz 9.9.9.9"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(
        str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in op3_pii(spark, str(tmp_path)).collect()}
    for i, text in enumerate(texts):
        spans = slow(text or "")
        joined = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [got[i][f"n_{P.KINDS[k]}"] for k in range(4)] == [
            sum(s[1] == k for s in spans) for k in range(4)]
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()


def make():
    rng = random.Random(5)
    common = [f"word{i}" for i in range(50)]
    docs = []
    for i in range(120):
        body = [rng.choice(common) for _ in range(30)]
        if i % 10 == 0:
            body[12:12] = ["Agent", "«Falcon»,", "mail", "falcon@base.org", "now"]
        elif i % 10 == 1:
            body[5:5] = ["word1", f"user{i}@mail.net", "rare" + str(i)]
        docs.append((i, " ".join(body)))
    docs += [(500, None), (501, ""), (None, docs[0][1]), (3, docs[3][1]), (3, docs[3][1]),
             (502, "x" * 20000 + "@"), (503, "1" * 10000)]
    return docs


def test_very_long_runs_are_scanned_in_linear_time():
    """The plain patterns would take minutes for these; neither holds a span."""
    assert P.base_spans("x" * 200000 + "@") == P.base_spans("1" * 100000) == []
    assert P.base_spans("x" * 200000 + "@y.z") == [(0, 0, 200004)]


def brute(docs, near=P.NEAR, least=P.LEAST_TEXTS, z=1.96):
    scans = [(d, t or "", slow(t or "")) for d, t in docs]
    nt, nct, texts = {}, {}, {}
    for _, t, spans in scans:
        for w in {x[0] for w in re.findall(r"[^\x20\x09-\x0D]+", t) if (x := P._term(w))}:
            nt[w] = nt.get(w, 0) + 1
        for pair in {(c, w) for c, w, _, _ in P.near_terms(t, spans, near)}:
            nct[pair] = nct.get(pair, 0) + 1
            texts.setdefault(pair, set()).add(t)
    told = {}
    for (c, w), x in nct.items():
        k = len(texts[c, w])
        m = k * nt[w] / x
        low = (k + z * z / 2 - z * math.sqrt(k * (m - k) / m + z * z / 4)) / (m + z * z)
        if k >= least and -math.log2(low) <= P.GENERALISE_BITS:
            told[c, w] = 4 if -math.log2(low) <= P.REMOVE_BITS else 5
    out = []
    for d, t, spans in scans:
        more = {}
        for c, w, s, e in P.near_terms(t, spans, near):
            if (c, w) in told:
                more[s, e] = min(more.get((s, e), 9), told[c, w])
        out.append((d, sorted(spans + [(s, k, e) for (s, e), k in more.items()])))
    return out


def test_spans_and_text_match_brute_force(spark):
    docs = make()
    df = spark.createDataFrame(docs, "doc_id long, text string").select(
        "doc_id", "text", F.lit(1).alias("spans"), F.lit("t").alias("term"))
    got = [(r.doc_id, [tuple(s) for s in r.spans]) for r in P.find_spans(df).collect()]
    want = brute(docs)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(k == 4 for _, spans in want for _, k, _ in spans)
    clean = P.sanitise(df)
    assert clean.columns == df.columns
    by_text = sorted(((r.doc_id, r.text) for r in clean.collect()), key=str)
    spans = {(d, t): s for (d, t), (_, s) in zip(docs, want, strict=True)}
    expected = [(d, t if t is None else P.rewrite(t, [dict(zip(("start", "kind", "end"), s,
                 strict=True)) for s in spans[d, t]])) for d, t in docs]
    assert by_text == sorted(expected, key=str)
    first = next(t for d, t in by_text if d == 0)
    assert "falcon" not in first.lower() and "<EMAIL>" in first


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.find_spans(df).count() == 0 and P.sanitise(df).count() == 0


def planted(n_rows, texts=10):
    """``texts`` texts with one address, a word of its own and one that half of them have; the
    other rows are small talk that shares no word with them but "and"."""
    rng = random.Random(5)
    docs = [(i, f"note {rng.random()} Falconer and {'harbour' if i % 2 else 'quay'} write to jo@x.org "
                f"then {rng.choice(['go', 'stay'])}") for i in range(texts)]
    return docs + [(1000 + i, f"talk {i} and tea harbour") for i in range(n_rows - texts)]


def test_same_evidence_same_verdict_at_any_size(spark):
    """The rule asks for association, not rarity, and the size of the corpus is no part of it."""
    verdicts = []
    for n in (100, 10_000):
        df = spark.createDataFrame(planted(n), "doc_id long, text string").repartition(4)
        near = P.occurrences(scanned := P.scan(df), P.shared_entities(scanned))
        verdicts.append({(r.entity, r.term): (r.kind, round(r.bits, 9))
                         for r in P.disclosing(near, df).collect()})
    assert verdicts[0] == verdicts[1] and {t for _, t in verdicts[0]} >= {"falconer"}
    assert {k for (_, t), (k, _) in verdicts[0].items() if t == "falconer"} == {4}
    assert {k for (_, t), (k, _) in verdicts[0].items() if t == "quay"} == {5}
    assert not {"harbour", "and"} & {t for _, t in verdicts[0]}
    # The same counts as in a corpus of ten million rows: only the term's own rows matter.
    assert "n_t" in P.term_counts(df, df.selectExpr("'falconer' as term")).columns


def test_one_text_is_no_evidence(spark):
    docs = [(0, "please write to jane@x.org about the gardening umbrella and the teapot")]
    docs += [(i, f"some short note {i}") for i in range(1, 700)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    text = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    assert text[0] == "please write to <EMAIL> about the gardening umbrella and the teapot"


def test_long_lists_of_addresses_stay_linear(spark):
    """Pairs grow with the spans, not with spans times words."""
    people = " ".join(f"u{i}@x.org" for i in range(200))
    docs = [(i, " ".join(f"w{j}" for j in range(700)) + f" n{i} " + people) for i in range(3)]
    scanned = P.scan(spark.createDataFrame(docs, "doc_id long, text string"))
    sizes = [len(r.near) for r in P.occurrences(scanned, P.shared_entities(scanned)).collect()]
    assert max(sizes) <= 200 * 2 * P.NEAR


def test_rewriting_by_class_and_clashing_names(spark):
    docs = planted(60)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "'a' as spans", "doc_id", "text", "1 as th", "2 as near", "'t' as term", "3 as __text2")
    out = P.sanitise(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert "Falconer" not in got[0] and "<EMAIL>" in got[0] and "<WORD>" in got[0]
    assert got[1000] == docs[10][1]
    assert P.word_class("Quay") == "<NAME>" and P.word_class("r2d2") == "<NUMBER>"


def test_python_gets_few_texts_at_a_time(spark, tmp_path):
    """Whatever the session's batches are: large ones of long texts took the executors' memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    docs = spark.createDataFrame([(i, f"word{i} a{i % 4}@b.cd near") for i in range(40)],
                                 "doc_id long, text string")
    try:
        for step in (lambda: P.scan(docs), lambda: P.term_counts(docs, docs.selectExpr("'near' AS term"))):
            spark.conf.set(key, "10000")
            rows = step().collect()
            assert int(spark.conf.get(key)) <= 256
            assert len(rows) == 40 or rows[0].n_t == 40
    finally:
        spark.conf.set(key, before)


def test_scan_holds_the_terms_of_few_texts(monkeypatch):
    """What a scan finds leaves a task in pieces of bounded size, however many texts of a batch
    have many spans; no row is lost, doubled or moved, and the fields are those of the texts."""
    rng = random.Random(7)
    texts = [None, "", "no spans"] + [
        " ".join(f"word{rng.randrange(50)} " * 8 + f"a{i}.{j}@b.cd" for j in range(20)) for i in range(40)]
    texts += ["1.2.3.4 alone", "4111 1111 1111 1111 é beside a@b.cd"]
    rng.shuffle(texts)
    monkeypatch.setattr(P, "NEAR_TERMS", 1000)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "th": list(range(100, 100 + len(texts))),
                                        "text": pa.array(texts, pa.string())})
    pieces = list(P._scanned(batch, 64))
    most = max(len(P.near_terms(t or "", slow(t or ""), 64)) for t in texts)
    assert len(pieces) > 10
    assert all(sum(map(len, p.column("near").to_pylist())) < 1000 + most for p in pieces)
    got = [r for p in pieces for r in p.to_pylist()]
    assert [(r["doc_id"], r["th"]) for r in got] == [(i, 100 + i) for i in range(len(texts))]
    for r, text in zip(got, texts, strict=True):
        spans = slow(text or "")
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == spans
        assert r["entities"] == sorted({P.entity_of(text, s) for s in spans})
        assert [tuple(n.values()) for n in r["near"]] == P.near_terms(text or "", spans, 64)
