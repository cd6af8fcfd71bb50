"""Golden arithmetic and properties on small hand-made frames."""

import datetime as dt
import io
import math
import wave
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harrow.functions import columns as C
from harrow.operators import evaluate as E
from harrow.operators import profile as A
from harrow.operators import rank as W
from harrow.operators import sampling as SA
from harrow.operators import signal as G


def _confusion_rows(tn, fp, fn, tp):
    return [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp


def test_confusion_golden(spark):
    df = spark.createDataFrame(_confusion_rows(2608, 645, 183, 215), "y_true int, y_pred int")
    r = E.classification_metrics(df, y_score=None).first()
    assert round(r["accuracy"], 4) == 0.7732
    assert round(r["f1_macro"], 4) == 0.6024
    c = E.confusion_matrix(df).first()
    assert round(c["recall"], 3) == 0.540 and round(c["precision"], 3) == 0.250


def test_all_negative_predictions(spark):
    df = spark.createDataFrame(_confusion_rows(3253, 0, 398, 0), "y_true int, y_pred int")
    r = E.classification_metrics(df, y_score=None).first()
    assert round(r["accuracy"], 4) == 0.8910
    assert round(r["f1_macro"], 4) == 0.4712


def test_single_label_group_scores_one(spark):
    df = spark.createDataFrame([("g", 0, 0)] * 5, "g string, y_true int, y_pred int")
    r = E.metrics_by_group(df, "y_true", "y_pred", "g").first()
    assert r["f1_macro"] == 1.0 and r["n_samples"] == 5


def test_auc_ties_and_monotone(spark):
    rows = [(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1), (1, 0.5), (0, 0.7)]
    df = spark.createDataFrame(rows, "y_true int, y_score double")
    auc = E.roc_auc(df).first()["roc_auc"]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(auc - brute) < 1e-12
    flipped = E.roc_auc(df.withColumn("y_score", -F.col("y_score"))).first()["roc_auc"]
    assert abs(flipped - (1 - auc)) < 1e-12
    cubed = E.roc_auc(df.withColumn("y_score", F.pow("y_score", 3))).first()["roc_auc"]
    assert abs(cubed - auc) < 1e-12


def test_median_even_and_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,), (None,)], "x double")
    assert W.median_map(df, ["x"])["x"] == 3.0
    from harrow.ml.features import fit_numeric_stats
    s = fit_numeric_stats(df.filter("x is not null"), ["x"])["x"]
    assert abs(s["scale"] - 2.680951510) < 1e-6


def test_mode_tie_goes_to_smallest(spark):
    from harrow.ml.features import fit_modes
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert fit_modes(df, ["c"])["c"] == "a"


def test_null_rules(spark):
    df = spark.createDataFrame([(None,), ("other",), ("rare",), ("common",), ("common",)],
                               "g string")
    out = A.keep_frequent_categories(df, "g", 2, "other", out="canon")
    got = sorted(r["canon"] for r in out.collect())
    assert got == ["common", "common", "other", "other", "other"]


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_split_exact_at_any_partition_count(spark, parts):
    rows = [(i, 1 if i % 3 == 0 else 0, "2000-01-01" if i < 60 else "2000-02-01")
            for i in range(100)]
    df = spark.createDataFrame(rows, "k long, hit int, d string").withColumn(
        "t", F.to_timestamp("d")).repartition(parts)
    out = W.temporal_split(df, "t", ["k"], 0.2)
    test_keys = sorted(r["k"] for r in out.filter("is_test = 1").collect())
    assert test_keys == list(range(80, 100))
    m = out.groupBy("is_test").agg(F.max("t").alias("mx"), F.min("t").alias("mn")).collect()
    by = {r["is_test"]: r for r in m}
    assert by[0]["mx"] <= by[1]["mn"]


def test_folds_balanced_per_class(spark):
    df = spark.createDataFrame([(i, i % 4 == 0) for i in range(203)], "k long, y boolean") \
        .withColumn("y", F.col("y").cast("int"))
    out = SA.stratified_folds(df, "y", "k", 5)
    sizes = out.groupBy("y", "fold").count().collect()
    for y in (0, 1):
        s = [r["count"] for r in sizes if r["y"] == y]
        assert max(s) - min(s) <= 1


def test_matching_no_reuse_and_rate(spark):
    rows = []
    for i in range(200):
        year = 2000 + (i % 4) if i % 17 else None
        rows.append((i, 1 if i % 5 == 0 else 0, year, "g%d" % (i % 3)))
    df = spark.createDataFrame(rows, "k long, hit int, y int, g string").withColumn(
        "t", F.make_timestamp(F.col("y"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    sample, report = SA.case_control_match(df, "hit", "t", "g", "k")
    r = report.first()
    assert r["positive_rate"] == 0.5
    keys = [x["k"] for x in sample.collect()]
    assert len(keys) == len(set(keys)) == r["rows_out"]
    assert r["hits_unmatched"] + r["matched_year_and_genre"] + r["matched_year_only"] == \
        r["hits_available"]


def test_smote_invariants(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.normal(size=3)], 1 if i < 12 else 0) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, f array<double>, y int")
    out = SA.smote(df, "y", "f", "k", k=5)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[0] == counts[1] == 48
    assert out.filter("synthetic = 0").count() == 60
    minority = np.array([r[1] for r in rows if r[2] == 1])
    for r in out.filter("synthetic = 1").collect():
        x = np.array(r["f"])
        # On a segment between two minority rows: some pair is collinear with x.
        ok = False
        for a in minority:
            for b in minority:
                d = b - a
                if np.allclose(d, 0):
                    continue
                u = np.dot(x - a, d) / np.dot(d, d)
                if -1e-9 <= u <= 1 + 1e-9 and np.allclose(a + u * d, x, atol=1e-9):
                    ok = True
                    break
            if ok:
                break
        assert ok


def test_histogram_counts_sum_and_edges(spark):
    vals = [0.0, 0.1, 0.2, 0.3, 1.0, 0.5, None]
    df = spark.createDataFrame([(v, i % 2) for i, v in enumerate(vals)], "x double, hit int")
    h = A.feature_distribution(df, "x", "hit", 5).orderBy("bin").collect()
    assert sum(r["hit_count"] + r["flop_count"] for r in h) == 6
    counts, _ = np.histogram([v for v in vals if v is not None], bins=5)
    assert [r["hit_count"] + r["flop_count"] for r in h] == list(counts)


def test_constant_column_widens(spark):
    df = spark.createDataFrame([(2.0, 0)] * 4, "x double, hit int")
    h = A.feature_distribution(df, "x", "hit", 5).collect()
    assert abs(min(r["bin_lo"] for r in h) - 1.5) < 1e-12
    assert abs(max(r["bin_hi"] for r in h) - 2.5) < 1e-12


def test_calibration_edges_go_low(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (0, 0.2), (1, 0.3), (1, 1.0)],
                               "y_true int, y_score double")
    t = E.calibration_table(df, "y_true", "y_score", None, 10).orderBy("bin").collect()
    assert [r["bin"] for r in t] == [0, 1, 2, 9]


def test_clean_is_idempotent(spark):
    rows = [("2000-01-05", 1), ("01/07/2000", 2), ("n/a", 3), ("2030-01-01", 4),
            ("2000-01-05", 1)]
    df = spark.createDataFrame(rows, "first_week string, v int")
    once = C  # noqa: F841
    from harrow.operators.clean import clean, cleaning_report
    a = clean(df, "first_week", "2020-01-01", ("yyyy-MM-dd", "MM/dd/yyyy"))
    assert a.count() == 2
    r = cleaning_report(df, "first_week", "2020-01-01", ("yyyy-MM-dd", "MM/dd/yyyy")).first()
    assert (r["rows_in"], r["duplicates_dropped"], r["unparseable_dates_dropped"],
            r["future_dates_dropped"], r["rows_out"]) == (5, 1, 1, 1, 2)
    b = clean(a.withColumn("first_week", F.date_format("first_week", "yyyy-MM-dd")),
              "first_week", "2020-01-01", ("yyyy-MM-dd",))
    assert b.count() == 2


def _tone(freq, sr=22050, secs=0.5):
    t = np.arange(int(sr * secs)) / sr
    y = (0.5 * np.sin(2 * math.pi * freq * t) * 32767).astype(np.int16)
    buf = io.BytesIO()
    with wave.open(buf, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(sr)
        w.writeframes(y.tobytes())
    return buf.getvalue()


def test_audio_library_and_signal_features(spark, tmp_path):
    from harrow.sources.io import read_audio_library
    for label, freq in (("hit", 440.0), ("not_hit", 1000.0)):
        d = tmp_path / label
        d.mkdir()
        (d / f"tone_{int(freq)}.wav").write_bytes(_tone(freq))
        (d / "notes.txt").write_text("ignored")
    files, counts = read_audio_library(spark, str(tmp_path))
    c = counts.first()
    assert (c["hit"], c["not_hit"], c["ready"]) == (1, 1, 1)
    dec = G.decode_wav_column(files.select("path", "label", "content"))
    got = {r["label"]: r for r in G.time_domain_features(dec, "samples").collect()}
    assert abs(got[0]["zcr"] - 2 * 1000 / 22050) < 0.01
    assert 0.3 < got[1]["energy"] < 0.4
    assert got[0]["audio_warning"] is None


def test_undecodable_files_give_a_reason(spark):
    other = io.BytesIO()
    with wave.open(other, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(3)
        w.setframerate(22050)
        w.writeframes(b"\0" * 300)
    rows = [(1, bytearray(_tone(440.0, 44100))), (2, bytearray(other.getvalue())),
            (3, bytearray(b"no sound")), (4, None), (5, bytearray(_tone(440.0)))]
    df = G.decode_wav_column(spark.createDataFrame(rows, "k int, content binary"))
    got = {r.k: r for r in df.collect()}
    assert "44100" in got[1].audio_warning and "24-bit" in got[2].audio_warning
    assert "WAV" in got[3].audio_warning and got[4].audio_warning == "no content"
    assert all(got[k].samples is None for k in (1, 2, 3, 4)) and got[5].samples
    from harrow.ml.bundle import train_from_signals
    bad = df.withColumn("hit", F.col("k") % 2)
    with pytest.raises(ValueError, match="4 files"):
        train_from_signals(bad, "samples", "k", "hit", "/nowhere")


def test_unseen_category_is_all_zeros(spark):
    from harrow.ml.features import feature_names, fit_preprocessor
    train = spark.createDataFrame([("a", 1.0), ("b", float("nan")), ("c", 3.0), (None, None)],
                                  "g string, x double")
    train = train.withColumn("none", F.lit(None).cast("double"))
    model = fit_preprocessor(train, ["x", "none"], ["g"])
    names = feature_names(model, ["x", "none"], ["g"])
    assert names == ["x", "g_a", "g_b", "g_c"]
    test = spark.createDataFrame([("zzz", 2.0), ("b", float("nan"))], "g string, x double")
    rows = [list(r.features.toArray()) for r in
            model.transform(test.withColumn("none", F.lit(1.0))).collect()]
    assert rows[0][1:] == [0, 0, 0] and rows[1][1:] == [0, 1, 0]
    assert rows[0][0] == rows[1][0] == 0.0     # median and mean of 1 and 3 are 2


def test_importance_names_must_match(spark):
    from types import SimpleNamespace

    from harrow.ml.models import feature_importance
    clf = SimpleNamespace(coefficients=SimpleNamespace(toArray=lambda: np.array([1.0, -2.0])))
    model = SimpleNamespace(clf=clf)
    assert feature_importance(model, ["a", "b"]) == [("a", 1.0), ("b", 2.0)]
    with pytest.raises(ValueError, match="2 slots but 1 names"):
        feature_importance(model, ["a"])


def test_pr_curve_keeps_every_threshold(spark):
    rows = [(0, .1), (0, .4), (1, .35), (1, .8)]
    got = E.pr_curve(spark.createDataFrame(rows, "y_true int, y_score double")).orderBy("position")
    assert [(r.threshold, round(r.precision, 6), r.recall) for r in got.collect()] == [
        (.1, .5, 1.0), (.35, .666667, 1.0), (.4, .5, .5), (.8, 1.0, .5), (None, 1.0, 0.0)]


def test_nan_is_missing_everywhere(spark):
    from harrow.ml.features import fit_numeric_stats
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0, 1), (nan, 9.0, 0), (3.0, 6.0, 0), (2.0, 4.0, 1), (5.0, nan, 1)],
                               "a double, b double, hit int")
    s = fit_numeric_stats(df, ["a"])["a"]
    assert s["median"] == 2.5 and s["mean"] == pytest.approx(2.7) and s["scale"] > 0
    r = {(x.a, x.b): x.r for x in A.correlations(df, ["a", "b"]).collect()}
    assert r["a", "b"] == pytest.approx(1.0)
    p = A.feature_profile(df, ["a"]).first()
    assert (p.lo, p.hi, p.median) == (1.0, 5.0, 2.5)


def test_smote_needs_more_rows_than_neighbours(spark):
    df = spark.createDataFrame([(i, [float(i)], int(i < 3)) for i in range(20)],
                               "k long, f array<double>, y int")
    with pytest.raises(ValueError, match="5 neighbours"):
        SA.smote(df, "y", "f", "k", k=5)


def test_median_outside_its_bracket(spark, monkeypatch):
    from harrow.operators import rank as W
    df = spark.range(1, 1001).selectExpr("cast(id as double) x", "cast(id % 3 as double) y",
                                         "cast(null as double) z")
    want = {"x": 500.5, "y": 1.0}
    for bracket in ((0.49, 0.51), (0.9, 0.95), (0.0, 0.0)):
        monkeypatch.setattr(W, "_BRACKET", bracket)
        got = {r.feature: r.median for r in W.exact_medians(df, ["x", "y", "z"]).collect()}
        assert got == want


def test_shared_folder_is_required_off_one_machine():
    from harrow.session import checkpoint_dir

    class Fake:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Fake)


def test_extract_id_shapes(spark):
    rows = [("https://open.spotify.com/track/abcDEF123?si=x",), ("spotify:track:XYZ",),
            ("A" * 22,), ("nope",), ("",)]
    df = spark.createDataFrame(rows, "v string")
    ident, reason = C.extract_id("v")
    got = [(r[0], r[1]) for r in df.select(ident, reason).collect()]
    assert got == [("abcDEF123", None), ("XYZ", None), ("A" * 22, None), (None, "invalid"),
                   (None, "empty")]


@pytest.mark.parametrize("block_rows,clusters", [(7, 1), (5, 6), (1000, 1), (1, 3)])
def test_minority_neighbours_match_brute_force(spark, block_rows, clusters):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(40, 4)) + 50 * rng.integers(0, clusters, size=(40, 1))
    pts[10] = pts[11]
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)],
                               "k long, f array<double>")
    nn = SA.minority_neighbours(df, "f", "k", k=3, block_rows=block_rows)
    got = {}
    for r in nn.collect():
        got.setdefault(r["k"], []).append((r["nn_rank"], r["neighbour"]))
    d = ((pts[:, None, :] - pts[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    for i in range(len(pts)):
        want = list(np.argsort(d[i], kind="stable")[:3])
        assert [n for _, n in sorted(got[i])] == want
    assert SA.minority_neighbours(df.limit(0), "f", "k").count() == 0


def test_smote_cells_grow_with_the_rows(spark, monkeypatch):
    """Beyond so many rows a cell there are more cells, and groups of cells lose none."""
    made = []

    class Noted(SA.CellIndex):
        def __init__(self, sample, cells):
            made.append(self)
            super().__init__(sample, cells, 2)

    monkeypatch.setattr(SA, "CellIndex", Noted)
    monkeypatch.setattr(SA, "SMOTE_CELL_ROWS", 10)
    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(size=(700, 2)), np.eye(3)[rng.integers(0, 3, 700)]], axis=1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, f array<double>")
    nn = SA.minority_neighbours(df, "f", "k", k=3, block_rows=64, cells=4)
    got = {(r["k"], r["nn_rank"]): r["neighbour"] for r in nn.collect()}
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    best = np.argsort(d, axis=1, kind="stable")[:, :3]
    assert got == {(i, j): best[i, j] for i in range(700) for j in range(3)}
    index, bound = made[0], np.sort(d, axis=1)[:, 2]
    assert 40 <= index.leaves <= 70
    assert list(zip(*index.reached(x, bound))) == list(zip(*np.nonzero(index.reach(x, bound))))


@pytest.mark.parametrize("name", ["e13_holdout_integrity", "sa01_matched_sample"])
def test_labelled_tracks_are_computed_once(spark, monkeypatch, name):
    from harrow.plans import fixtures as FX
    from harrow.plans import queries_more as Q
    seen, n = spark.sparkContext.accumulator(0), 400
    rows = [(i, int(i % 5 == 0), dt.datetime(2000 + i % 3, 1, 1 + i % 28), float(i % 17), float(i * 37 % 101),
             "abc"[i % 3], "xyz"[i % 3]) for i in range(n)]
    tracks = spark.createDataFrame(rows, "track_key long, hit int, first_week timestamp, tempo double, "
                                   "acctbal double, segment string, genre string")

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    monkeypatch.setattr(FX, "labelled_tracks", lambda *_: tracks.mapInPandas(count, tracks.schema))
    getattr(Q, name)(spark, "").collect()
    assert seen.value == n


def test_minority_neighbours_by_signature(spark):
    """Exact on one-hot data, and by far fewer comparisons than all pairs."""
    rng = np.random.default_rng(5)
    n = 8000
    x = np.zeros((n, 35))
    x[:, :3] = rng.normal(size=(n, 3))
    for start, size in ((3, 5), (8, 25), (33, 2)):
        x[np.arange(n), start + rng.integers(0, size, n)] = 1.0
    index = SA.CellIndex(x[rng.permutation(n)[:4000]])
    at = index.place(x)
    index.boxed({c: ((at == c).sum(), x[at == c].min(axis=0), x[at == c].max(axis=0))
                 for c in np.unique(at)}, 512)
    home = index.first[at]
    d = (x ** 2).sum(axis=1)[:, None] + (x ** 2).sum(axis=1)[None, :] - 2 * x @ x.T
    np.fill_diagonal(d, np.inf)
    bound = np.array([np.partition(d[i][home == home[i]], 4)[4] for i in range(n)])
    reach = index.reach(x, bound)
    # Own block first, then the rows of every cell within the bound.
    visited = (home[:, None] == home[None, :]).sum() + (reach * index.sizes[None, :]).sum()
    assert visited / n ** 2 < 0.2
    near = np.argsort(d, axis=1, kind="stable")[:, :5]
    assert reach[np.arange(n)[:, None], at[near]].all()
    few = 600
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x[:few])],
                               "k long, f array<double>")
    nn = SA.minority_neighbours(df, "f", "k", k=5, block_rows=64, cells=64)
    got = {(r["k"], r["nn_rank"]): r["neighbour"] for r in nn.collect()}
    exact = ((x[:few, None, :] - x[None, :few, :]) ** 2).sum(axis=2)
    np.fill_diagonal(exact, np.inf)
    want = np.lexsort((np.broadcast_to(np.arange(few), exact.shape), exact), axis=1)[:, :5]
    assert all(got[i, r] == want[i, r] for i in range(few) for r in range(5))


def test_selection_of_the_kth(spark):
    """Any place, with heavy ties and nulls, however few rows a round may read."""
    rng = np.random.default_rng(2)
    values = [None if i % 50 == 0 else int(v) for i, v in enumerate(rng.integers(0, 40, 3000))]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i long").repartition(5)
    order = df.select(F.struct(F.col("v").isNull().cast("int").alias("p0"), F.col("v").alias("p1"),
                               F.col("i").alias("p2")).alias("o"))
    ranked = sorted((v is None, v or 0, i) for i, v in enumerate(values))
    for k in (1, 2, 777, 1500, 2999, 3000):
        (null, v, i), below, equal = W.select_kth(order, k, rows=64)
        assert (bool(null), v or 0, i) == ranked[k - 1] and (below, equal) == (k - 1, 1)
    coarse = df.select(F.struct(F.lit(0).alias("p0"), (F.col("i") % 3).alias("p1")).alias("o"))
    assert W.select_kth(coarse, 1500, rows=16) == ((0, 1), 1000, 1000)


def test_split_without_exchange_and_with_ties(spark):
    rows = [(i % 4, None if i % 9 == 0 else i % 5, i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, other long")
    out = W.temporal_split(df, "t", ["k"], 0.3)
    got = out.collect()
    assert sum(1 - r["is_test"] for r in got) == 350
    last = max((r["t"] is None, r["t"] or 0, r["k"]) for r in got if not r["is_test"])
    assert all((r["t"] is None, r["t"] or 0, r["k"]) >= last for r in got if r["is_test"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    same = spark.createDataFrame([(1, 1)] * 10, "k int, t int")
    assert W.temporal_split(same, "t", ["k"], 0.2).agg(F.sum("is_test")).first()[0] == 0


def _planted(n, seed):
    """Rows whose label follows one number and one category."""
    rng = np.random.default_rng(seed)
    v, c = rng.normal(size=n), rng.integers(0, 4, n)
    y = ((v + 1.5 * (c == 2) + 0.3 * rng.normal(size=n)) > 0.5).astype(int)
    return [(i, float(v[i]), float(rng.normal()), "abcd"[c[i]], int(y[i]), i % 2) for i in range(n)]


PLANTED = "k long, v double, noise double, c string, hit int, fold int"


@pytest.mark.parametrize("family,params", [
    ("logistic_regression", {"C": 1.0}),
    ("random_forest", {"numTrees": 30, "minInstancesPerNode": 2, "maxDepth": 12}),
    ("boosted_trees", {"maxIter": 40, "stepSize": 0.2, "maxDepth": 3})])
@pytest.mark.parametrize("strategy", ["none", "balanced", "smote"])
def test_families_learn_a_planted_signal(spark, tmp_path, family, params, strategy):
    from harrow.ml import models as M
    from harrow.ml.features import feature_names
    from pyspark.ml import PipelineModel
    train = spark.createDataFrame(_planted(1200, 1), PLANTED)
    test = spark.createDataFrame(_planted(800, 2), PLANTED)
    model = M.fit_pipeline(train, ["v", "noise"], ["c"], "hit", "k", family, strategy, params)
    scored = model.score(test).select("k", F.col("hit").alias("y_true"), F.col("predicted_hit").alias("y_pred"),
                                      F.col("hit_potential").alias("y_score"))
    m = E.classification_metrics(scored).first()
    major = max(r["n"] for r in test.groupBy("hit").agg(F.count("*").alias("n")).collect()) / 800
    assert m["accuracy"] > major + 0.2 and m["roc_auc"] > 0.95
    ranked = M.feature_importance(model, feature_names(model.pre, ["v", "noise"], ["c"]), 6)
    assert {ranked[-1][0], ranked[-2][0]} == {"v", "c_c"}
    path = str(tmp_path / "m")
    model.pipeline().save(path)
    again = PipelineModel.load(path).transform(test).select("k", M.probability_of_positive(test).alias("p"))
    gap = scored.join(again, "k").agg(F.max(F.abs(F.col("y_score") - F.col("p")))).first()[0]
    assert gap < 1e-9


def test_stages_and_parts_of_tree_fits(spark):
    """A fit's first rounds or trees are the fit of that many; rows beyond a part make more
    parts, and the layout of the rows changes nothing."""
    from harrow.ml import boost, forest
    from harrow.ml import models as M
    ready = M.prepare(spark.createDataFrame(_planted(900, 3), PLANTED), ["v", "noise"], ["c"], "hit", "k")["none"]
    few, many = boost.Setting(3, 0.2, 5), boost.Setting(3, 0.2, 12)
    both = boost.fit_grid(ready.x, [few, many], "k")
    alone = boost.fit_grid(ready.x.repartition(7), [few], "k")
    assert np.allclose(both[few][0].value, alone[few][0].value) and len(both[many][0].value) == 12
    assert np.array_equal(both[few][0].feature, both[many][0].feature[:5])
    assert len(boost.fit_grid(ready.x, [few], "k", part_rows=250)[few]) == 4
    small, large = forest.Setting(6, 1, 4), forest.Setting(6, 1, 60)
    grown = forest.fit_grid(ready.x, [small, large], "k")
    again = forest.fit_grid(ready.x.repartition(5), [small], "k", part_rows=100_000)
    assert [len(grown[s]) for s in (small, large)] == [4, 60]
    assert all(np.allclose(a.value, b.value) for a, b in zip(grown[small], again[small], strict=True))
    assert len(forest.fit_grid(ready.x, [small], "k", part_rows=300)[small]) == 4
    scored = forest.probabilities(ready.x, [grown[small], grown[large]]).collect()
    x = np.array([r["features"].toArray() for r in scored])
    want = np.array([[np.mean([t.score(x[i:i + 1])[0] for t in grown[s]]) for s in (small, large)]
                     for i in range(50)])
    assert np.allclose([r["p"] for r in scored[:50]], want)


def test_forest_trees_are_packed():
    """A packed tree scores as the grown one, in a few bytes a node; an old model still loads."""
    import json

    from harrow.ml import forest
    rng = np.random.default_rng(7)
    x, y = np.round(rng.normal(size=(4000, 6)), 2), (rng.random(4000) < 0.3).astype(float)
    edges = [np.quantile(c, np.arange(1, 40) / 40) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    trees = [forest._grow(codes.astype(np.uint8), np.arange(4000), y, np.ones(4000), edges, s, 0, 42)
             for s in (forest.Setting(30, 1, 1), forest.Setting(0, 1, 1), forest.Setting(3, 5, 1))]
    packed = [forest.Packed.of(t) for t in trees]
    for t, p in zip(trees, packed, strict=True):
        node = np.zeros(len(x), int)
        while (going := t.child[node] > 0).any():
            at = node[going]
            node[going] = t.child[at] + (x[going, t.feature[at]] > t.threshold[at])
        assert np.array_equal(p.score(x), t.value[node]) and len(t.score(x[:0])) == 0
        assert np.allclose(p.importance(6), np.bincount(t.feature, t.gain, 6))
    assert len(trees[0].child) > 1000 and len(packed[0].data) < 10 * len(trees[0].child)
    model = forest.ForestModel(packed, width=6)
    assert model.fitted() == packed
    old = forest.ForestModel(packed, width=6)._set(trees=json.dumps(
        {"width": 6, "trees": [[a.tolist() for a in t] for t in trees]}))
    assert old.fitted() == packed and old.featureImportances == model.featureImportances


def test_tree_splits_against_brute_force():
    """The first split of both growers is the best one over all cuts."""
    from harrow.ml import boost, forest
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 3)), 1)
    y = (x[:, 1] + 0.2 * rng.normal(size=300) > 0.3).astype(float)
    edges = [np.unique(np.append(c, 0.0))[:-1] for c in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    tree = forest._grow(codes.astype(np.uint8), np.arange(300), y, np.ones(300), edges,
                        forest.Setting(1, 1, 1), 0, 42)
    count = np.searchsorted(np.cumsum(np.exp(-1) / np.array([1, 1, 2, 6, 24, 120, 720])),
                            boost._mix(np.arange(300), 2 * 42 * 1_000_003 + 1))

    def gini(mask):
        n, p = count[mask].sum(), (count * y)[mask].sum()
        return (p ** 2 + (n - p) ** 2) / n if n else 0.0
    f = tree.feature[0]
    best = max(edges[f], key=lambda e: gini(x[:, f] <= e) + gini(x[:, f] > e))
    assert tree.threshold[0] == best and len(tree.child) == 3
    pdf = pd.DataFrame({"k": np.arange(300), "label": y, "weight": 1.0,
                        "i": [np.flatnonzero(r) for r in x], "v": [r[r != 0] for r in x]})
    data, bins = boost._Rows(pdf, edges), boost._Bins(edges)
    g = boost._Grower(data, bins, boost.Setting(1, 1.0, 1), 0.0, 42)
    g.start(0)
    g.grow(0)
    def score(mask):
        return g.g[mask].sum() ** 2 / (g.h[mask].sum() + 1.0) if g.h[mask].sum() >= 1 else -np.inf
    cuts = [(score(x[:, c] <= e) + score(x[:, c] > e), c, e) for c in range(3) if g.columns[c] for e in edges[c]]
    top = max(cuts)
    assert (g.split[0][0][0], g.split[1][0][0]) == top[1:]


def test_metrics_per_group_match_one_at_a_time(spark):
    rng = np.random.default_rng(6)
    rows = [("abc"[i % 3], i % 2, int(rng.integers(0, 2)) if i % 3 else 1, int(rng.integers(0, 2)),
             float(np.round(rng.random(), 1))) for i in range(300)] + [("d", 0, 1, 1, None)]
    df = spark.createDataFrame(rows, "m string, f int, y_true int, y_pred int, y_score double")
    got = {(r["m"], r["f"]): r for r in E.metrics_per(df, ["m", "f"]).collect()}
    assert len(got) == 7
    for (m, f), r in got.items():
        one = E.classification_metrics(df.where((F.col("m") == m) & (F.col("f") == f))).first()
        assert all(r[c] is None and one[c] is None or abs(r[c] - one[c]) < 1e-9 for c in one.asDict())


def test_side_by_side_cancels_what_is_left(spark):
    import time

    from harrow.ml.schedule import side_by_side
    assert side_by_side(spark, [lambda i=i: spark.range(i).count() for i in range(5)]) == list(range(5))

    def long_job():
        slow = F.udf(lambda v: time.sleep(60) or v, "long")
        return spark.range(8).select(slow("id")).collect()

    def fails():
        time.sleep(3)
        raise ValueError("no fit")
    t0 = time.time()
    with pytest.raises(ValueError, match="no fit"):
        side_by_side(spark, [long_job, fails, long_job], at_once=2)
    assert time.time() - t0 < 30


def test_stream_of_repeats_over_restarts(spark, tmp_path):
    """Repeats split over micro-batches and over a restart; nulls are a signature like any."""
    from harrow.streaming import stream as X
    rows = [(1, i, s) for i, s in enumerate(["a", "a", None, None, "a", "b", "b", "b", "a"])]
    rows += [(2, i, s) for i, s in enumerate(["b", "b", "c", None, "c", "c"])]
    schema = "u int, t int, s string"
    stage, sink, ckpt = (str(tmp_path / n) for n in ("stage", "sink", "ckpt"))
    df = spark.createDataFrame(rows, schema)
    for t in range(9):
        df.where(F.col("t") == t).coalesce(1).write.mode("append").parquet(stage)
        if t in (2, 3, 8):
            X.drop_repeats_stream(X.file_stream(spark, stage, df.schema), ["u"], ["t"], ["s"], sink, ckpt)
    got = sorted(tuple(r) for r in spark.read.schema(schema).parquet(sink).collect())
    want = sorted(tuple(r) for r in W.drop_consecutive_repeats(df, ["u"], ["t"], ["s"]).collect())
    assert got == want and len(got) == 9


def test_streamed_repeats_of_many_partitions(spark, tmp_path):
    """Partitions share groups of state; null is a partition, and none mixes with another."""
    from harrow.operators import rank as W
    from harrow.streaming import stream as X
    stage, sink, ckpt = (str(tmp_path / n) for n in ("stage", "sink", "ckpt"))
    rng = np.random.default_rng(3)
    rows = [(None if u == 0 else u, t, str(rng.integers(0, 2)) if u % 3 else None)
            for u in range(1500) for t in range(4)]
    df = spark.createDataFrame(rows, "u long, t long, s string")
    for half in (0, 1):
        df.where(F.floor(F.col("t") / 2) == half).coalesce(1).write.mode("append").parquet(stage)
        q = X.drop_repeats_stream(X.file_stream(spark, stage, df.schema), ["u"], ["t"], ["s"], sink, ckpt)
    got = Counter(tuple(r) for r in spark.read.schema(df.schema).parquet(sink).collect())
    want = Counter(tuple(r) for r in W.drop_consecutive_repeats(df, ["u"], ["t"], ["s"]).collect())
    assert got == want and len(rows) > sum(got.values()) > 1500
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= X.BUCKETS


def test_replayed_batch_keeps_its_version(spark, tmp_path):
    """A batch that was noted but not finished is scored again by the version it had noted,
    though a newer one is there by then."""
    from harrow.ml import models as M
    from harrow.streaming import stream as X
    df = spark.createDataFrame(_planted(200, 8), PLANTED)
    root, stage, sink, ckpt = (str(tmp_path / n) for n in ("root", "stage", "sink", "ckpt"))
    with pytest.raises(Exception, match="no bundle published"):
        df.write.parquet(stage)
        X.score_stream_bundle(X.file_stream(spark, stage, df.schema, 100), root, sink, ckpt)
    meta = spark.createDataFrame([("v",)], "feature string")
    for c in (1.0, 0.01):
        model = M.fit_pipeline(df, ["v"], [], "hit", "k", "logistic_regression", "none", {"C": c})
        X.publish_bundle(model.pipeline(), meta, {}, root)
    spark.createDataFrame([(1,)], "version int").write.parquet(f"{sink}/versions/batch_id=0")
    X.score_stream_bundle(X.file_stream(spark, stage, df.schema, 100), root, sink, ckpt)
    got = X.read_scores(spark, sink).collect()
    assert len(got) == 200 and {r["bundle_version"] for r in got} == {1}
    df.limit(5).write.mode("append").parquet(stage)
    X.score_stream_bundle(X.file_stream(spark, stage, df.schema, 100), root, sink, ckpt)
    assert X.read_scores(spark, sink).groupBy("bundle_version").count().count() == 2


def test_hot_key_is_spread_without_adaptive_skew(spark):
    """A third of the rows on one key and a third on null: partitions stay even, rows exact."""
    from harrow.operators.joins import hot_keys, lookup_join
    n = 30000
    left = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot"))
                                 .when(F.col("id") % 3 == 1, F.lit(None))
                                 .otherwise(F.concat(F.lit("k"), (F.col("id") % 5000).cast("string"))).alias("k"))
    one = spark.createDataFrame([("hot", 1), (None, 2), ("k8", 3), ("k11", 4)], "k string, v int")
    hot = hot_keys(left, F.col("k"))
    assert set(hot) == {"hot", None} and abs(hot["hot"] - 1 / 3) < 1e-9
    before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = lookup_join(left, one, "k")
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] < 2 * sizes[4]
        got = joined.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("v"), F.count("v").alias("c"))
        by = {r["k"]: r for r in got.where("k is null or v is not null or k = 'hot'").collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert joined.count() == n
    assert (by["hot"]["n"], by["hot"]["v"], by["hot"]["c"]) == (10000, 1, 10000)
    assert (by[None]["n"], by[None]["v"]) == (10000, None) and by["k8"]["v"] == 3


def test_first_artist_matches_nothing_without_one(spark):
    from harrow.operators import enrich as EN
    tracks = ['{"id":"a","artists":[{"id":"x"}]}', '{"id":"b","artists":[]}', '{"id":"c"}',
              '{"id":"d","artists":[{"id":"nope"}]}']
    artists = ['{"id":"x","popularity":5}', '{"id":"x","popularity":5}', '{"popularity":9}']
    t = EN.parse_records(spark.createDataFrame([(v,) for v in tracks], "value string"), "value",
                         EN.TRACK_SCHEMA, "track")
    a = EN.parse_records(spark.createDataFrame([(v,) for v in artists], "value string"), "value",
                         EN.ARTIST_SCHEMA, "artist")
    got = EN.lookup_first_artist(t, a).select("track.id", "artist.popularity").collect()
    assert sorted(map(tuple, got), key=str) == [("a", 5), ("b", None), ("c", None), ("d", None)]


def test_row_groups_survive_colliding_digests(spark, monkeypatch):
    """Nulls count as values, and rows whose digests collide stay different rows."""
    from harrow.operators import clean as CL
    rows = [(1, None), (None, 1), (1, None), (2, 2), (None, None), (2, 2), (2, 2), (3, 1)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert sorted(r["__n"] for r in CL.row_groups(df).collect()) == [1, 1, 1, 2, 3]
    monkeypatch.setattr(CL.F, "xxhash64", lambda *a: F.lit(7).cast("long"))
    assert sorted(r["__n"] for r in CL.row_groups(df).collect()) == [1, 1, 1, 2, 3]
    assert A.duplicate_rows(df).first()[0] == 3


def test_empty_result_replaces_its_run_only(spark, tmp_path):
    from harrow.sources.io import read_result, write_result
    df = spark.createDataFrame([(1, "a")], "v int, s string")
    for run in ("one", "two / three"):
        write_result(df, str(tmp_path), "table", run)
    write_result(df.limit(0), str(tmp_path), "table", "one")
    assert read_result(spark, str(tmp_path), "table", "one").count() == 0
    assert read_result(spark, str(tmp_path), "table", "two / three").first()["v"] == 1


def test_columns_by_type_and_required(spark):
    df = spark.createDataFrame([(1, "a", 2.0, True)], "k int, t string, x double, b boolean")
    numeric, categorical = C.split_columns_by_type(df, exclude=["k"])
    assert (numeric, categorical) == (["x", "b"], ["t"])
    C.require_columns(df, ["k", "t"])
    with pytest.raises(ValueError, match="u, v"):
        C.require_columns(df, ["k", "u", "v"])


def test_defaults_without_a_median_stay_null(spark):
    df = spark.createDataFrame([(None, float("nan"))], "x double, y double")
    r = C.fill_feature_defaults(df, {"x": None, "y": 2.0, "z": 3.0}, ["g"]).first()
    assert (r.x, r.y, r.z, r.g) == (None, 2.0, 3.0, "")


def test_absent_result_is_an_error(spark, tmp_path):
    from harrow.sources.io import load_bundle, read_result
    with pytest.raises(FileNotFoundError, match="no stored result 'curves'"):
        read_result(spark, str(tmp_path), "curves")
    with pytest.raises(FileNotFoundError, match="no saved bundle"):
        load_bundle(spark, str(tmp_path / "none"))


def test_consecutive_repeats_across_partitions(spark):
    rows = [(1 if i < 300 else 2, i, "m", float(i // 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "u int, t int, mode string, score double").repartition(7)
    got = W.drop_consecutive_repeats(df, ["u"], ["t"], ["mode", "score"]).collect()
    want = [r for i, r in enumerate(rows) if i == 0 or (r[0], r[2], r[3]) != (
        rows[i - 1][0], rows[i - 1][2], rows[i - 1][3])]
    assert sorted(tuple(r) for r in got) == want
    nulls = spark.createDataFrame([(1, 1, None), (1, 2, None), (1, 3, "a")], "u int, t int, s string")
    assert sorted(r.t for r in W.drop_consecutive_repeats(nulls, ["u"], ["t"], ["s"]).collect()) == [1, 3]
    assert W.drop_consecutive_repeats(nulls.limit(0), ["u"], ["t"], ["s"]).count() == 0


def test_tables_by_header_name(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    from harrow.sources.io import read_table
    f = tmp_path / "t.csv"
    f.write_text("B,A,C\n1,2,NaN\n3,NA,4.5\n")
    schema = _parse_datatype_string("a int, b int, c double")
    assert [tuple(r) for r in read_table(spark, str(f), schema).collect()] == [
        (2, 1, None), (None, 3, 4.5)]
    assert dict(read_table(spark, str(f)).dtypes) == {"b": "bigint", "a": "bigint", "c": "double"}
    with pytest.raises(ValueError, match="d"):
        read_table(spark, str(f), _parse_datatype_string("d int"))


def test_all_families_on_folds_prepared_once(spark, monkeypatch):
    from harrow.ml import models as M
    from harrow.plans import queries_ml as Q
    assert Q.FAMILIES == tuple(M.GRIDS)
    small = {"logistic_regression": {"C": 1.0}, "boosted_trees": {"maxIter": 2, "stepSize": 0.1, "maxDepth": 2},
             "random_forest": {"numTrees": 3, "minInstancesPerNode": 1, "maxDepth": 3}}
    monkeypatch.setattr(M, "CV_DEFAULTS", small)
    monkeypatch.setattr(M, "GRIDS", {"logistic_regression": {"C": [0.1, 1.0, 10.0]}})
    calls, prepare = [], M.prepare
    monkeypatch.setattr(M, "prepare", lambda *a, **k: calls.append(1) or prepare(*a, **k))
    rows = [(i, float(i % 7) + (i % 2), "ab"[i % 2 if i % 5 else 0], i % 2, i // 2 % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "k long, v double, c string, hit int, fold int")
    got = M.compare_strategies(df, ["v"], ["c"], "hit", "k", tuple(small), ("none", "balanced"), 2)
    assert {(r.model, r.imbalance) for r in got.collect()} == {
        (f, s) for f in small for s in ("none", "balanced")}
    assert len(calls) == 2      # once a fold, whatever the strategies and families
    calls.clear()
    assert M.tune(df, ["v"], ["c"], "hit", "k", "logistic_regression", "none", k=2)[2] > 0
    assert len(calls) == 3      # two folds and the refit, for three combinations


def test_cardinality_sketches_merge_and_fall_back(spark):
    rows = [(i, str(i % 500), None if i % 3 else "", -0.0 if i % 2 else 0.0, i % 2)
            for i in range(9000)]
    df = spark.createDataFrame(rows, "wide long, `odd.name` string, text string, num double, day int")
    cols = ["wide", "odd.name", "text", "num"]
    got = {r.column_name: r for r in A.cardinality_coverage(df, cols).collect()}
    assert [got[c].distinct for c in cols] == [9000, 500, 1, 1]
    assert [got[c].high_cardinality for c in cols] == [1, 0, 0, 0]
    assert [got[c].sparse for c in cols] == [0, 0, 1, 0]
    assert got["text"].coverage == pytest.approx(1 / 3)
    assert "Expand" not in A.cardinality_coverage(df, cols)._jdf.queryExecution().toString()
    rough = {r.column_name: r for r in A.cardinality_coverage(df, cols, approximate=True).collect()}
    assert rough["wide"].distinct == pytest.approx(9000, rel=0.1)
    assert [rough[c].distinct for c in cols[1:]] == [500, 1, 1]
    # Two days' sketches make the whole table's.
    days = [A.cardinality_sketches(df.where(F.col("day") == d), cols) for d in (0, 1)]
    whole = A.cardinality_estimates(A.cardinality_sketches(df, cols)).collect()
    both = A.cardinality_estimates(A.merge_cardinality(days[0].union(days[1]))).collect()
    exact = lambda rs: sorted(tuple(r) for r in rs if r.exact)
    assert exact(both) == exact(whole) and len(exact(whole)) == 3
    (wide,) = [r for r in both if r.column_name == "wide"]
    assert wide.exact == 0 and wide.distinct == pytest.approx(9000, rel=0.1)


def test_cardinality_of_nothing(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert [(r.distinct, r.coverage) for r in A.cardinality_coverage(df, ["a", "b"]).collect()] == \
        [(0, None), (0, None)]


def test_holdout_rows_are_scored_once(spark, monkeypatch):
    """Curve, counts and result all read the scores; the trees are walked for one of them only."""
    from harrow.plans import queries_ml as Q
    scored = spark.sparkContext.accumulator(0)

    class Model:
        def score(self, df):
            @F.udf("double")
            def walk(k):
                scored.add(1)
                return (k * 37 % 100) / 100

            return df.withColumn("hit_potential", walk("track_key")).withColumn(
                "predicted_hit", (F.col("hit_potential") >= 0.5).cast("int"))

    test = spark.createDataFrame([(i, i * 53 % 7 % 2) for i in range(200)], "track_key long, hit int")
    monkeypatch.setattr(Q, "split", lambda spark, sf: (test, test))
    monkeypatch.setattr(Q.M, "fit_pipeline", lambda *args: Model())
    got = Q.m02_random_forest(spark, "unused").first()
    kept = scored.value
    score = [(i * 37 % 100) / 100 for i in range(200)]
    right = sum((s >= 0.5) == bool(i * 53 % 7 % 2) for i, s in enumerate(score))
    assert got["accuracy"] == pytest.approx(right / 200) and got["model"] == "random_forest"
    # One pass, read by name of the column and by its threshold.
    assert kept <= 2 * 200


def test_trees_grow_on_all_rows_whatever_the_layout(spark):
    """However many rows there are, a boosted model is one model of all rows and a tree of a forest
    draws from all: neither tasks nor shards change it."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from harrow.ml import boost, forest
    from harrow.ml import models as M
    rows = spark.range(300_000).select(
        "id", F.array(*(F.rand(i) - 0.5 for i in range(4))).alias("v"), F.rand(9).alias("u"))
    x = M.sized(rows.select("id", array_to_vector(F.col("v")).alias("features"), (
        F.col("v")[0] + 0.4 * F.col("v")[1] + 0.1 * F.col("u") > 0.2).cast("double").alias("label")))
    setting = boost.Setting(3, 0.3, 4)
    one = boost.fit_grid(x, [setting], "id", slots=1)[setting]
    three = boost.fit_grid(x, [setting], "id", slots=3, shard_rows=100_000)[setting]
    usual = boost.BoostedTrees(setting=setting, key="id").fit(x).fitted()
    assert len(one) == len(three) == len(usual) == 1
    for a in (three[0], usual[0]):
        assert np.array_equal(a.feature, one[0].feature) and np.array_equal(a.threshold, one[0].threshold)
        assert np.allclose(a.value, one[0].value) and np.isclose(a.base, one[0].base)
    setting = forest.Setting(2, 1, 3)
    trees = forest.fit_grid(x, [setting], "id")[setting]
    # The first split of a tree is the best one over its bootstrap of all rows.
    pdf = x.select(F.xxhash64("id").alias("k"), "label", vector_to_array("features").alias("v")).toPandas()
    edges = boost.bin_edges(x, "features")
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in
                      zip(edges, np.array(pdf["v"].tolist()).T, strict=True)], axis=1).astype(np.uint8)
    args = (pdf["k"].to_numpy(), pdf["label"].to_numpy(), np.ones(len(pdf)), edges, setting)
    for t, tree in enumerate(trees):
        assert tree == forest.Packed.of(forest._grow(codes, *args, t, 42))


def test_forests_of_every_path_draw_from_all_rows(spark):
    """``fit_pipeline`` and the fits of a cross-validation grow the forest of one part that holds
    all rows, also beyond 100,000 of them."""
    from harrow.ml import forest
    from harrow.ml import models as M
    rows = spark.range(110_000).select("id", (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("v")) \
        .withColumn("hit", (F.col("v") + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 5000 > 0.7).cast("int"))
    params = {"maxDepth": 2, "minInstancesPerNode": 1, "numTrees": 2}
    ready = M.prepare(rows, ["v"], [], "hit", "id")["none"]
    want = forest.fit_grid(ready.x, [M.forest_setting(params)], "id", part_rows=10**9)[M.forest_setting(params)]
    assert M.fit_pipeline(rows, ["v"], [], "hit", "id", "random_forest", params=params).clf.fitted() == want
    few = ready.x.orderBy("id").limit(50)
    got = M.score_points(ready, "random_forest", [params], few).select("p").collect()
    x = np.array([r["features"].toArray() for r in few.collect()])
    assert np.allclose([r["p"][0] for r in got], np.mean([t.score(x) for t in want], axis=0))
