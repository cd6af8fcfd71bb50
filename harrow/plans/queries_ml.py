"""Model, baseline, scoring and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.functions import columns as C
from harrow.ml import models as M
from harrow.ml.features import feature_names, fit_preprocessor
from harrow.operators import evaluate as E
from harrow.operators import profile as A
from harrow.operators import rank as W
from harrow.operators import sampling as SA
from harrow.operators.joins import attach
from harrow.plans import fixtures as FX
from harrow.plans.catalog import register, with_ctes
from harrow.plans.queries_eval import M as MACRO, by_group_sql, counts_sql, fairness_sql, groups_sql
from harrow.session import freeze

NUMERIC = ["energy", "danceability", "loudness", "tempo", "acctbal"]
CATEGORICAL = ["genre", "nation", "segment"]
KEY, LABEL = "track_key", "hit"

SPLIT_SQL = FX.LABELLED_CTE + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY first_week, track_key) AS rn,
                  count(*) OVER () AS n FROM labelled),
train AS (SELECT * FROM ranked WHERE rn <= CAST(floor(CAST(0.8 AS DOUBLE) * n) AS BIGINT)),
test AS (SELECT * FROM ranked WHERE rn > CAST(floor(CAST(0.8 AS DOUBLE) * n) AS BIGINT))"""


def split(spark, sf):
    lab = freeze(FX.labelled_tracks(spark, sf))  # read by every fit and score
    s = W.temporal_split(lab, "first_week", [KEY], 0.2)
    return s.filter("is_test = 0").drop("is_test"), s.filter("is_test = 1").drop("is_test")


def _metrics_sql(src: str) -> str:
    return with_ctes(SPLIT_SQL, f"""
ev AS (SELECT hit AS y_true, y_pred, y_score FROM {src}),
c AS (SELECT count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn,
             count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
             count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
             count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp FROM ev)""",
                     groups_sql("ev")) + f"""
SELECT {MACRO['accuracy']} AS accuracy, {MACRO['precision_macro']} AS precision_macro,
       {MACRO['recall_macro']} AS recall_macro, {MACRO['f1_macro']} AS f1_macro, roc_auc
FROM c, auc"""


METRIC_DOUBLES = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "roc_auc"]


def _eval(scored):
    return E.classification_metrics(scored.select(F.col(LABEL).alias("y_true"), "y_pred",
                                                  "y_score"))


MAJORITY_SQL = """,
maj AS (SELECT CASE WHEN count(*) FILTER (WHERE hit = 1) > count(*) FILTER (WHERE hit = 0)
                    THEN 1 ELSE 0 END AS m FROM train),
base_major AS (SELECT test.*, maj.m AS y_pred, CAST(maj.m AS DOUBLE) AS y_score FROM test, maj)"""


@register("m04_majority_baseline", _metrics_sql("base_major").replace(
    "ev AS (", MAJORITY_SQL.lstrip(",") + ",\nev AS (", 1), doubles=METRIC_DOUBLES)
def m04_majority_baseline(spark, sf):
    train, test = split(spark, sf)
    return _eval(M.majority_baseline(train, test, LABEL))


UNIFORM_SQL = ("CAST(('0x' || substr(md5(concat_ws('-', CAST(track_key AS VARCHAR), '42', "
               "'prior')), 1, 8)) AS BIGINT) / 4294967296.0")
RANDOM_SQL = f""",
prior AS (SELECT avg(CAST(hit AS DOUBLE)) AS p FROM train),
base_rand AS (SELECT test.*, CAST({UNIFORM_SQL} < p AS INTEGER) AS y_pred,
                     CAST(CAST({UNIFORM_SQL} < p AS INTEGER) AS DOUBLE) AS y_score
              FROM test, prior)"""


@register("m05_stratified_random_baseline", _metrics_sql("base_rand").replace(
    "ev AS (", RANDOM_SQL.lstrip(",") + ",\nev AS (", 1), doubles=METRIC_DOUBLES)
def m05_stratified_random_baseline(spark, sf):
    train, test = split(spark, sf)
    return _eval(M.stratified_random_baseline(train, test, LABEL, KEY))


def _scored_once(model, test):
    """Labels, predictions and scores, kept: curves and counts read them several times, and
    every tree would be walked again each time."""
    return freeze(model.score(test).select(LABEL, F.col("predicted_hit").alias("y_pred"),
                                           F.col("hit_potential").alias("y_score")))


def _fit_and_eval(spark, sf, family, strategy="balanced", params=None):
    train, test = split(spark, sf)
    model = M.fit_pipeline(train, NUMERIC, CATEGORICAL, LABEL, KEY, family, strategy, params)
    return _eval(_scored_once(model, test)).withColumn("model", F.lit(family))


@register("m01_logistic_regression")
def m01_logistic_regression(spark, sf):
    """Tuned LR (C=0.1, balanced weights) on the temporal split; holdout metrics."""
    return _fit_and_eval(spark, sf, "logistic_regression", "balanced")


@register("m02_random_forest")
def m02_random_forest(spark, sf):
    """Tuned forest (400 trees, leaf 5, balanced) on the temporal split."""
    return _fit_and_eval(spark, sf, "random_forest", "balanced")


@register("m03_boosted_trees")
def m03_boosted_trees(spark, sf):
    """Tuned boosted trees (200 rounds, lr 0.15, depth 4, subsample 0.9)."""
    return _fit_and_eval(spark, sf, "boosted_trees", "none")


@register("m06_fit_with_smote")
def m06_fit_with_smote(spark, sf):
    """LR with SMOTE applied to the preprocessed training vectors only."""
    return _fit_and_eval(spark, sf, "logistic_regression", "smote")


def _folds(spark, sf):
    train, _ = split(spark, sf)
    return SA.stratified_folds(train, LABEL, KEY, 5, 42)


FAMILIES = tuple(M.GRIDS)


@register("m07_compare_strategies")
def m07_compare_strategies(spark, sf):
    """Stage A: none / balanced / smote of all families under 5-fold CV."""
    return M.compare_strategies(_folds(spark, sf), NUMERIC, CATEGORICAL, LABEL, KEY,
                                FAMILIES, M.STRATEGIES, 5)


@register("m08_tune")
def m08_tune(spark, sf):
    """Stage B: every family on its whole grid; the best by CV, refitted; holdout metrics."""
    tuned = M.tune_families(_folds(spark, sf), NUMERIC, CATEGORICAL, LABEL, KEY,
                            dict.fromkeys(FAMILIES, "balanced"), k=5)
    model, best, mean, std = max(tuned.values(), key=lambda t: t.mean)
    _, test = split(spark, sf)
    return _eval(_scored_once(model, test)).select(
        "*", F.lit(mean).alias("cv_f1_macro_mean"), F.lit(std).alias("cv_f1_macro_std"),
        F.lit(str(best)).alias("best_params"), F.lit(model.family).alias("model"))


@register("m09_feature_importance")
def m09_feature_importance(spark, sf):
    train, _ = split(spark, sf)
    model = M.fit_pipeline(train, NUMERIC, CATEGORICAL, LABEL, KEY, "boosted_trees", "none")
    pairs = M.feature_importance(model, feature_names(model.pre, NUMERIC, CATEGORICAL), 15)
    return spark.createDataFrame(pairs, "name string, importance double")


@register("m12_score_batch", with_ctes(FX.LABELLED_CTE) + """
SELECT track_key, acctbal, 1 / (1 + exp(-(acctbal - 4500) / 3000)) AS hit_potential,
       CAST(1 / (1 + exp(-(acctbal - 4500) / 3000)) >= 0.5 AS INTEGER) AS predicted_hit
FROM labelled""", doubles=["acctbal", "hit_potential"])
def m12_score_batch(spark, sf):
    lab = FX.labelled_tracks(spark, sf).select("track_key", "acctbal")
    return M.score_batch(lab, lambda d: 1 / (1 + F.exp(-(F.col("acctbal") - 4500) / 3000)),
                         required=["acctbal"])


@register("m13_score_feature_maps", with_ctes(FX.LABELLED_CTE) + """,
med AS (SELECT median(tempo) AS mt, median(energy) AS me FROM labelled),
rows_ AS (SELECT track_key, coalesce(tempo, mt) AS tempo, coalesce(energy, me) AS energy,
                 coalesce(genre, '') AS genre FROM labelled, med)
SELECT track_key, tempo, energy, genre,
       1 / (1 + exp(-(tempo - 50000) / 20000)) AS hit_potential,
       CAST(1 / (1 + exp(-(tempo - 50000) / 20000)) >= 0.5 AS INTEGER) AS predicted_hit
FROM rows_""", doubles=["tempo", "energy", "hit_potential"])
def m13_score_feature_maps(spark, sf):
    from harrow.operators.rank import median_map
    lab = FX.labelled_tracks(spark, sf)
    defaults = median_map(lab, ["tempo", "energy"])
    maps = lab.select(KEY, F.create_map(F.lit("tempo"), F.col("tempo").cast("string"),
                                        F.lit("energy"), F.col("energy").cast("string"),
                                        F.lit("genre"), F.col("genre")).alias("features"))
    rows = M.maps_to_rows(maps, "features", defaults, ["genre"], keep=[KEY])
    return M.score_batch(rows, lambda d: 1 / (1 + F.exp(-(F.col("tempo") - 50000) / 20000)))


_RULE_SQL = "1 / (1 + exp(-(acctbal - 4500) / 3000))"


@register("m14_batch_report", with_ctes(FX.LABELLED_CTE) + f""",
s AS (SELECT track_key, artist, acctbal, {_RULE_SQL} AS p FROM labelled),
h AS (SELECT least(CAST(floor(p * 100 / 4) AS BIGINT), 24) AS bin FROM s),
r AS (SELECT *, row_number() OVER (ORDER BY p DESC, track_key) AS rp,
             row_number() OVER (ORDER BY track_key) AS rk FROM s)
SELECT 'kpis' AS part, CAST(NULL AS BIGINT) AS track_key, CAST(NULL AS VARCHAR) AS label,
       avg(p) * 100 AS x, max(p) * 100 AS y,
       CAST(sum(CAST(p >= 0.5 AS INTEGER)) AS BIGINT) AS n FROM s
UNION ALL SELECT 'ranked', track_key, substr(artist, 1, 40), p, NULL, CAST(p >= 0.5 AS INTEGER)
  FROM r WHERE rp <= 10
UNION ALL SELECT 'preview', track_key, artist, p, NULL, CAST(p >= 0.5 AS INTEGER) FROM r WHERE rk <= 20
UNION ALL SELECT 'histogram', NULL, NULL, b * 4.0, (b + 1) * 4.0,
                 (SELECT count(*) FROM h WHERE h.bin = b)
  FROM (SELECT unnest(range(0, 25)) AS b) AS bins
UNION ALL SELECT 'scatter', track_key, NULL, acctbal, p, NULL FROM s""", doubles=["x", "y"])
def m14_batch_report(spark, sf):
    """Every part of the report, told apart by ``part``."""
    lab = FX.labelled_tracks(spark, sf).select("track_key", "artist", "acctbal")
    scored = M.score_batch(lab, lambda d: 1 / (1 + F.exp(-(F.col("acctbal") - 4500) / 3000)))
    out = M.batch_report(scored, "track_key", ["artist"], scatter=["acctbal"])

    def part(name, key=None, label=None, x=None, y=None, n=None):
        none = {"track_key": "long", "label": "string", "x": "double", "y": "double", "n": "long"}
        given = {"track_key": key, "label": label, "x": x, "y": y, "n": n}
        return out[name].select(F.lit(name).alias("part"), *[
            (F.col(v) if v else F.lit(None)).cast(none[c]).alias(c) for c, v in given.items()])
    rows = part("kpis", x="avg_score", y="top_score", n="predicted_hits")
    for more in (part("ranked", "track_key", "label", "hit_potential", n="predicted_hit"),
                 part("preview", "track_key", "artist", "hit_potential", n="predicted_hit"),
                 part("histogram", x="bin_lo", y="bin_hi", n="count"),
                 part("scatter", "track_key", x="acctbal", y="hit_potential")):
        rows = rows.unionByName(more)
    return rows


@register("m11_train_bundle")
def m11_train_bundle(spark, sf):
    """Train candidates, keep the best by holdout macro F1, save the bundle, load it
    back and return its per-feature metadata."""
    from harrow.ml.bundle import train_bundle
    from harrow.session import scratch_path
    from harrow.sources.io import load_bundle
    path = scratch_path(spark, "bundle")
    train_bundle(FX.labelled_tracks(spark, sf), NUMERIC, CATEGORICAL, LABEL, KEY, "first_week",
                 path, candidates=("logistic_regression", "random_forest"))
    _, metadata, info = load_bundle(spark, path)
    return metadata.withColumn("model_name", F.lit(info["model_name"]))


@register("s06_bundle_round_trip", with_ctes(SPLIT_SQL) + """
SELECT count(*) AS n, CAST(0 AS DOUBLE) AS max_gap FROM test""", doubles=["max_gap"])
def s06_bundle_round_trip(spark, sf):
    """A saved and reloaded bundle scores every holdout row as the model before saving."""
    from harrow.ml.bundle import bundle_metadata
    from harrow.session import scratch_path
    from harrow.sources.io import load_bundle, save_bundle
    train, test = split(spark, sf)
    model = M.fit_pipeline(train, NUMERIC, CATEGORICAL, LABEL, KEY, "logistic_regression",
                           "balanced")
    path = scratch_path(spark, "bundle")
    save_bundle(model.pipeline(), bundle_metadata(train, NUMERIC, CATEGORICAL, LABEL),
                {"model_name": "logistic_regression"}, path)
    loaded, _, _ = load_bundle(spark, path)
    again = loaded.transform(test).select(KEY, M.probability_of_positive(test).alias("again"))
    return (model.score(test).select(KEY, "hit_potential").join(again, KEY)
            .agg(F.count(F.lit(1)).alias("n"),
                 F.max(F.abs(F.col("hit_potential") - F.col("again"))).alias("max_gap")))


@register("m15_train_from_signals")
def m15_train_from_signals(spark, sf):
    """Time-domain features of each sample array, label 0 as the positive class, stratified
    25% holdout, best of LR / forest by holdout macro F1, saved as a bundle and read back."""
    from harrow.ml.bundle import train_from_signals
    from harrow.session import scratch_path
    from harrow.sources.io import load_bundle
    emb = FX.table(spark, sf, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("samples"),
        (F.col("label") == 0).cast("int").alias("hit"))
    path = scratch_path(spark, "bundle")
    trained = train_from_signals(emb, "samples", "vec_id", "hit", path)
    _, metadata, info = load_bundle(spark, path)
    return trained.withColumn("n_features", F.lit(metadata.count())).withColumn(
        "saved_model", F.lit(info["model_name"]))


# --- E10 / E11 on rule scorers with cross-validated means ----------------------------

# Three fixed rules stand in for the models, so that SQL can follow the whole table.
RULES = {
    "rule_balance": lambda: (F.col("acctbal") + 1000) / 11000,
    "rule_tempo": lambda: F.least(F.lit(1.0), F.coalesce(F.col("tempo"), F.lit(0.0)) / 100000),
    "rule_mean": lambda: ((F.col("acctbal") + 1000) / 11000 + F.least(
        F.lit(1.0), F.coalesce(F.col("tempo"), F.lit(0.0)) / 100000)) / 2,
}
_TEMPO_SQL = "least(1.0, coalesce(tempo, 0.0) / 100000)"
RULES_SQL = {
    "rule_balance": "(acctbal + 1000) / 11000",
    "rule_tempo": _TEMPO_SQL,
    "rule_mean": f"((acctbal + 1000) / 11000 + {_TEMPO_SQL}) / 2",
}


def _comparison_sql() -> str:
    rules = "\n  UNION ALL ".join(
        f"SELECT '{n}' AS model, {i} AS seq, 0 AS is_baseline, hit AS y_true, "
        f"CAST({e} >= 0.5 AS INTEGER) AS y_pred, {e} AS y_score FROM test"
        for i, (n, e) in enumerate(RULES_SQL.items()))
    cv = "\n  UNION ALL ".join(
        f"SELECT '{n}' AS model, fold, hit AS y_true, CAST({e} >= 0.5 AS INTEGER) AS y_pred FROM folds"
        for n, e in RULES_SQL.items())
    return (SPLIT_SQL + MAJORITY_SQL + RANDOM_SQL + f""",
folds AS (SELECT *, (row_number() OVER (PARTITION BY hit ORDER BY md5(concat_ws('-',
  CAST(track_key AS VARCHAR), '42')), track_key) - 1) % 5 AS fold FROM train),
cev AS ({cv}),
cvf AS (SELECT model, {MACRO['f1_macro']} AS f1 FROM (
  SELECT model, fold, {counts_sql()} FROM cev GROUP BY model, fold) AS x),
cvs AS (SELECT model, avg(f1) AS cv_f1_macro_mean, stddev_pop(f1) AS cv_f1_macro_std
        FROM cvf GROUP BY model),
mev AS (
  SELECT 'baseline_majority_class' AS model, 0 AS seq, 1 AS is_baseline, hit AS y_true, y_pred,
         y_score FROM base_major
  UNION ALL SELECT 'baseline_stratified_random', 1, 1, hit, y_pred, y_score FROM base_rand
  UNION ALL {rules}),
mc AS (SELECT model, seq, is_baseline, {counts_sql()} FROM mev GROUP BY model, seq, is_baseline),
mg AS (SELECT model, y_score, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM mev
       WHERE y_score IS NOT NULL GROUP BY model, y_score),
mcum AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY y_score) - neg AS below FROM mg),
mauc AS (SELECT model, CASE WHEN sum(pos) > 0 AND sum(neg) > 0
         THEN sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) END AS roc_auc
         FROM mcum GROUP BY model),
comp AS (SELECT mc.model, seq, {MACRO['accuracy']} AS accuracy,
                {MACRO['precision_macro']} AS precision_macro, {MACRO['recall_macro']} AS recall_macro,
                {MACRO['f1_macro']} AS f1_macro, roc_auc, is_baseline, cv_f1_macro_mean,
                cv_f1_macro_std
         FROM mc JOIN mauc ON mauc.model = mc.model LEFT JOIN cvs ON cvs.model = mc.model)""")


COMPARISON_SQL = _comparison_sql()
CV_DOUBLES = [*METRIC_DOUBLES, "cv_f1_macro_mean", "cv_f1_macro_std"]


def comparison_table(spark, sf):
    train, test = split(spark, sf)
    folds = SA.stratified_folds(train, LABEL, KEY, 5, 42)
    baselines = None
    for seq, (name, scored) in enumerate([
            ("baseline_majority_class", M.majority_baseline(train, test, LABEL)),
            ("baseline_stratified_random",
             M.stratified_random_baseline(train, test, LABEL, KEY))]):
        row = _eval(scored).select(F.lit(name).alias("model"), F.lit(seq).alias("seq"), "*")
        baselines = row if baselines is None else baselines.unionByName(row)
    tuned = None
    for seq, (name, rule) in enumerate(RULES.items()):
        s = rule()
        cv = (folds.select("fold", F.col(LABEL).alias("y_true"), (s >= 0.5).cast("int")
                           .alias("y_pred"))
              .groupBy("fold").agg(*E.confusion_counts(folds, "y_true", "y_pred")))
        m = E.macro_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
        cv = cv.select(m["f1_macro"].alias("f1")).agg(
            F.avg("f1").alias("cv_f1_macro_mean"), F.stddev_pop("f1").alias("cv_f1_macro_std"))
        held = test.select(F.col(LABEL), (s >= 0.5).cast("int").alias("y_pred"),
                           s.alias("y_score"))
        row = _eval(held).select(F.lit(name).alias("model"), F.lit(seq).alias("seq"), "*")
        row = attach(row, cv)
        tuned = row if tuned is None else tuned.unionByName(row)
    return E.model_comparison(baselines, tuned)


def _model_curves_sql() -> str:
    rules = "\n  UNION ALL ".join(f"SELECT '{n}' AS model, hit AS y_true, {e} AS y_score FROM test"
                                  for n, e in RULES_SQL.items())
    thin = """SELECT model, curve, position, x, y FROM (
  SELECT *, max(position) OVER (PARTITION BY model, curve) + 1 AS n FROM both_) AS b
WHERE n <= 300 OR position IN (
  SELECT CASE WHEN j = 299 THEN n - 1 ELSE CAST(trunc(CAST(j AS DOUBLE) * ((n - 1) / CAST(299 AS DOUBLE)))
              AS BIGINT) END FROM range(300) AS r(j))"""
    return SPLIT_SQL + f""",
sc AS ({rules}),
g AS (SELECT model, CAST(y_score AS DOUBLE) AS score, CAST(sum(y_true) AS BIGINT) AS pos,
             CAST(sum(1 - y_true) AS BIGINT) AS neg FROM sc WHERE y_score IS NOT NULL GROUP BY 1, 2),
cu AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
              row_number() OVER (PARTITION BY model ORDER BY score DESC) AS idx,
              count(*) OVER (PARTITION BY model) AS m, sum(pos) OVER (PARTITION BY model) AS P,
              sum(neg) OVER (PARTITION BY model) AS N
       FROM g WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
nb AS (SELECT *, lag(tps) OVER w AS tp, lag(fps) OVER w AS fp, lead(tps) OVER w AS tn, lead(fps) OVER w AS fn
       FROM cu WINDOW w AS (PARTITION BY model ORDER BY idx)),
kept AS (SELECT * FROM nb WHERE idx = 1 OR idx = m OR fn - 2 * fps + fp != 0 OR tn - 2 * tps + tp != 0),
both_ AS (
  SELECT DISTINCT model, 'roc' AS curve, CAST(0 AS BIGINT) AS position, 0.0 AS x, 0.0 AS y FROM cu
  UNION ALL SELECT model, 'roc', row_number() OVER (PARTITION BY model ORDER BY idx), fps / N, tps / P FROM kept
  UNION ALL SELECT model, 'pr', m - idx, tps / P, CAST(tps AS DOUBLE) / (tps + fps) FROM cu
  UNION ALL SELECT DISTINCT model, 'pr', m, 0.0, 1.0 FROM cu)
""", thin


_CURVES = _model_curves_sql()


@register("e12_model_curves", with_ctes(_CURVES[0]) + _CURVES[1], doubles=["x", "y"])
def e12_model_curves(spark, sf):
    """Thinned ROC and PR curves of all models at once (three fixed rules, so that SQL can
    follow)."""
    _, test = split(spark, sf)
    rows = None
    for name, rule in RULES.items():
        part = test.select(F.lit(name).alias("model"), F.col(LABEL).alias("y_true"), rule().alias("y_score"))
        rows = part if rows is None else rows.unionByName(part)
    return E.thinned_curves(rows, by=["model"])


@register("e10_model_comparison", with_ctes(COMPARISON_SQL) + """
SELECT * FROM comp""", doubles=CV_DOUBLES)
def e10_model_comparison(spark, sf):
    return comparison_table(spark, sf)


@register("e11_hypothesis_verdicts", with_ctes(
    COMPARISON_SQL, """
holdout AS (SELECT hit AS y_true, CAST((acctbal + 1000) / 11000 >= 0.5 AS INTEGER) AS y_pred,
                   nation AS "group" FROM test)""", by_group_sql("holdout", "group"),
    fairness_sql(30)) + """,
t AS (SELECT * FROM comp WHERE is_baseline = 0),
v AS (SELECT
  (SELECT max(accuracy) FROM t) AS best_accuracy,
  (SELECT model FROM t ORDER BY accuracy DESC, seq LIMIT 1) AS best_accuracy_model,
  (SELECT accuracy FROM comp WHERE model = 'baseline_stratified_random') AS acc_rand,
  (SELECT accuracy FROM comp WHERE model = 'baseline_majority_class') AS acc_major,
  (SELECT max(f1_macro) FROM t) AS best_f1,
  (SELECT f1_macro FROM comp WHERE model = 'baseline_majority_class') AS f1_major,
  (SELECT model FROM t WHERE model <> 'rule_balance' ORDER BY cv_f1_macro_mean DESC, seq LIMIT 1)
    AS best_ensemble,
  (SELECT f1_disparity FROM fair) AS f1_disparity),
w AS (SELECT v.*, e.cv_f1_macro_mean - l.cv_f1_macro_mean AS h2_margin,
             e.cv_f1_macro_std + l.cv_f1_macro_std AS h2_noise
      FROM v JOIN t AS e ON e.model = v.best_ensemble JOIN t AS l ON l.model = 'rule_balance')
SELECT best_accuracy, best_accuracy_model, acc_rand, acc_major, best_f1, f1_major,
       CAST(best_accuracy > 0.7 AS INTEGER) AS h1_above_70,
       CAST(best_accuracy > acc_rand AS INTEGER) AS h1_beats_random,
       CAST(best_accuracy > acc_major AS INTEGER) AS h1_beats_majority, best_ensemble, h2_margin,
       h2_noise, CAST(h2_margin > 0 AS INTEGER) AS h2_beats_linear,
       CAST(h2_margin > h2_noise AS INTEGER) AS h2_outside_noise, f1_disparity,
       CAST(f1_disparity > 0.1 AS INTEGER) AS h3_disparity FROM w""",
          doubles=["best_accuracy", "acc_rand", "acc_major", "best_f1", "f1_major", "h2_margin",
                   "h2_noise", "f1_disparity"])
def e11_hypothesis_verdicts(spark, sf):
    from harrow.plans.flagship import fairness_flagship
    return E.hypothesis_verdicts(comparison_table(spark, sf), fairness_flagship(spark, sf, 30),
                                 ensembles=("rule_tempo", "rule_mean"), linear="rule_balance")


@register("e14_run_experiment")
def e14_run_experiment(spark, sf):
    """The experiment job end to end, natural and balanced: whole grids, 5 folds, every
    artefact written and read back.  One row per run and artefact with its rows, and the
    macro F1 of the model comparison's best row."""
    from harrow.plans.experiment import run_experiment
    from harrow.session import scratch_path
    from harrow.sources.io import read_result
    base = scratch_path(spark, "experiment")
    rows = None
    for balanced in (False, True):
        out = run_experiment(FX.raw_tracks(spark, sf), score_col="popularity",
                             threshold=FX.LABEL_THRESHOLD, time_col="first_week", now=FX.NOW,
                             formats=FX.DATE_FORMATS, key=KEY, group_col="nation",
                             numeric=NUMERIC, categorical=CATEGORICAL, families=FAMILIES,
                             balanced=balanced, out_base=base)
        run = "balanced" if balanced else "natural"
        for name in sorted(out):
            kept = read_result(spark, base, name, run)
            best = F.max("f1_macro") if name == "model_comparison" else F.lit(None).cast("double")
            row = kept.agg(F.count(F.lit(1)).alias("rows"), best.alias("best_f1_macro")).select(
                F.lit(run).alias("run"), F.lit(name).alias("artefact"), "*")
            rows = row if rows is None else rows.unionByName(row)
    return rows


# --- preprocessing stages (F1-F5), P11, W5, M10 ------------------------------------------

from harrow.ml import features as FE  # noqa: E402

_F_COLS = ["energy", "tempo", "acctbal"]


@register("f01_median_impute", with_ctes(SPLIT_SQL) + """,
med AS (SELECT median(energy) AS m0, median(tempo) AS m1, median(acctbal) AS m2 FROM train)
SELECT track_key, coalesce(energy, m0) AS energy, coalesce(tempo, m1) AS tempo,
       coalesce(acctbal, m2) AS acctbal FROM test, med""", doubles=_F_COLS)
def f01_median_impute(spark, sf):
    """Medians fitted on the training rows fill the holdout's gaps."""
    train, test = split(spark, sf)
    stats = FE.fit_numeric_stats(train, _F_COLS)
    return test.select("track_key", *[F.coalesce(F.col(c), F.lit(stats[c]["median"])).alias(c)
                                      for c in _F_COLS])


@register("f02_standard_scale", with_ctes(SPLIT_SQL) + """,
med AS (SELECT median(energy) AS m0, median(tempo) AS m1, median(acctbal) AS m2 FROM train),
imp AS (SELECT coalesce(energy, m0) AS e, coalesce(tempo, m1) AS t, coalesce(acctbal, m2) AS a
        FROM train, med),
st AS (SELECT avg(e) AS ae, stddev_pop(e) AS se, avg(t) AS avg_t, stddev_pop(t) AS stt,
              avg(a) AS aa, stddev_pop(a) AS sa FROM imp)
SELECT track_key,
       (coalesce(energy, m0) - ae) / CASE WHEN se > 0 THEN se ELSE 1.0 END AS energy,
       (coalesce(tempo, m1) - avg_t) / CASE WHEN stt > 0 THEN stt ELSE 1.0 END AS tempo,
       (coalesce(acctbal, m2) - aa) / CASE WHEN sa > 0 THEN sa ELSE 1.0 END AS acctbal
FROM test, med, st""", doubles=_F_COLS)
def f02_standard_scale(spark, sf):
    """Population-std scaling of the imputed columns; a constant column divides by 1."""
    train, test = split(spark, sf)
    stats = FE.fit_numeric_stats(train, _F_COLS)
    return test.select("track_key", *[
        ((F.coalesce(F.col(c), F.lit(s["median"])) - F.lit(s["mean"])) / F.lit(s["scale"]))
        .alias(c) for c, s in stats.items()])


@register("f03_mode_impute", with_ctes(SPLIT_SQL) + """,
mo AS (SELECT genre AS mg FROM train WHERE genre IS NOT NULL GROUP BY genre
       ORDER BY count(*) DESC, genre LIMIT 1),
ms AS (SELECT segment AS ms FROM train WHERE segment IS NOT NULL GROUP BY segment
       ORDER BY count(*) DESC, segment LIMIT 1)
SELECT track_key, coalesce(genre, mg) AS genre, coalesce(segment, ms) AS segment
FROM test, mo, ms""")
def f03_mode_impute(spark, sf):
    """Most frequent training value (ties to the smallest) fills the gaps."""
    train, test = split(spark, sf)
    modes = FE.fit_modes(train, ["genre", "segment"])
    return test.select("track_key", *[F.coalesce(F.col(c), F.lit(modes[c])).alias(c)
                                      for c in ["genre", "segment"]])


def _onehot_sql(cols, source="test"):
    """CTEs of the training modes and labels, and the slot names of a row of ``source``."""
    ctes, names = "", []
    for c in cols:
        ctes += f""",
mode_{c} AS (SELECT {c} AS m FROM train WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1),
lab_{c} AS (SELECT DISTINCT coalesce({c}, m) AS v FROM train, mode_{c})"""
        names.append(f"(SELECT '{c}_' || v FROM lab_{c} WHERE v = coalesce({source}.{c}, "
                     f"(SELECT m FROM mode_{c})))")
    total = " + ".join(f"(SELECT count(*) FROM lab_{c})" for c in cols)
    return ctes, f"concat_ws(',', {', '.join(names)}) AS slots, {total} AS n_slots"


def _slot_names(vector, names):
    """Names of the slots that hold 1, in order."""
    known = F.array(*map(F.lit, names))
    return F.array_join(F.array_compact(F.transform(
        vector, lambda x, i: F.when(x == 1.0, F.get(known, i)))), ",")


_HOT_CTES, _HOT_COLS = _onehot_sql(["genre", "nation"], "seen")


@register("f04_one_hot", with_ctes(SPLIT_SQL) + _HOT_CTES + f""",
seen AS (SELECT track_key, CASE WHEN track_key % 10 = 0 THEN 'never seen' ELSE genre END AS genre,
                nation FROM test)
SELECT track_key, {_HOT_COLS} FROM seen""")
def f04_one_hot(spark, sf):
    """Sorted categories, one slot each; a value that training lacks is all zeros."""
    from pyspark.ml.functions import vector_to_array
    train, test = split(spark, sf)
    pre = FE.fit_preprocessor(train, [], ["genre", "nation"])
    names = feature_names(pre, [], ["genre", "nation"])
    test = test.withColumn("genre", F.when(F.col("track_key") % 10 == 0, F.lit("never seen"))
                           .otherwise(F.col("genre")))
    out = pre.transform(test).withColumn("v", vector_to_array("features"))
    return out.select("track_key", _slot_names(F.col("v"), names).alias("slots"),
                      F.size("v").cast("long").alias("n_slots"))


_PRE_CTES, _PRE_COLS = _onehot_sql(CATEGORICAL)
_PRE_CTES += ",\nmed AS (SELECT " + ", ".join(
    f"median({c}) AS m_{c}" for c in NUMERIC) + " FROM train),\nst AS (SELECT " + ", ".join(
    f"avg(coalesce({c}, m_{c})) AS a_{c}, stddev_pop(coalesce({c}, m_{c})) AS s_{c}"
    for c in NUMERIC) + " FROM train, med)"


@register("f05_preprocessor", with_ctes(SPLIT_SQL) + _PRE_CTES + "\nSELECT track_key, " + ", ".join(
    f"(coalesce({c}, m_{c}) - a_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1.0 END AS {c}"
    for c in NUMERIC) + f", {_PRE_COLS} FROM test, med, st", doubles=NUMERIC)
def f05_preprocessor(spark, sf):
    """Full preprocessing fitted on training rows, applied to the holdout."""
    from pyspark.ml.functions import vector_to_array
    train, test = split(spark, sf)
    pre = FE.fit_preprocessor(train, NUMERIC, CATEGORICAL)
    names = feature_names(pre, NUMERIC, CATEGORICAL)
    n = len(NUMERIC)
    out = pre.transform(test).withColumn("v", vector_to_array("features"))
    hot = F.slice("v", n + 1, len(names) - n)
    return out.select("track_key", *[F.get("v", i).alias(c) for i, c in enumerate(NUMERIC)],
                      _slot_names(hot, names[n:]).alias("slots"),
                      (F.size("v") - n).cast("long").alias("n_slots"))


@register("p11_echo_numeric", with_ctes(FX.LABELLED_CTE) + """
SELECT energy, tempo, acctbal FROM labelled""", doubles=["energy", "tempo", "acctbal"])
def p11_echo_numeric(spark, sf):
    return C.echo_numeric(FX.labelled_tracks(spark, sf), ["energy", "tempo", "acctbal"])


@register("m10_select_best", with_ctes(COMPARISON_SQL) + """
SELECT * FROM comp WHERE is_baseline = 0
ORDER BY cv_f1_macro_mean DESC NULLS LAST, model LIMIT 1""", doubles=CV_DOUBLES)
def m10_select_best(spark, sf):
    """The tuned row with the best cross-validated macro F1."""
    comp = comparison_table(spark, sf).filter("is_baseline = 0")
    return M.select_best(comp, "cv_f1_macro_mean")
