"""Training jobs that end in a saved bundle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.ml import models as M
from harrow.operators import evaluate as E
from harrow.operators import profile as A
from harrow.operators.rank import temporal_split
from harrow.operators.sampling import stratified_split
from harrow.operators.signal import TIME_FEATURES, time_domain_features
from harrow.session import freeze
from harrow.sources.io import save_bundle


def _holdout_f1(model: M.FittedModel, test: DataFrame, label: str) -> float:
    scored = model.score(test).select(F.col(label).alias("y_true"),
                                      F.col("predicted_hit").alias("y_pred"))
    r = E.classification_metrics(scored, y_score=None).first()
    return float(r["f1_macro"] or 0.0)


def _pick(train, test, numeric, categorical, label, key, candidates):
    best, best_name, best_f1 = None, None, -1.0
    for family in candidates:
        model = M.fit_pipeline(train, numeric, categorical, label, key, family, "balanced")
        f1 = _holdout_f1(model, test, label)
        if f1 > best_f1:
            best, best_name, best_f1 = model, family, f1
    return best, best_name, best_f1


def bundle_metadata(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    label: str) -> DataFrame:
    """Per-feature metadata: one row per numeric feature with its range, median and class
    means (A16), and one row per option of a text feature (A17)."""
    numbers = [F.lit(None).cast("double").alias(c) for c in
               ("lo", "hi", "median", "pos_mean", "neg_mean")]
    out = None
    if numeric:
        out = A.feature_profile(train, list(numeric), label).select(
            "feature", F.lit("numeric").alias("kind"), "lo", "hi", "median", "pos_mean",
            "neg_mean", F.lit(None).cast("string").alias("option"))
    if categorical:
        opts = A.category_options(train, categorical).select(
            F.col("column_name").alias("feature"), F.lit("categorical").alias("kind"), *numbers,
            F.col("value").alias("option"))
        out = opts if out is None else out.unionByName(opts)
    return out


def train_bundle(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str,
                 key: str, time_col: str, path: str,
                 candidates: Sequence[str] = ("logistic_regression", "random_forest")) -> dict:
    """Temporal split, fit candidates, keep the best by holdout macro F1, save
    the pipeline with its metadata (S6)."""
    split = freeze(temporal_split(df, time_col, [key], 0.2))  # read by every candidate
    train = split.filter("is_test = 0").drop("is_test")
    test = split.filter("is_test = 1").drop("is_test")
    model, name, f1 = _pick(train, test, numeric, categorical, label, key, candidates)
    info = {"model_name": name, "f1_macro": f1, "feature_columns": list(numeric) + list(categorical),
            "numeric_columns": list(numeric), "categorical_columns": list(categorical),
            "trained_on": "dataset", "n_train": train.count()}
    save_bundle(model.pipeline(), bundle_metadata(train, numeric, categorical, label), info, path)
    return info


def train_from_signals(df: DataFrame, samples: str, key: str, label: str, path: str,
                       features: Sequence[str] = TIME_FEATURES,
                       candidates: Sequence[str] = ("logistic_regression", "random_forest")
                       ) -> DataFrame:
    """Time-domain signal features per row, both classes required, stratified 25%
    holdout (every row on both sides for tiny sets), best candidate by holdout macro F1,
    saved as a bundle with the features' ranges, profiles and medians.

    A row without samples stops the job and names how many there are: training on zeros in
    place of a failed file would be silent damage."""
    feats = freeze(time_domain_features(df, samples).select(
        key, label, F.size(F.col(samples)).alias("__size"), *features))
    c = feats.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"),
                  F.count_if(F.coalesce(F.col("__size"), F.lit(-1)) <= 0).alias("bad")).first()
    if c["bad"]:
        raise ValueError(f"{c['bad']} files have no samples; remove or re-encode them first")
    if c["p"] == 0 or c["n"] == 0:
        raise ValueError("training needs rows of both classes")
    s = freeze(stratified_split(feats.drop("__size"), label, key, 0.25, tiny_in_both=True))
    train = s.filter(F.col("is_test").isin(0, 2)).drop("is_test")
    test = s.filter(F.col("is_test").isin(1, 2)).drop("is_test")
    model, name, f1 = _pick(train, test, list(features), [], label, key, candidates)
    info = {"model_name": name, "f1_macro": f1, "feature_columns": list(features),
            "numeric_columns": list(features), "categorical_columns": [],
            "trained_on": "local_audio", "n_train_songs": int(c["p"] + c["n"]),
            "n_hit": int(c["p"]), "n_not_hit": int(c["n"])}
    save_bundle(model.pipeline(), bundle_metadata(train, list(features), [], label), info, path)
    return df.sparkSession.createDataFrame(
        [(name, f1, info["n_train_songs"], "local_audio", info["n_hit"], info["n_not_hit"])],
        "model_name string, f1_macro double, n_train_songs long, trained_on string, "
        "n_hit long, n_not_hit long")
