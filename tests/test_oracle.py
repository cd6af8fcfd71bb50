"""Every registered query with SQL must agree with DuckDB at sf0.01; the others keep their
own invariants."""

import os

import pytest

from harrow.ml import models as M
from harrow.plans import catalog
from harrow.plans.queries_ml import FAMILIES
from tests.oracle import compare, duck

SF = os.environ.get("HARROW_TEST_SF", "/root/testdata/sf0.01")
# Whole grids over all families, strategies and folds: the same work on fewer rows.
SMALL = os.environ.get("HARROW_TEST_SMALL_SF", "/root/testdata/sf0.001")
GRIDS = ("m07_compare_strategies", "m08_tune", "e14_run_experiment")
catalog.load_all()
NAMES = sorted(catalog.ORACLE)
METRICS = ("accuracy", "precision_macro", "recall_macro", "f1_macro", "roc_auc")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLE[name], SF)
    assert not problems, problems


def _metrics(rows, count=1):
    assert len(rows) == count
    for r in rows:
        assert all(0.0 <= r[m] <= 1.0 for m in METRICS)
        assert r["accuracy"] > 0.4 and r["roc_auc"] > 0.45


def _tuned(rows):
    _metrics(rows)
    assert 0 < rows[0]["cv_f1_macro_mean"] <= 1 and rows[0]["cv_f1_macro_std"] >= 0


def _strategies(rows):
    assert {(r["model"], r["imbalance"]) for r in rows} == {
        (m, i) for m in FAMILIES for i in ("none", "balanced", "smote")}
    assert all(0 < r["f1_macro_mean"] <= 1 and r["f1_macro_std"] >= 0 for r in rows)


def _importance(rows):
    assert len(rows) == 15 and [r["importance"] for r in rows] == sorted(r["importance"] for r in rows)
    assert 0 < sum(r["importance"] for r in rows) <= 1.000001


def _bundle(rows):
    kinds = {r["kind"] for r in rows}
    assert kinds == {"numeric", "categorical"} and len({r["model_name"] for r in rows}) == 1
    assert all(r["lo"] <= r["median"] <= r["hi"] for r in rows if r["kind"] == "numeric")


def _signals(rows):
    (r,) = rows
    assert r["n_features"] == 3 and r["n_hit"] + r["n_not_hit"] == r["n_train_songs"]
    assert 0 < r["f1_macro"] <= 1 and r["saved_model"] == r["model_name"]


def _experiment(rows):
    names = {run: {r["artefact"] for r in rows if r["run"] == run} for run in ("natural", "balanced")}
    assert names["balanced"] - names["natural"] == {"sampling_report"} and len(names["natural"]) == 14
    assert all(r["rows"] > 0 for r in rows if r["artefact"] != "genre_group_metrics")
    assert all(0.4 < r["best_f1_macro"] <= 1 for r in rows if r["artefact"] == "model_comparison")


INVARIANTS = {
    "m01_logistic_regression": _metrics, "m02_random_forest": _metrics,
    "m03_boosted_trees": _metrics, "m06_fit_with_smote": _metrics, "m08_tune": _tuned,
    "m07_compare_strategies": _strategies, "m09_feature_importance": _importance,
    "m11_train_bundle": _bundle, "m15_train_from_signals": _signals,
    "e14_run_experiment": _experiment,
}


def _fewer(points):
    """Settings with a tenth of the trees and rounds."""
    def less(key, value):
        if key not in ("numTrees", "maxIter"):
            return value
        return [v // 10 for v in value] if isinstance(value, list) else value // 10
    return {f: {k: less(k, v) for k, v in p.items()} for f, p in points.items()}


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_query_without_oracle_keeps_its_invariants(spark, name, monkeypatch):
    sf = SMALL if name in GRIDS else SF
    if name == "e14_run_experiment":
        # All its parts are tested at full size by m07 and m08; here it is their wiring.
        for table in ("CV_DEFAULTS", "GRIDS", "TUNED"):
            monkeypatch.setattr(M, table, _fewer(getattr(M, table)))
    INVARIANTS[name](catalog.QUERIES[name](spark, sf).collect())
