"""Evaluation of scored rows.

Input contract: ``y_true`` int 0/1, ``y_pred`` int 0/1, ``y_score`` double, optional
group column.  Counts come from one aggregate; curves from prefix sums over the
distinct scores (``ordered_cumsum``), never from a one-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.operators.joins import attach
from harrow.operators.rank import ordered_cumsum, thin_curve, thin_position

# Hypothesis thresholds (fixed values).
H1_ACCURACY = 0.70
H3_DISPARITY = 0.1
ENSEMBLE_FAMILIES = ("random_forest", "xgboost", "boosted_trees")
LINEAR_FAMILY = "logistic_regression"


def _ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 (zero_division = 0)."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


def _ratio_or_null(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den)


def confusion_counts(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> list:
    t, p = F.col(y_true), F.col(y_pred)
    return [F.count_if((t == 0) & (p == 0)).alias("tn"), F.count_if((t == 0) & (p == 1)).alias("fp"),
            F.count_if((t == 1) & (p == 0)).alias("fn"), F.count_if((t == 1) & (p == 1)).alias("tp")]


def macro_from_counts(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Macro precision / recall / F1 over the labels seen in y_true or y_pred."""
    has1 = (tp + fn + fp) > 0
    has0 = (tn + fp + fn) > 0
    k = has1.cast("int") + has0.cast("int")
    p1, p0 = _ratio(tp, tp + fp), _ratio(tn, tn + fn)
    r1, r0 = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    f1, f0 = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fn + fp)

    def macro(a, b):
        s = F.when(has1, a).otherwise(0.0) + F.when(has0, b).otherwise(0.0)
        return F.when(k > 0, s / k)
    n = tn + fp + fn + tp
    return {"accuracy": _ratio_or_null(tn + tp, n), "precision_macro": macro(p1, p0),
            "recall_macro": macro(r1, r0), "f1_macro": macro(f1, f0)}


# E1 -------------------------------------------------------------------------
def classification_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                           y_score: str | None = "y_score") -> DataFrame:
    """Accuracy and macro precision / recall / F1 (zero_division 0); AUC if scores."""
    counts = df.agg(*confusion_counts(df, y_true, y_pred))
    m = macro_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    out = counts.select(*[v.alias(k) for k, v in m.items()])
    if y_score:
        out = attach(out, roc_auc(df, y_true, y_score))
    return out


# E2 -------------------------------------------------------------------------
def _score_groups(df: DataFrame, y_true: str, y_score: str) -> DataFrame:
    """Rows per distinct score: positives, negatives (partial aggregation first)."""
    y = F.col(y_true).cast("long")
    return (df.filter(F.col(y_score).isNotNull())
            .groupBy(F.col(y_score).cast("double").alias("score"))
            .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"), F.lit(1).alias("one")))


def roc_auc(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score") -> DataFrame:
    """Area under ROC, ties counted half; null when only one class is present."""
    g = _score_groups(df, y_true, y_score)
    cum = ordered_cumsum(g, [F.col("score").asc()], ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    agg = cum.agg(F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("u"),
                  F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(F.when((F.col("P") > 0) & (F.col("N") > 0),
                             F.col("u") / (F.col("P") * F.col("N"))).alias("roc_auc"))


def _descending_counts(df: DataFrame, y_true: str, y_score: str) -> DataFrame:
    """Cumulative tps/fps at each distinct threshold, highest first, 1-based ``idx``."""
    g = _score_groups(df, y_true, y_score)
    return ordered_cumsum(g, [F.col("score").desc()], ["pos", "neg", "one"])


def metrics_per(df: DataFrame, by: Sequence[str], y_true: str = "y_true", y_pred: str = "y_pred",
                y_score: str = "y_score") -> DataFrame:
    """E1 with AUC for every group at once (many models, folds or days): counts in one
    aggregate, AUC from one range layout over (group, score) with sums that restart per group."""
    df = df.withColumn("__g", F.struct(*by))
    m = macro_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    counts = (df.groupBy("__g").agg(*confusion_counts(df, y_true, y_pred))
              .select("__g", *[v.alias(k) for k, v in m.items()]))
    y = F.col(y_true).cast("long")
    scores = (df.filter(F.col(y_score).isNotNull())
              .groupBy("__g", F.col(y_score).cast("double").alias("score"))
              .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))
    cum = ordered_cumsum(scores, ["__g", "score"], ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    # Negatives of earlier groups are in every running sum of a group alike.
    auc = cum.groupBy("__g").agg(
        F.sum(F.col("pos") * (below + F.col("neg") / 2)).alias("u"), F.min(below).alias("low"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = auc.select("__g", F.when((F.col("P") > 0) & (F.col("N") > 0), (
        F.col("u") - F.col("low") * F.col("P")) / (F.col("P") * F.col("N"))).alias("roc_auc"))
    return counts.join(auc, "__g", "left").select("__g.*", *m, "roc_auc")


def _segments(df: DataFrame, by: Sequence[str], y_true: str, y_score: str) -> DataFrame:
    """Per group and distinct score, highest first: ``pos`` and ``neg`` there, ``idx`` (from 1),
    ``tps`` and ``fps`` up to it, ``m``, ``P`` and ``N`` of the group and the ``next`` row.

    One range layout over (group, score) for all groups; running sums restart per group by
    taking off what they held at its start, so one group with most of the rows is spread."""
    y = F.col(y_true).cast("long")
    group = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    scores = (df.withColumn("__g", group).filter(F.col(y_score).isNotNull())
              .groupBy("__g", F.col(y_score).cast("double").alias("score"))
              .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"), F.lit(1).alias("one")))
    cum = ordered_cumsum(scores, ["__g", F.col("score").desc()], ["pos", "neg", "one"],
                         following=["pos", "neg"])
    totals = [F.min(F.col(f"cum_{v}") - F.col(v)).alias(f"s_{v}") for v in ("pos", "neg", "one")]
    totals += [F.sum("pos").alias("P"), F.sum("neg").alias("N"), F.sum("one").alias("m")]
    joined = (cum.join(cum.groupBy("__g").agg(*totals), "__g") if by
              else attach(cum, cum.agg(*totals)))
    return joined.select("__g", "score", "pos", "neg", "next", "m", "P", "N", *[
        (F.col(f"cum_{v}") - F.col(f"s_{v}")).alias(n)
        for v, n in (("pos", "tps"), ("neg", "fps"), ("one", "idx"))])


def _ends(curve: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row of ``m``, ``P`` and ``N`` per group; without groups always one row."""
    sums = [F.max(c).alias(c) for c in ("m", "P", "N")]
    return curve.groupBy("__g").agg(*sums) if by else curve.agg(F.max("__g").alias("__g"), *sums)


# E3 -------------------------------------------------------------------------
def roc_curve(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score",
              drop_intermediate: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """(position, threshold, fpr, tpr) by descending threshold, (0, 0) first, collinear
    interior points dropped; of every group of ``by`` in one pass.

    A point is collinear if the step to it and the step after it are the same, so a row only
    needs the counts of the next one: no self-join."""
    rows = _segments(df, by, y_true, y_score)
    ends = _ends(rows, by)
    if drop_intermediate:
        bend = (F.col("next.pos") != F.col("pos")) | (F.col("next.neg") != F.col("neg"))
        kept = rows.filter((F.col("idx") == 1) | (F.col("idx") == F.col("m")) | bend)
        kept = ordered_cumsum(kept.withColumn("k", F.lit(1)), ["__g", "idx"], ["k"])
        # The first point of a group says how many came before the group.
        first = kept.where("idx = 1").select("__g", (F.col("cum_k") - 1).alias("before"))
        kept = kept.join(first, "__g") if by else kept.withColumn("before", F.lit(0))
        rows = kept.withColumn("position", F.col("cum_k") - F.col("before"))
    else:
        rows = rows.withColumn("position", F.col("idx"))
    own = [F.col(f"__g.{c}").alias(c) for c in by]
    pts = rows.select(*own, "position", F.col("score").alias("threshold"),
                      F.when(F.col("N") > 0, F.col("fps") / F.col("N")).alias("fpr"),
                      F.when(F.col("P") > 0, F.col("tps") / F.col("P")).alias("tpr"))
    origin = ends.select(*own, F.lit(0).cast("long").alias("position"),
                         F.lit(float("inf")).alias("threshold"),
                         F.when(F.col("N") > 0, F.lit(0.0)).alias("fpr"),
                         F.when(F.col("P") > 0, F.lit(0.0)).alias("tpr"))
    return origin.unionByName(pts)


# E4 -------------------------------------------------------------------------
def pr_curve(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score",
             by: Sequence[str] = ()) -> DataFrame:
    """(position, threshold, precision, recall) at every distinct threshold, lowest
    first, then the closing point (recall 0, precision 1); of every group of ``by``."""
    rows = _segments(df, by, y_true, y_score)
    own = [F.col(f"__g.{c}").alias(c) for c in by]
    pts = rows.select(*own, (F.col("m") - F.col("idx")).alias("position"),
                      F.col("score").alias("threshold"),
                      (F.col("tps") / (F.col("tps") + F.col("fps"))).alias("precision"),
                      F.when(F.col("P") > 0, F.col("tps") / F.col("P")).alias("recall"))
    end = _ends(rows, by).where("m is not null").select(
        *own, F.col("m").alias("position"), F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score") -> DataFrame:
    """Sum over thresholds (descending) of (R_k - R_{k-1}) * P_k."""
    cum = _descending_counts(df, y_true, y_score)
    agg = cum.agg(F.sum(F.col("pos") * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
                  .alias("s"), F.sum("pos").alias("P"))
    return agg.select(F.when(F.col("P") > 0, F.col("s") / F.col("P")).alias("average_precision"))


# E5 -------------------------------------------------------------------------
def confusion_matrix(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """E5: the four counts, rates (null on a zero denominator) and percent of row."""
    c = df.agg(*confusion_counts(df, y_true, y_pred))
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    total = tn + fp + fn + tp
    pct = lambda a, b: F.when(a + b > 0, a * 100.0 / (a + b)).otherwise(F.lit(0.0))
    return c.select(
        "tn", "fp", "fn", "tp", total.alias("total"),
        _ratio_or_null(tn + tp, total).alias("accuracy"),
        _ratio_or_null(tp, tp + fp).alias("precision"),
        _ratio_or_null(tp, tp + fn).alias("recall"),
        _ratio_or_null(tn, tn + fp).alias("specificity"),
        _ratio_or_null(fp, fp + tn).alias("false_positive_rate"),
        _ratio_or_null(fn + tp, total).alias("positive_rate"),
        pct(tn, fp).alias("tn_row_pct"), pct(fp, tn).alias("fp_row_pct"),
        pct(fn, tp).alias("fn_row_pct"), pct(tp, fn).alias("tp_row_pct"))


def confusion_table(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """E5: the stored 2x2 layout (row label, pred_0, pred_1)."""
    c = df.agg(*confusion_counts(df, y_true, y_pred))
    rows = F.array(
        F.struct(F.lit("actual_0").alias("row_label"), F.col("tn").alias("pred_0"),
                 F.col("fp").alias("pred_1")),
        F.struct(F.lit("actual_1").alias("row_label"), F.col("fn").alias("pred_0"),
                 F.col("tp").alias("pred_1")))
    return c.select(F.explode(rows).alias("r")).select("r.*")


# E6 -------------------------------------------------------------------------
def metrics_by_group(df: DataFrame, y_true: str, y_pred: str, group: str) -> DataFrame:
    """N, accuracy, macro F1 per non-null group, best first.

    A plain hash aggregate (partial aggregation first), so a hot group costs nothing
    extra.  A group holding only true negatives scores 1.0: one label is present."""
    if group not in df.columns:
        raise ValueError(f"no column {group!r} to group by")
    g = df.filter(F.col(group).isNotNull()).groupBy(group).agg(*confusion_counts(df, y_true, y_pred))
    m = macro_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp"))
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return g.select(F.col(group).alias("group"), n.alias("n_samples"), m["accuracy"].alias("accuracy"),
                    m["f1_macro"].alias("f1_macro")).orderBy(F.col("f1_macro").desc(), "group")


# E7 -------------------------------------------------------------------------
def fairness_summary(groups: DataFrame, min_n: int = 30) -> DataFrame:
    """One row over the per-group table; best / worst null when no group is kept.
    Ties go to the smallest group name."""
    kept = F.col("n_samples") >= min_n
    f1 = F.col("f1_macro")
    agg = groups.agg(
        F.count(F.lit(1)).alias("groups_total"),
        F.count_if(kept).alias("groups_kept"),
        F.count_if(~kept).alias("groups_excluded"),
        F.count_if(~kept & (f1 == 1.0)).alias("excluded_with_perfect_f1"),
        F.min_by(F.when(kept, F.col("group")), F.when(kept, F.struct((-f1).alias("a"),
                                                                     F.col("group").alias("b"))))
        .alias("f1_best_group"),
        F.max(F.when(kept, f1)).alias("f1_best"),
        F.min_by(F.when(kept, F.col("group")), F.when(kept, F.struct(f1.alias("a"),
                                                                     F.col("group").alias("b"))))
        .alias("f1_worst_group"),
        F.min(F.when(kept, f1)).alias("f1_worst"),
        F.avg(F.when(kept, f1)).alias("f1_mean"),
        F.stddev_samp(F.when(kept, f1)).alias("f1_std"))
    return agg.select(
        F.lit(min_n).alias("min_n"), "groups_total", "groups_kept", "groups_excluded",
        "excluded_with_perfect_f1", F.col("f1_best_group").cast("string"), "f1_best",
        F.col("f1_worst_group").cast("string"), "f1_worst",
        (F.col("f1_best") - F.col("f1_worst")).alias("f1_disparity"), "f1_mean", "f1_std")


# E8 / E9 ----------------------------------------------------------------------
def calibration_bin(score: Column, n_bins: int = 10) -> Column:
    """Number of interior edges strictly below the score (an edge value goes low)."""
    step = 1.0 / n_bins
    terms = [(score > F.lit(k * step)).cast("int") for k in range(1, n_bins)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def calibration_table(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score",
                      model: str | None = None, n_bins: int = 10) -> DataFrame:
    """Per (model, bin): mean score and observed rate; empty bins omitted; with E9."""
    keys = [F.col(model).alias("model")] if model else [F.lit("model").alias("model")]
    s = F.col(y_score).cast("double")
    base = df.select(*keys, s.alias("p"), F.col(y_true).cast("double").alias("y"))
    bins = (base.withColumn("bin", calibration_bin(F.col("p"), n_bins))
            .groupBy("model", "bin").agg(F.avg("p").alias("predicted_probability"),
                                         F.avg("y").alias("observed_frequency")))
    brier = brier_score(base, "y", "p", "model")
    return bins.join(brier, "model").withColumn("n_bins", F.lit(n_bins))


def brier_score(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score",
                model: str | None = None) -> DataFrame:
    """Mean squared gap between score and label (per model if given)."""
    sq = F.pow(F.col(y_score).cast("double") - F.col(y_true).cast("double"), 2)
    if model:
        return df.groupBy(model).agg(F.avg(sq).alias("brier_score"))
    return df.agg(F.avg(sq).alias("brier_score"))


# E10 ------------------------------------------------------------------------
def model_comparison(baselines: DataFrame, tuned: DataFrame) -> DataFrame:
    """Baselines first, then tuned rows, each in their given ``seq`` order."""
    b = baselines.withColumn("is_baseline", F.lit(1))
    t = tuned.withColumn("is_baseline", F.lit(0))
    both = b.unionByName(t, allowMissingColumns=True)
    return both.orderBy(F.col("is_baseline").desc(), F.col("seq").asc())


# E11 ------------------------------------------------------------------------
def hypothesis_verdicts(comparison: DataFrame, fairness: DataFrame,
                        majority: str = "baseline_majority_class",
                        random_name: str = "baseline_stratified_random",
                        ensembles: Sequence[str] = ENSEMBLE_FAMILIES,
                        linear: str = LINEAR_FAMILY) -> DataFrame:
    """H1 (accuracy > 0.70, beats random, beats majority), H2 (best ensemble's CV
    mean beats the linear model's by more than the summed std), H3 (disparity > 0.1)."""
    tuned = comparison.filter(F.col("is_baseline") == 0)
    base = comparison.filter(F.col("is_baseline") == 1)
    b = base.agg(F.max(F.when(F.col("model") == majority, F.col("accuracy"))).alias("acc_major"),
                 F.max(F.when(F.col("model") == random_name, F.col("accuracy"))).alias("acc_rand"),
                 F.max(F.when(F.col("model") == majority, F.col("f1_macro"))).alias("f1_major"))
    ens = F.col("model").isin(*ensembles)
    t = tuned.agg(
        F.max("accuracy").alias("best_accuracy"),
        F.max_by("model", F.struct(F.col("accuracy"), (-F.col("seq")).alias("s")))
        .alias("best_accuracy_model"),
        F.max("f1_macro").alias("best_f1"),
        F.max_by(F.when(ens, F.struct("cv_f1_macro_mean", "cv_f1_macro_std", "model")),
                 F.when(ens, F.struct(F.col("cv_f1_macro_mean"), (-F.col("seq")).alias("s"))))
        .alias("ens"),
        F.max(F.when(F.col("model") == linear, F.col("cv_f1_macro_mean"))).alias("lr_mean"),
        F.max(F.when(F.col("model") == linear, F.col("cv_f1_macro_std"))).alias("lr_std"))
    j = attach(attach(t, b), fairness.select("f1_disparity"))
    margin = F.col("ens.cv_f1_macro_mean") - F.col("lr_mean")
    noise = F.col("ens.cv_f1_macro_std") + F.col("lr_std")
    return j.select(
        "best_accuracy", "best_accuracy_model", "acc_rand", "acc_major", "best_f1", "f1_major",
        (F.col("best_accuracy") > H1_ACCURACY).cast("int").alias("h1_above_70"),
        (F.col("best_accuracy") > F.col("acc_rand")).cast("int").alias("h1_beats_random"),
        (F.col("best_accuracy") > F.col("acc_major")).cast("int").alias("h1_beats_majority"),
        F.col("ens.model").alias("best_ensemble"),
        margin.alias("h2_margin"), noise.alias("h2_noise"),
        (margin > 0).cast("int").alias("h2_beats_linear"),
        (margin > noise).cast("int").alias("h2_outside_noise"),
        F.col("f1_disparity"),
        (F.col("f1_disparity") > H3_DISPARITY).cast("int").alias("h3_disparity"))


# E12 ------------------------------------------------------------------------
def curves_summary(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score") -> DataFrame:
    """N, base rate, AUC, average precision; errors if empty or single class."""
    base = df.agg(F.count(F.lit(1)).alias("n_test"), F.avg(F.col(y_true).cast("double"))
                  .alias("positive_rate"), F.count_distinct(y_true).alias("classes")).first()
    if base["n_test"] == 0:
        raise ValueError("no rows to draw curves from")
    if base["classes"] < 2:
        raise ValueError("curves need rows of both classes")
    first = df.agg(F.count(F.lit(1)).alias("n_test"),
                   F.avg(F.col(y_true).cast("double")).alias("positive_rate"))
    return attach(attach(first, roc_auc(df, y_true, y_score)),
                  average_precision(df, y_true, y_score))


def thinned_curves(df: DataFrame, y_true: str = "y_true", y_score: str = "y_score",
                   max_points: int = 300, by: Sequence[str] = ()) -> DataFrame:
    """ROC and PR curves thinned to ``max_points`` each, tagged by ``curve``; of every
    group of ``by`` (a model, say) in one pass over the scores."""
    out = None
    for name, curve, x, y in (("roc", roc_curve(df, y_true, y_score, by=by), "fpr", "tpr"),
                              ("pr", pr_curve(df, y_true, y_score, by=by), "recall", "precision")):
        if by:
            last = curve.groupBy(*by).agg((F.max("position") + 1).alias("__n"))
            curve = curve.join(last, list(by)).where(
                thin_position(F.col("position"), F.col("__n"), max_points))
        else:
            curve = thin_curve(curve, "position", max_points)
        part = curve.select(*by, F.lit(name).alias("curve"), "position", F.col(x).alias("x"),
                            F.col(y).alias("y"))
        out = part if out is None else out.unionByName(part)
    return out


# E13 ------------------------------------------------------------------------
def holdout_integrity(before: DataFrame, after: DataFrame, label: str,
                      key_cols: Sequence[str]) -> DataFrame:
    """The holdout is unchanged: same rows, same label sum, same row-hash sum."""
    def sig(df, tag):
        h = F.xxhash64(*[F.col(c) for c in key_cols], F.col(label))
        return df.agg(F.count(F.lit(1)).alias(f"n_{tag}"),
                      F.sum(F.col(label).cast("long")).alias(f"pos_{tag}"),
                      F.sum(h.cast("decimal(38,0)")).alias(f"h_{tag}"))
    j = attach(sig(before, "before"), sig(after, "after"))
    return j.select(
        "n_before", "n_after",
        (F.col("pos_before") / F.col("n_before")).alias("rate_before"),
        (F.col("pos_after") / F.col("n_after")).alias("rate_after"),
        ((F.col("n_before") == F.col("n_after")) & (F.col("pos_before") == F.col("pos_after"))
         & (F.col("h_before") == F.col("h_after"))).cast("int").alias("unchanged"))
