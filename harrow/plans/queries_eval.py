"""Evaluation queries (E1-E13) on the scored stand-in and the temporal holdout."""

from __future__ import annotations

from pyspark.sql import functions as F

from harrow.operators import evaluate as E
from harrow.plans import fixtures as FX
from harrow.plans.catalog import register, with_ctes
from harrow.plans.flagship import fairness_flagship, holdout_scored

SC = FX.SCORED_CTE


def macro_sql(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, str]:
    """SQL twin of ``macro_from_counts``."""
    has1 = f"(({tp} + {fn} + {fp}) > 0)"
    has0 = f"(({tn} + {fp} + {fn}) > 0)"
    k = f"(CAST({has1} AS INTEGER) + CAST({has0} AS INTEGER))"

    def r(n, d):
        return f"(CASE WHEN ({d}) > 0 THEN CAST({n} AS DOUBLE) / ({d}) ELSE 0.0 END)"

    def macro(a, b):
        return (f"(CASE WHEN {k} > 0 THEN ((CASE WHEN {has1} THEN {a} ELSE 0.0 END) + "
                f"(CASE WHEN {has0} THEN {b} ELSE 0.0 END)) / {k} END)")
    n = f"({tn} + {fp} + {fn} + {tp})"
    return {
        "accuracy": f"(CASE WHEN {n} > 0 THEN CAST({tn} + {tp} AS DOUBLE) / {n} END)",
        "precision_macro": macro(r(tp, f"{tp} + {fp}"), r(tn, f"{tn} + {fn}")),
        "recall_macro": macro(r(tp, f"{tp} + {fn}"), r(tn, f"{tn} + {fp}")),
        "f1_macro": macro(r(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
                          r(f"2 * {tn}", f"2 * {tn} + {fn} + {fp}")),
    }


def counts_sql(t="y_true", p="y_pred") -> str:
    return (f"count(*) FILTER (WHERE {t} = 0 AND {p} = 0) AS tn, "
            f"count(*) FILTER (WHERE {t} = 0 AND {p} = 1) AS fp, "
            f"count(*) FILTER (WHERE {t} = 1 AND {p} = 0) AS fn, "
            f"count(*) FILTER (WHERE {t} = 1 AND {p} = 1) AS tp")


def groups_sql(src: str, t="y_true", s="y_score") -> str:
    return f"""
g AS (SELECT CAST({s} AS DOUBLE) AS score, CAST(sum({t}) AS BIGINT) AS pos,
             CAST(sum(1 - {t}) AS BIGINT) AS neg
      FROM {src} WHERE {s} IS NOT NULL GROUP BY {s}),
ga AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS cum_neg FROM g),
auc AS (SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
                    THEN sum(pos * (cum_neg - neg + neg / 2)) / (sum(pos) * sum(neg)) END
               AS roc_auc FROM ga),
cu AS (SELECT score, pos, neg, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
              row_number() OVER (ORDER BY score DESC) AS idx
       FROM g WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
ap AS (SELECT CASE WHEN sum(pos) > 0 THEN sum(pos * tps / (tps + fps)) / sum(pos) END
              AS average_precision FROM cu)"""


M = macro_sql()


@register("e01_classification_metrics", with_ctes(SC, groups_sql("scored")) + f""",
c AS (SELECT {counts_sql()} FROM scored)
SELECT {M['accuracy']} AS accuracy, {M['precision_macro']} AS precision_macro,
       {M['recall_macro']} AS recall_macro, {M['f1_macro']} AS f1_macro, roc_auc
FROM c, auc""", doubles=["accuracy", "precision_macro", "recall_macro", "f1_macro", "roc_auc"])
def e01_classification_metrics(spark, sf):
    return E.classification_metrics(FX.scored(spark, sf))


@register("e02_roc_auc", with_ctes(SC, groups_sql("scored")) + """
SELECT roc_auc FROM auc""", doubles=["roc_auc"])
def e02_roc_auc(spark, sf):
    return E.roc_auc(FX.scored(spark, sf))


ROC_SQL = """,
tot AS (SELECT max(idx) AS m, max(tps) AS P, max(fps) AS N FROM cu),
nb AS (SELECT cu.*, lag(tps) OVER (ORDER BY idx) AS tps_p, lag(fps) OVER (ORDER BY idx) AS fps_p,
              lead(tps) OVER (ORDER BY idx) AS tps_n, lead(fps) OVER (ORDER BY idx) AS fps_n
       FROM cu),
kept AS (SELECT nb.*, m, P, N FROM nb, tot
         WHERE idx = 1 OR idx = m OR (fps_n - 2 * fps + fps_p) != 0
               OR (tps_n - 2 * tps + tps_p) != 0),
roc AS (
  SELECT CAST(0 AS BIGINT) AS position, CAST('inf' AS DOUBLE) AS threshold,
         CASE WHEN N > 0 THEN 0.0 END AS fpr, CASE WHEN P > 0 THEN 0.0 END AS tpr FROM tot
  UNION ALL
  SELECT row_number() OVER (ORDER BY idx) AS position, score AS threshold,
         CASE WHEN N > 0 THEN fps / N END AS fpr, CASE WHEN P > 0 THEN tps / P END AS tpr
  FROM kept)"""


@register("e03_roc_curve", with_ctes(SC, groups_sql("scored")) + ROC_SQL + """
SELECT * FROM roc""", doubles=["threshold", "fpr", "tpr"])
def e03_roc_curve(spark, sf):
    return E.roc_curve(FX.scored(spark, sf))


# From the definition: at threshold t, the share of positives among scores >= t, and the
# share of all positives that these are.
PR_SQL = """,
thr AS (SELECT score AS t, sum(pos) AS p, sum(pos + neg) AS n FROM (
  SELECT y_score AS score, CAST(y_true = 1 AS INTEGER) AS pos, CAST(y_true <> 1 AS INTEGER) AS neg
  FROM scored WHERE y_score IS NOT NULL AND y_true IS NOT NULL) AS x GROUP BY score),
pr AS (
  SELECT row_number() OVER (ORDER BY t) - 1 AS position, t AS threshold,
         CAST(sum(p) OVER (ORDER BY t DESC) AS DOUBLE) / sum(n) OVER (ORDER BY t DESC) AS precision,
         CASE WHEN sum(p) OVER () > 0 THEN CAST(sum(p) OVER (ORDER BY t DESC) AS DOUBLE)
              / sum(p) OVER () END AS recall
  FROM thr
  UNION ALL
  SELECT count(*), NULL, 1.0, 0.0 FROM thr)"""


@register("e04_pr_curve", with_ctes(SC, groups_sql("scored")) + PR_SQL + """
SELECT * FROM pr""", doubles=["threshold", "precision", "recall"])
def e04_pr_curve(spark, sf):
    return E.pr_curve(FX.scored(spark, sf))


@register("e04_average_precision", with_ctes(SC, groups_sql("scored")) + """
SELECT average_precision FROM ap""", doubles=["average_precision"])
def e04_average_precision(spark, sf):
    return E.average_precision(FX.scored(spark, sf))


def _r(n, d):
    return f"CASE WHEN ({d}) > 0 THEN CAST({n} AS DOUBLE) / ({d}) END"


def _pct(a, b):
    return f"CASE WHEN ({a} + {b}) > 0 THEN {a} * 100.0 / ({a} + {b}) ELSE 0.0 END"


@register("e05_confusion_matrix", with_ctes(SC) + f""",
c AS (SELECT {counts_sql()} FROM scored)
SELECT tn, fp, fn, tp, tn + fp + fn + tp AS total,
       {_r('tn + tp', 'tn + fp + fn + tp')} AS accuracy, {_r('tp', 'tp + fp')} AS precision,
       {_r('tp', 'tp + fn')} AS recall, {_r('tn', 'tn + fp')} AS specificity,
       {_r('fp', 'fp + tn')} AS false_positive_rate,
       {_r('fn + tp', 'tn + fp + fn + tp')} AS positive_rate,
       {_pct('tn', 'fp')} AS tn_row_pct, {_pct('fp', 'tn')} AS fp_row_pct,
       {_pct('fn', 'tp')} AS fn_row_pct, {_pct('tp', 'fn')} AS tp_row_pct
FROM c""", doubles=["accuracy", "precision", "recall", "specificity", "false_positive_rate",
                    "positive_rate", "tn_row_pct", "fp_row_pct", "fn_row_pct", "tp_row_pct"])
def e05_confusion_matrix(spark, sf):
    return E.confusion_matrix(FX.scored(spark, sf))


@register("e05_confusion_table", with_ctes(SC) + f""",
c AS (SELECT {counts_sql()} FROM scored)
SELECT 'actual_0' AS row_label, tn AS pred_0, fp AS pred_1 FROM c
UNION ALL SELECT 'actual_1', fn, tp FROM c""")
def e05_confusion_table(spark, sf):
    return E.confusion_table(FX.scored(spark, sf))


def by_group_sql(src: str, group: str) -> str:
    return f"""
bg AS (SELECT "{group}" AS "group", {counts_sql()} FROM {src}
       WHERE "{group}" IS NOT NULL GROUP BY "{group}"),
groups AS (SELECT "group", tn + fp + fn + tp AS n_samples, {M['accuracy']} AS accuracy,
                  {M['f1_macro']} AS f1_macro FROM bg)"""


@register("e06_metrics_by_group", with_ctes(SC, by_group_sql("scored", "group")) + """
SELECT * FROM groups""", doubles=["accuracy", "f1_macro"])
def e06_metrics_by_group(spark, sf):
    return E.metrics_by_group(FX.scored(spark, sf), "y_true", "y_pred", "group")


@register("e06_metrics_by_small_group", with_ctes(SC, by_group_sql("scored", "cust_group")) + """
SELECT * FROM groups""", doubles=["accuracy", "f1_macro"])
def e06_metrics_by_small_group(spark, sf):
    return E.metrics_by_group(FX.scored(spark, sf), "y_true", "y_pred", "cust_group")


def fairness_sql(min_n: int = 30) -> str:
    return f"""
k AS (SELECT * FROM groups WHERE n_samples >= {min_n}),
fair AS (
  SELECT {min_n} AS min_n, (SELECT count(*) FROM groups) AS groups_total,
         (SELECT count(*) FROM k) AS groups_kept,
         (SELECT count(*) FROM groups WHERE n_samples < {min_n}) AS groups_excluded,
         (SELECT count(*) FROM groups WHERE n_samples < {min_n} AND f1_macro = 1.0)
           AS excluded_with_perfect_f1,
         (SELECT "group" FROM k ORDER BY f1_macro DESC, "group" LIMIT 1) AS f1_best_group,
         (SELECT max(f1_macro) FROM k) AS f1_best,
         (SELECT "group" FROM k ORDER BY f1_macro ASC, "group" LIMIT 1) AS f1_worst_group,
         (SELECT min(f1_macro) FROM k) AS f1_worst,
         (SELECT max(f1_macro) - min(f1_macro) FROM k) AS f1_disparity,
         (SELECT avg(f1_macro) FROM k) AS f1_mean,
         (SELECT stddev_samp(f1_macro) FROM k) AS f1_std)"""


FAIR_DOUBLES = ["f1_best", "f1_worst", "f1_disparity", "f1_mean", "f1_std"]


@register("e07_fairness_summary", with_ctes(SC, by_group_sql("scored", "cust_group"),
                                            fairness_sql(30)) + """
SELECT * FROM fair""", doubles=FAIR_DOUBLES)
def e07_fairness_summary(spark, sf):
    g = E.metrics_by_group(FX.scored(spark, sf), "y_true", "y_pred", "cust_group")
    return E.fairness_summary(g, 30)


ZOO_SQL = """
zoo AS (SELECT 'linear' AS model, y_true, y_score AS p FROM scored
        UNION ALL SELECT 'squared', y_true, y_score * y_score FROM scored
        UNION ALL SELECT 'root', y_true, sqrt(y_score) FROM scored)"""


def model_zoo(spark, sf):
    s = FX.scored(spark, sf)
    return (s.select(F.lit("linear").alias("model"), "y_true", F.col("y_score").alias("p"))
            .unionByName(s.select(F.lit("squared").alias("model"), "y_true",
                                  (F.col("y_score") * F.col("y_score")).alias("p")))
            .unionByName(s.select(F.lit("root").alias("model"), "y_true",
                                  F.sqrt("y_score").alias("p"))))


_bin_sql = " + ".join(f"CAST(p > CAST({k} AS DOUBLE) * (CAST(1 AS DOUBLE) / 10) AS INTEGER)"
                      for k in range(1, 10))


@register("e08_calibration_table", with_ctes(SC, ZOO_SQL) + f""",
b AS (SELECT model, p, CAST(y_true AS DOUBLE) AS y, {_bin_sql} AS bin FROM zoo),
br AS (SELECT model, avg((p - y) * (p - y)) AS brier_score FROM b GROUP BY model)
SELECT b.model, bin, avg(p) AS predicted_probability, avg(y) AS observed_frequency,
       any_value(brier_score) AS brier_score, 10 AS n_bins
FROM b JOIN br ON b.model = br.model GROUP BY b.model, bin""",
          doubles=["predicted_probability", "observed_frequency", "brier_score"])
def e08_calibration_table(spark, sf):
    return E.calibration_table(model_zoo(spark, sf), "y_true", "p", "model", 10)


@register("e09_brier_score", with_ctes(SC, ZOO_SQL) + """
SELECT model, avg((p - y_true) * (p - y_true)) AS brier_score FROM zoo GROUP BY model""",
          doubles=["brier_score"])
def e09_brier_score(spark, sf):
    return E.brier_score(model_zoo(spark, sf), "y_true", "p", "model")


@register("e12_curves_summary", with_ctes(SC, groups_sql("scored")) + """
SELECT count(*) AS n_test, avg(CAST(y_true AS DOUBLE)) AS positive_rate,
       any_value(roc_auc) AS roc_auc, any_value(average_precision) AS average_precision
FROM scored, auc, ap""", doubles=["positive_rate", "roc_auc", "average_precision"])
def e12_curves_summary(spark, sf):
    return E.curves_summary(FX.scored(spark, sf))


def _thin_sql(src: str, max_points: int = 300) -> str:
    """Rows of ``src`` at positions int(j * (n-1)/(max_points-1)); all when n fits."""
    return f"""(
  SELECT s.* FROM {src} s, (SELECT count(*) AS n FROM {src}) c
  WHERE c.n <= {max_points} OR s.position IN (
    SELECT CASE WHEN j = {max_points - 1} THEN n - 1
                ELSE CAST(trunc(CAST(j AS DOUBLE) * ((n - 1) / CAST({max_points - 1} AS DOUBLE)))
                          AS BIGINT) END
    FROM range({max_points}) t(j), (SELECT count(*) AS n FROM {src}) c2))"""


@register("e12_thinned_curves", with_ctes(SC, groups_sql("scored")) + ROC_SQL + PR_SQL + f"""
SELECT 'roc' AS curve, position, fpr AS x, tpr AS y FROM {_thin_sql('roc')} r
UNION ALL
SELECT 'pr', position, recall, precision FROM {_thin_sql('pr')} p""", doubles=["x", "y"])
def e12_thinned_curves(spark, sf):
    return E.thinned_curves(FX.scored(spark, sf))


# --- the temporal holdout (flagship path) -----------------------------------

HOLDOUT_SQL = FX.LABELLED_CTE + """,
ranked AS (SELECT *, row_number() OVER (ORDER BY first_week, track_key) AS rn,
                  count(*) OVER () AS n FROM labelled),
holdout AS (SELECT track_key, hit AS y_true, (acctbal + 1000) / 11000 AS y_score,
                   CAST((acctbal + 1000) / 11000 >= 0.5 AS INTEGER) AS y_pred, nation AS "group"
            FROM ranked WHERE rn > CAST(floor(CAST(0.8 AS DOUBLE) * n) AS BIGINT))"""


@register("e06_holdout_group_metrics", with_ctes(HOLDOUT_SQL, by_group_sql("holdout", "group"))
          + """
SELECT * FROM groups""", doubles=["accuracy", "f1_macro"])
def e06_holdout_group_metrics(spark, sf):
    return E.metrics_by_group(holdout_scored(spark, sf), "y_true", "y_pred", "group")


@register("e07_flagship_fairness", with_ctes(HOLDOUT_SQL, by_group_sql("holdout", "group"),
                                             fairness_sql(30)) + """
SELECT * FROM fair""", doubles=FAIR_DOUBLES)
def e07_flagship_fairness(spark, sf):
    return fairness_flagship(spark, sf, 30)


@register("w05_thin_curve", with_ctes(SC, groups_sql("scored")) + ROC_SQL + f"""
SELECT position, fpr, tpr FROM {_thin_sql('roc')} r""", doubles=["fpr", "tpr"])
def w05_thin_curve(spark, sf):
    from harrow.operators.rank import thin_curve
    roc = E.roc_curve(FX.scored(spark, sf))
    return thin_curve(roc, "position", 300).select("position", "fpr", "tpr")
