"""Preprocessing fitted on training rows only.

Fitting computes a handful of statistics per column with distributed aggregates
(exact medians, population mean/std, most frequent value) and bakes them into a
``SQLTransformer`` stage as literals; categorical columns then go through
``StringIndexer`` (sorted labels, unknown kept) and ``OneHotEncoder`` (the unknown
slot is the dropped last one, so an unseen value encodes as all zeros).  The result
is an ordinary ``PipelineModel``: it saves, loads and scores like any Spark model.

Category labels are part of the model and so live on the driver and in every task: a
column of more than some 100,000 values must go through ``keep_frequent_categories`` (J3)
first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harrow.functions.columns import number
from harrow.operators.rank import exact_medians


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(float(v))


def fit_numeric_stats(train: DataFrame, numeric: Sequence[str]) -> dict[str, dict]:
    """F1 + F2 statistics: median (for imputation), then mean and population std of
    the imputed column.  Columns with no values at all are dropped (as the reference's
    imputer does)."""
    if not numeric:
        return {}
    med = {r["feature"]: r["median"] for r in exact_medians(train, list(numeric)).collect()}
    kept = [c for c in numeric if med.get(c) is not None]
    if not kept:
        return {}
    aggs = []
    for i, c in enumerate(kept):
        v = F.coalesce(number(c), F.lit(med[c]))
        aggs += [F.avg(v).alias(f"m{i}"), F.stddev_pop(v).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    out = {}
    for i, c in enumerate(kept):
        std = row[f"s{i}"]
        out[c] = {"median": med[c], "mean": row[f"m{i}"],
                  "scale": std if std is not None and std > 0 else 1.0}
    return out


def fit_modes(train: DataFrame, categorical: Sequence[str]) -> dict[str, str | None]:
    """most frequent non-null value per column; ties go to the smallest value.

    One pass: (column, value) pairs counted with partial aggregation, then the best
    per column with ``min_by`` - no per-column scans, no value lists on one task."""
    if not categorical:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v"))
                                for c in categorical]))
    counts = (train.select(pairs.alias("p")).select("p.c", "p.v").filter(F.col("v").isNotNull())
              .groupBy("c", "v").agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("c").agg(F.min_by("v", F.struct((-F.col("n")).alias("n"),
                                                          F.col("v").alias("v"))).alias("mode"))
    found = {r["c"]: r["mode"] for r in best.collect()}
    return {c: found.get(c) for c in categorical}


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                     features_col: str = "features") -> PipelineModel:
    """impute (median / most frequent), scale (ddof 0), one-hot, assemble."""
    stats = fit_numeric_stats(train, numeric)
    modes = fit_modes(train, categorical)
    num_exprs = [f"(coalesce(nanvl(CAST({_q(c)} AS DOUBLE), CAST(NULL AS DOUBLE)), "
                 f"{_lit(s['median'])}) - {_lit(s['mean'])})"
                 f" / {_lit(s['scale'])} AS {_q('__num_' + c)}" for c, s in stats.items()]
    cat_exprs = [f"coalesce(CAST({_q(c)} AS STRING), {_lit(modes[c] if modes[c] is not None else '')})"
                 f" AS {_q('__cat_' + c)}" for c in categorical]
    statement = "SELECT *" + "".join(", " + e for e in num_exprs + cat_exprs) + " FROM __THIS__"
    stages = [SQLTransformer(statement=statement)]
    encoded = []
    if categorical:
        idx_cols = [f"__idx_{c}" for c in categorical]
        stages.append(StringIndexer(inputCols=[f"__cat_{c}" for c in categorical],
                                    outputCols=idx_cols, stringOrderType="alphabetAsc",
                                    handleInvalid="keep"))
        encoded = [f"__ohe_{c}" for c in categorical]
        # The indexer's extra slot for unseen values is the last one, which is dropped.
        stages.append(OneHotEncoder(inputCols=idx_cols, outputCols=encoded, dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"__num_{c}" for c in stats] + encoded,
                                  outputCol=features_col, handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def drop_work_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__num_") or c.startswith("__cat_")
                     or c.startswith("__idx_") or c.startswith("__ohe_")])


def feature_names(model: PipelineModel, numeric: Sequence[str],
                  categorical: Sequence[str]) -> list[str]:
    """Names of the assembled slots: numeric columns that had values, then
    ``column_value`` per one-hot slot (as used by M9)."""
    slots = model.stages[-1].getInputCols()
    names = [c for c in numeric if f"__num_{c}" in slots]
    indexers = [s for s in model.stages if s.__class__.__name__ == "StringIndexerModel"]
    if indexers:
        for c, labels in zip(categorical, indexers[0].labelsArray):
            names += [f"{c}_{v}" for v in labels]
    return names
