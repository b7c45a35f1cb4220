"""Model fit / score jobs on DataFrames.

The lookup baseline is pure SQL (groupBy + broadcast join of a table bounded
by 24 x 7 rows).  Linear and boosted models use ``pyspark.ml`` estimators, which
fit distributed over the training DataFrame.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.bands import band
from ..functions.numeric import rnd
from ..session import checkpoint_dir
from .metrics import five_metrics
from .splits import Fold, assign_folds

LOOKUP_KEYS = ["hour", "day_of_week"]


# -- J1: lookup baseline ------------------------------------------------------------
def fit_lookup(train: DataFrame, target: str = C.TARGET,
               keys: Sequence[str] = LOOKUP_KEYS, by: Sequence[str] = ()) -> DataFrame:
    """Mean target per (hour, day_of_week), rounded to 2 dp (half-even, as
    pandas ``round``).  At most 168 rows per ``by`` group."""
    return train.groupBy(*by, *keys).agg(
        rnd(F.avg(F.col(target).cast("double")), 2).alias("predicted_duration"),
        F.count(F.lit(1)).alias("train_rows"))


def predict_lookup(df: DataFrame, lookup: DataFrame, fallback: DataFrame,
                   keys: Sequence[str] = LOOKUP_KEYS, by: Sequence[str] = (),
                   out: str = "prediction") -> DataFrame:
    """Left join on the lookup keys, global-mean fallback for unseen cells.

    ``fallback`` has the ``by`` columns (if any) and ``global_mean``.  With the default
    keys the lookup has at most 168 rows a group and is broadcast; with others the join
    is left to the optimizer.
    """
    cells = lookup.select(*by, *keys, "predicted_duration")
    bounded = set(keys) <= set(LOOKUP_KEYS)
    j = df.join(F.broadcast(cells) if bounded else cells, [*by, *keys], "left")
    j = j.join(F.broadcast(fallback), list(by), "left") if by else \
        j.crossJoin(F.broadcast(fallback))
    return j.withColumns({
        "is_fallback": F.col("predicted_duration").isNull(),
        out: F.coalesce(F.col("predicted_duration"), F.col("global_mean")),
    }).drop("predicted_duration", "global_mean")


def lookup_baseline(train: DataFrame, score: DataFrame, target: str = C.TARGET) -> DataFrame:
    """Fit on ``train``, score ``score``; adds ``prediction`` and ``is_fallback``.

    One pass sums the training rows per cell (at most 168); the lookup and the global mean both
    come from these sums, which are kept so that later passes over ``score`` do not fit again.
    """
    checkpoint_dir(train.sparkSession)
    cells = train.groupBy(*LOOKUP_KEYS).agg(F.sum(F.col(target).cast("double")).alias("_s"),
                                            F.count(target).alias("_n")).checkpoint()
    lookup = cells.select(*LOOKUP_KEYS, rnd(F.try_divide("_s", "_n"), 2).alias("predicted_duration"))
    gm = cells.agg(F.try_divide(F.sum("_s"), F.sum("_n")).alias("global_mean"))
    return predict_lookup(score, lookup, gm)


def fallback_rate(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count(F.lit(1)).alias("rows"),
                      F.count_if("is_fallback").alias("fallback_rows")).withColumn(
        "fallback_rate", rnd(F.try_divide(F.col("fallback_rows"), F.col("rows")), 6))


def walk_forward_lookup(df: DataFrame, folds: Sequence[Fold], target: str = C.TARGET) -> DataFrame:
    """J10 for the lookup model, all folds together.  Training windows are cumulative, so rows are
    summed once per (interval between training ends, lookup cell) and the folds add up those
    small sums; only validation rows are scored, in one grouped metrics pass."""
    ends = sorted({f.train_end for f in folds})
    t = F.col(C.TIME_COL)
    after = F.lit(0)
    for end in ends:
        after = after + (t > F.to_timestamp(F.lit(end))).cast("int")
    cells = df.where(after < len(ends)).groupBy(after.alias("_i"), *LOOKUP_KEYS).agg(
        F.sum(F.col(target).cast("double")).alias("_s"), F.count(target).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    checkpoint_dir(df.sparkSession)
    cells = cells.checkpoint()  # at most 168 rows per interval
    uses = F.array(*[F.struct(F.lit(f.name).alias("fold"), F.lit(ends.index(f.train_end)).alias("last")) for f in folds])
    mine = cells.withColumn("_f", F.explode(F.filter(uses, lambda f: F.col("_i") <= f["last"]))).select("_f.fold", *cells.columns)
    lookup = mine.groupBy("fold", *LOOKUP_KEYS).agg(
        rnd(F.try_divide(F.sum("_s"), F.sum("_n")), 2).alias("predicted_duration"))
    gm = mine.groupBy("fold").agg(F.try_divide(F.sum("_s"), F.sum("_n")).alias("global_mean"))
    val = assign_folds(df, folds).where(F.col("role") == "val")
    m = five_metrics(predict_lookup(val, lookup, gm, by=["fold"]), target, "prediction", by=["fold"])
    trained = mine.groupBy("fold").agg(F.sum("_rows").alias("train_rows"))
    return m.join(F.broadcast(trained), "fold").withColumnRenamed("rows", "val_rows")


# -- J2 / J3: linear ---------------------------------------------------------------
def linear_pipeline(features: Sequence[str] = tuple(C.FEATURES), target: str = C.TARGET,
                    weight_col: str | None = None) -> Pipeline:
    """Standardise then ordinary least squares.  The ridge is far too small to move a coefficient; it
    keeps the normal equations solvable when a feature is constant (one month of data)."""
    lr = LinearRegression(featuresCol="_scaled", labelCol=target, predictionCol="prediction",
                          solver="normal", regParam=1e-9, elasticNetParam=0.0)
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep"),
        StandardScaler(inputCol="_x", outputCol="_scaled", withMean=True, withStd=True),
        lr,
    ])


def complete(features: Sequence[str]) -> Column:
    """Whether every feature of a row is present (neither NULL nor NaN)."""
    ok = F.lit(True)
    for f in features:
        ok = ok & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    return ok


def fit(pipeline: Pipeline, train: DataFrame, target: str = C.TARGET) -> tuple[PipelineModel, int]:
    """Fit on the rows whose features and target are present; also the number of rows left out."""
    ok = complete(pipeline.getStages()[0].getInputCols()) & F.col(target).isNotNull()
    left_out = train.where(~ok).count()
    return pipeline.fit(train.where(ok)), left_out


def coefficient_table(spark: SparkSession, features: Sequence[str], scaled: Sequence[float]) -> DataFrame:
    """Feature, scaled_coefficient, rank by size, direction, and whether the sign is plausible
    (distance must lengthen a trip; nothing is expected of the others)."""
    order = sorted(zip(features, scaled), key=lambda t: (-abs(t[1]), t[0]))
    rows = [(f, float(c), i + 1, "longer trip" if c > 0 else "shorter trip", not (f == "distance_km" and c < 0))
            for i, (f, c) in enumerate(order)]
    return spark.createDataFrame(rows, "feature string, scaled_coefficient double, rank int, direction string, sign_ok boolean")


def linear_coefficients(model: PipelineModel, features: Sequence[str], n_rows: int) -> DataFrame:
    """J3 of a fitted pipeline.  MLlib scales by the sample std; ``sqrt((n-1)/n)`` turns that into
    the population std."""
    k = ((n_rows - 1) / n_rows) ** 0.5 if n_rows > 1 else 1.0
    coefs = model.stages[-1].coefficients.toArray()
    return coefficient_table(SparkSession.active(), features, [float(c) * k for c in coefs])


def fit_ols(train: DataFrame, features: Sequence[str], target: str = C.TARGET, weight: str | None = None
            ) -> tuple[dict[str, float], float, dict[str, float]]:
    """J2 in closed form: (coefficients, intercept, population std of each feature), optionally weighted.

    One aggregation pass of means and products (k * (k + 3) / 2 numbers come to the driver), then a
    k x k solve.  Rows with a missing value take no part.  Products are taken around the first
    pass's means, so large offsets (coordinates) do not cancel digits.
    """
    feats = list(features)
    rows = train.where(complete(feats) & F.col(target).isNotNull())
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    x = {c: F.col(c).cast("double") for c in [*feats, target]}
    n = F.sum(w)
    mean = rows.agg(*(F.try_divide(F.sum(w * x[c]), n).alias(c) for c in x)).first()
    if mean[target] is None:
        raise ValueError("no complete row to fit on")
    pairs = [(a, b) for i, a in enumerate(feats) for b in [*feats[i:], target]]
    cross = rows.agg(*(F.try_divide(F.sum(w * (x[a] - mean[a]) * (x[b] - mean[b])), n).alias(f"c{i}")
                       for i, (a, b) in enumerate(pairs))).first()
    cov = {p: cross[f"c{i}"] for i, p in enumerate(pairs)}
    m = np.array([[cov[(a, b)] if (a, b) in cov else cov[(b, a)] for b in feats] for a in feats])
    beta = np.linalg.lstsq(m, np.array([cov[(a, target)] for a in feats]), rcond=None)[0]
    coefs = dict(zip(feats, map(float, beta)))
    return coefs, float(mean[target] - sum(coefs[f] * mean[f] for f in feats)), {f: float(cov[(f, f)]) ** 0.5 for f in feats}


def linear_expression(coefs: dict[str, float], intercept: float, columns: dict[str, Column] | None = None) -> Column:
    """``intercept + sum(w * x)`` over columns by name (default: the frame's own)."""
    out = F.lit(float(intercept))
    for f, c in coefs.items():
        out = out + F.lit(float(c)) * (columns[f] if columns else F.col(f)).cast("double")
    return out


def fit_linear_1d(train: DataFrame, x: str = "distance_km", target: str = C.TARGET) -> DataFrame:
    """Single-feature OLS as an aggregate (``regr_slope``/``regr_intercept``); one row."""
    return train.agg(F.regr_slope(F.col(target).cast("double"), F.col(x)).alias("slope"),
                     F.regr_intercept(F.col(target).cast("double"), F.col(x)).alias("intercept"))


def predict_linear_1d(df: DataFrame, coef: DataFrame, x: str = "distance_km",
                      clip_min: float | None = C.PRED_CLIP_MIN, out: str = "prediction"
                      ) -> DataFrame:
    p = F.col("intercept") + F.col("slope") * F.col(x)
    if clip_min is not None:
        p = F.greatest(p, F.lit(float(clip_min)))  # C18
    return df.crossJoin(F.broadcast(coef)).withColumn(out, p).drop("slope", "intercept")


def walk_forward_linear(df: DataFrame, folds: Sequence[Fold], x: str = "distance_km", target: str = C.TARGET) -> DataFrame:
    """J10 for a fitted model: one-feature least squares per fold, all folds in one aggregation
    (a row per fold), then one scoring and metrics pass over the validation rows."""
    a = assign_folds(df, folds)
    y = F.col(target).cast("double")
    coef = a.where(F.col("role") == "train").groupBy("fold").agg(
        F.regr_slope(y, F.col(x)).alias("slope"), F.regr_intercept(y, F.col(x)).alias("intercept"))
    p = F.greatest(F.col("intercept") + F.col("slope") * F.col(x), F.lit(C.PRED_CLIP_MIN))
    scored = a.where(F.col("role") == "val").join(F.broadcast(coef), "fold").withColumn("prediction", p)
    return five_metrics(scored, target, "prediction", by=["fold"])


# -- J4 / J7: boosted trees -----------------------------------------------------------
def gbt_pipeline(features: Sequence[str] = tuple(C.FEATURES), target: str = C.TARGET,
                 max_iter: int = 300, weight_col: str | None = None,
                 validation_col: str | None = None, seed: int = 42) -> Pipeline:
    """Boosted trees with the reference's shape (depth 5, rate .05, row / column
    subsampling .8, min 10 rows per leaf).  XGBoost's L2 term and patience
    counter have no MLlib equivalent; ``validationIndicatorCol`` gives early stop."""
    gbt = GBTRegressor(featuresCol="_x", labelCol=target, predictionCol="prediction",
                       maxIter=max_iter, maxDepth=5, stepSize=0.05, subsamplingRate=0.8,
                       featureSubsetStrategy="0.8", minInstancesPerNode=10, seed=seed)
    if weight_col:
        gbt.setWeightCol(weight_col)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col)
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_x",
                                            handleInvalid="keep"), gbt])


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Feature, importance, rank (a row a feature)."""
    imp = model.stages[-1].featureImportances.toArray()
    order = sorted(zip(features, map(float, imp)), key=lambda t: (-t[1], t[0]))
    return SparkSession.active().createDataFrame([(f, v, i + 1) for i, (f, v) in enumerate(order)],
                                                 "feature string, importance double, rank int")


def score(model: PipelineModel, df: DataFrame, clip_min: float | None = None) -> DataFrame:
    """Row-parallel scoring; optional lower clip (C18).  Every row comes back: one with a
    missing feature has a NULL prediction."""
    ok = complete(model.stages[0].getInputCols())
    p = F.when(ok, F.col("prediction"))
    if clip_min is not None:
        p = F.when(ok, F.greatest("prediction", F.lit(float(clip_min))))
    return model.transform(df).drop("_x", "_scaled").withColumn("prediction", p)


def save_model(model: PipelineModel, path: str) -> None:
    """MLlib persistence (overwrite)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def final_test_evaluation(scored: DataFrame, target: str = C.TARGET, split_col: str = "split") -> DataFrame:
    """Metrics of the test rows of a scored frame, and their RMSE gap to its validation rows."""
    m = five_metrics(scored, target, "prediction", by=[split_col])
    v = m.where(F.col(split_col) == "val").agg(F.max("rmse_seconds").alias("_v"))  # one row
    gap = F.col("rmse_seconds") - F.col("_v")
    return m.where(F.col(split_col) == "test").drop(split_col).crossJoin(v).withColumns({
        "test_rows": F.col("rows"), "rmse_gap_vs_validation": rnd(gap, 2), "verdict": band(gap, *C.TEST_GAP_BANDS),
    }).drop("_v")
