"""Evaluation metrics as grouped aggregations.

Every metric family is one aggregation pass (partial + final aggregate, so the
shuffle carries one small buffer per group per partition) plus an exact,
sort-based quantile for the p95 terms (``ordering.exact_percentile``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.bands import band
from ..functions.numeric import rnd
from ..session import checkpoint_dir
from .ordering import bracket, exact_percentile

METRIC_COLUMNS = ["rmse_seconds", "mape_pct", "mean_error_seconds", "p95_error_seconds", "r2"]


def with_errors(df: DataFrame, actual: str, pred: str) -> DataFrame:
    """error = actual - predicted (positive = under-prediction)."""
    return df.withColumns({
        "_a": F.col(actual).cast("double"),
        "_e": F.col(actual).cast("double") - F.col(pred).cast("double"),
    }).withColumn("_ae", F.abs("_e"))


def five_metrics(df: DataFrame, actual: str, pred: str, by: Sequence[str] = (),
                 digits: int = 2, r2_digits: int = 4, rounded: bool = True) -> DataFrame:
    """Rmse, mape %, signed mean error, p95 |error|, r2 (+ rows) per group.

    MAPE skips rows whose actual is 0 (``try_divide`` -> NULL) instead of
    producing infinity; ``zero_actuals`` counts them.  R2 = 1 - SSres / (n * var_pop(actual)).
    """
    by = list(by)
    e = with_errors(df, actual, pred)
    checkpoint_dir(df.sparkSession)
    agg = e.groupBy(*by).agg(
        *bracket("_ae", C.SPIKE_PERCENTILE),
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_a") == 0).alias("zero_actuals"),
        F.sqrt(F.avg(F.col("_e") * F.col("_e"))).alias("rmse_seconds"),
        (F.avg(F.try_divide(F.col("_ae"), F.col("_a"))) * 100.0).alias("mape_pct"),
        F.avg("_e").alias("mean_error_seconds"),
        (1.0 - F.try_divide(F.sum(F.col("_e") * F.col("_e")),
                            F.var_pop("_a") * F.count(F.lit(1)))).alias("r2"),
    ).checkpoint()  # one row per group
    p95 = exact_percentile(e, "_ae", C.SPIKE_PERCENTILE, by=by, alias="p95_error_seconds", brackets=agg)
    out = agg.join(p95, by, "left") if by else agg.join(p95, F.lit(True), "left")  # 1 x 1 rows
    cols = [*by, F.col("rows").cast("long").alias("rows"), F.col("zero_actuals").cast("long").alias("zero_actuals")]
    for m in METRIC_COLUMNS:
        d = r2_digits if m == "r2" else digits
        cols.append((rnd(m, d) if rounded else F.col(m)).alias(m))
    return out.select(*cols)


def spike_threshold(df: DataFrame, actual: str = C.TARGET,
                    q: float = C.SPIKE_PERCENTILE) -> DataFrame:
    """E5: exact linear percentile of the target (one row, ``spike_threshold``)."""
    return exact_percentile(df, actual, q, alias="spike_threshold")


def sample_weights(df: DataFrame, threshold: DataFrame, actual: str = C.TARGET,
                   weight: float = C.SPIKE_WEIGHT) -> DataFrame:
    """Weight ``weight`` for rows above the threshold, else 1.0.
    ``threshold`` is the one-row frame of ``spike_threshold``."""
    return df.crossJoin(F.broadcast(threshold)).withColumn(
        "weight", F.when(F.col(actual) > F.col("spike_threshold"), F.lit(float(weight)))
        .otherwise(F.lit(1.0)))


def weight_share(weighted: DataFrame, weight: float = C.SPIKE_WEIGHT) -> DataFrame:
    """Spike / normal counts and the spike share of total weight."""
    return weighted.agg(
        F.count_if(F.col("weight") > 1.0).alias("spike_rows"),
        F.count_if(F.col("weight") <= 1.0).alias("normal_rows"),
        F.sum("weight").alias("total_weight"),
    ).withColumn("spike_weight_share", rnd(F.try_divide(
        F.col("spike_rows") * float(weight), F.col("normal_rows") + F.col("spike_rows") * float(weight)), 4))


def slice_metrics(df: DataFrame, actual: str, pred: str, threshold: DataFrame,
                  digits: int = 1) -> DataFrame:
    """Rows / rmse / bias / p95 for ``actual <= t`` (normal) and ``> t`` (spike),
    plus the spike-to-normal RMSE ratio computed from the rounded values."""
    e = with_errors(df.crossJoin(F.broadcast(threshold)), actual, pred).withColumn(
        "slice", F.when(F.col(actual) > F.col("spike_threshold"), F.lit("spike"))
        .otherwise(F.lit("normal")))
    agg = e.groupBy("slice").agg(
        F.count(F.lit(1)).alias("rows"),
        rnd(F.sqrt(F.avg(F.col("_e") * F.col("_e"))), digits).alias("rmse_seconds"),
        rnd(F.avg("_e"), digits).alias("bias_seconds"))
    p95 = exact_percentile(e, "_ae", C.SPIKE_PERCENTILE, by=["slice"], alias="p95_seconds")
    out = agg.join(p95, "slice", "left").withColumn("p95_seconds", rnd("p95_seconds", digits))
    normal = F.max(F.when(F.col("slice") == "normal", F.col("rmse_seconds")))
    ratio = out.agg(F.try_divide(F.max(F.when(F.col("slice") == "spike", F.col("rmse_seconds"))),
                                 normal).alias("_ratio"))
    return out.crossJoin(ratio).select(
        "slice", F.col("rows").cast("long").alias("rows"), "rmse_seconds", "bias_seconds",
        "p95_seconds", rnd("_ratio", 2).alias("ratio"), band("_ratio", *C.SLICE_RATIO_BANDS).alias("verdict"))


def overfit_gap(metrics: DataFrame, split_col: str = "split", train: str = "train",
                val: str = "val") -> DataFrame:
    """Gap % = (val - train) / train * 100 from a metrics table with a split column."""
    agg = metrics.agg(
        F.max(F.when(F.col(split_col) == train, F.col("rmse_seconds"))).alias("train_rmse_seconds"),
        F.max(F.when(F.col(split_col) == val, F.col("rmse_seconds"))).alias("val_rmse_seconds"))
    gap = F.try_divide((F.col("val_rmse_seconds") - F.col("train_rmse_seconds")) * 100.0,
                       F.col("train_rmse_seconds"))
    return agg.withColumns({"overfit_gap_pct": rnd(gap, 1), "verdict": band(gap, *C.OVERFIT_BANDS)})


def fold_summary(fold_metrics: DataFrame, value: str = "rmse_seconds") -> DataFrame:
    """Mean, sample std, min, max, CV (std / mean) of per-fold RMSE."""
    agg = fold_metrics.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg(value).alias("mean_rmse"), F.stddev_samp(value).alias("std_rmse"),
        F.min(value).alias("min_rmse"), F.max(value).alias("max_rmse"))
    agg = agg.withColumn("cv", F.try_divide(F.col("std_rmse"), F.col("mean_rmse")))
    return agg.select(
        F.col("folds").cast("long").alias("folds"),
        rnd("mean_rmse", 2).alias("mean_rmse"), rnd("std_rmse", 2).alias("std_rmse"),
        rnd("min_rmse", 2).alias("min_rmse"), rnd("max_rmse", 2).alias("max_rmse"),
        rnd("cv", 4).alias("cv"), band("cv", *C.STABILITY_BANDS).alias("stability"))


def model_comparison(metrics: DataFrame, baseline: str, reference: str | None = None,
                     model_col: str = "model") -> DataFrame:
    """Per model, RMSE improvement % vs the baseline and vs a reference (linear) model,
    bias reading, P95 in minutes, and banded verdicts.  One row per model is expected: pick a
    run first (``sinks.one_run``) where the metrics table holds several."""
    def improvement(other: str, to: str):
        value = F.try_divide((F.col(to) - F.col("rmse_seconds")) * 100.0, F.col(to))
        bands = C.IMPROVEMENT_VS_BASELINE_BANDS if other == "baseline" else C.IMPROVEMENT_VS_LINEAR_BANDS
        return {f"improvement_vs_{other}_pct": rnd(value, 2), f"verdict_vs_{other}": band(value, *bands)}

    base = metrics.where(F.col(model_col) == baseline).agg(F.max("rmse_seconds").alias("_base_rmse"))
    out = metrics.crossJoin(F.broadcast(base))  # one-row side
    extra = improvement("baseline", "_base_rmse")
    if reference is not None:
        ref = metrics.where(F.col(model_col) == reference).agg(F.max("rmse_seconds").alias("_ref_rmse"))
        out = out.crossJoin(F.broadcast(ref))
        extra |= improvement("reference", "_ref_rmse")
    bias = F.col("mean_error_seconds")
    return out.withColumns(extra | {
        "bias_reading": F.when(F.abs(bias) < C.BIAS_LIMIT_S, F.lit("well-calibrated"))
        .when(bias > 0, F.lit("under-predicts")).otherwise(F.lit("over-predicts")),
        "p95_minutes": rnd(F.col("p95_error_seconds") / 60.0, 1),
    }).drop("_base_rmse", "_ref_rmse")


def metric_deltas(metrics: DataFrame, model_a: str, model_b: str,
                  model_col: str = "model") -> DataFrame:
    """Per metric, value(b) - value(a) and whether b is better.
    Lower is better for every metric except r2; for the signed bias the
    smaller absolute value is better."""
    long = metrics.select(model_col, F.explode(F.map_from_arrays(
        F.array(*[F.lit(m) for m in METRIC_COLUMNS]),
        F.array(*[F.col(m).cast("double") for m in METRIC_COLUMNS]))).alias("metric", "value"))
    a = long.where(F.col(model_col) == model_a).select("metric", F.col("value").alias("value_a"))
    b = long.where(F.col(model_col) == model_b).select("metric", F.col("value").alias("value_b"))
    j = a.join(b, "metric")
    better = (F.when(F.col("metric") == "r2", F.col("value_b") > F.col("value_a"))
              .when(F.col("metric") == "mean_error_seconds",
                    F.abs("value_b") < F.abs("value_a"))
              .otherwise(F.col("value_b") < F.col("value_a")))
    return j.select("metric", "value_a", "value_b",
                    rnd(F.col("value_b") - F.col("value_a"), 4).alias("delta"),
                    F.when(better, "better").when(F.col("value_a") == F.col("value_b"), "same")
                    .otherwise("worse").alias("direction"))


def promotion_check(contract: DataFrame, candidate: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """Keep the stored model when the candidate's RMSE regresses beyond
    ``tolerance`` (relative).  Both inputs are one-row metric frames."""
    c = contract.agg(F.max("rmse_seconds").alias("current_rmse"))
    n = candidate.agg(F.max("rmse_seconds").alias("candidate_rmse"))
    return c.crossJoin(n).withColumn(
        "promote", F.col("candidate_rmse") <= F.col("current_rmse") * (1.0 + tolerance))


def split_profile(df: DataFrame, split_col: str = "split", ts: str = C.TIME_COL) -> DataFrame:
    """Rows and time range per split."""
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.date_format(F.min(ts), "yyyy-MM-dd HH:mm:ss").alias("min_ts"),
        F.date_format(F.max(ts), "yyyy-MM-dd HH:mm:ss").alias("max_ts"))


def global_mean(df: DataFrame, col: str = C.TARGET, alias: str = "global_mean") -> DataFrame:
    """E3 (one row)."""
    return df.agg(F.avg(F.col(col).cast("double")).alias(alias))


def ranked(df: DataFrame, value: str, key: str, rank_col: str = "rank") -> DataFrame:
    """1-based descending rank of a *small* table (features, models)."""
    return df.withColumn(rank_col, F.row_number().over(
        Window.orderBy(F.desc(value), F.asc(key))))
