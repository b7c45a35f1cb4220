"""Spike-probability calibration.

Bin tables have ``n_bins`` rows (20 / 10), a bound that does not grow with the
data, so they are broadcast; the range lookups are then nested-loop joins
against a 20-row build side inside the scan stage (no shuffle of the big side).
"""

from __future__ import annotations

from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.bands import band
from ..functions.numeric import rnd
from ..session import checkpoint_dir


def with_spike_label(df: DataFrame, threshold: DataFrame, actual: str = C.TARGET,
                     out: str = "spike") -> DataFrame:
    """``actual > threshold`` as int; ``threshold`` is a one-row frame."""
    return df.crossJoin(F.broadcast(threshold.select("spike_threshold"))).withColumn(
        out, (F.col(actual) > F.col("spike_threshold")).cast("int")).drop("spike_threshold")


def spike_bins(train_scored: DataFrame, pred: str = "prediction", label: str = "spike",
               n_bins: int = C.SPIKE_BINS) -> DataFrame:
    """``n_bins`` equal-width bins over the training prediction range.

    Edges are ``i * ((max - min) / n) + min`` with the last edge exactly ``max``
    (``linspace``).  Training rows are counted half-open ``[low, high)`` for every
    bin, so the training maximum falls in no bin (parity).  An empty bin has
    probability 0.0.
    """
    mm = train_scored.agg(F.min(pred).alias("_mn"), F.max(pred).alias("_mx"))
    step = (F.col("_mx") - F.col("_mn")) / F.lit(float(n_bins))
    bins = mm.select(F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"), "_mn", "_mx") \
        .select("bin", (F.col("bin") * step + F.col("_mn")).alias("low"),
                F.when(F.col("bin") == n_bins - 1, F.col("_mx"))
                .otherwise((F.col("bin") + 1) * step + F.col("_mn")).alias("high"))
    hit = train_scored.select(pred, label).join(
        F.broadcast(bins), (F.col(pred) >= F.col("low")) & (F.col(pred) < F.col("high")))
    stats = hit.groupBy("bin").agg(F.count(F.lit(1)).alias("train_rows"),
                                   F.avg(F.col(label).cast("double")).alias("_p"))
    return bins.join(stats, "bin", "left").select(
        "bin", "low", "high", F.coalesce("train_rows", F.lit(0)).cast("long").alias("train_rows"),
        F.coalesce("_p", F.lit(0.0)).alias("spike_probability"))


def spike_probability(scored: DataFrame, bins: DataFrame, pred: str = "prediction",
                      out: str = "spike_prob", n_bins: int = C.SPIKE_BINS) -> DataFrame:
    """Map predictions to their bin's probability; the last bin is
    widened by +1 on this side, anything outside every bin gets 0.0."""
    b = bins.select("bin", "low", F.when(F.col("bin") == n_bins - 1, F.col("high") + 1.0)
                    .otherwise(F.col("high")).alias("high"), "spike_probability")
    j = scored.join(F.broadcast(b), (F.col(pred) >= F.col("low")) & (F.col(pred) < F.col("high")),
                    "left")
    return j.withColumn(out, F.coalesce("spike_probability", F.lit(0.0))).drop(
        "bin", "low", "high", "spike_probability")


def reliability_bin(p, n_bins: int = C.RELIABILITY_BINS):
    """Index of the uniform bin on [0, 1]: the number of inner edges strictly below p
    (an edge value goes to the lower bin)."""
    c = F.col(p) if isinstance(p, str) else p
    idx = F.lit(0)
    for i in range(1, n_bins):
        idx = idx + (F.lit(i * (1.0 / n_bins)) < c).cast("int")
    return idx


def reliability_curve(df: DataFrame, prob: str = "spike_prob", label: str = "spike",
                      n_bins: int = C.RELIABILITY_BINS) -> DataFrame:
    """Non-empty bins only: rows, mean predicted probability, positive fraction, and whether the
    bin is under-confident (more positives than predicted), over-confident or calibrated."""
    curve = df.groupBy(reliability_bin(prob, n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(F.col(prob).cast("double")).alias("mean_predicted_prob"),
        F.avg(F.col(label).cast("double")).alias("fraction_positive"))
    gap = F.col("fraction_positive") - F.col("mean_predicted_prob")
    return curve.withColumn("direction", F.when(gap > C.CALIBRATION_DIRECTION_LIMIT, "under-confident")
                            .when(gap < -C.CALIBRATION_DIRECTION_LIMIT, "over-confident").otherwise("calibrated"))


def calibration_stats(df: DataFrame, prob: str = "spike_prob", label: str = "spike",
                      n_bins: int = C.RELIABILITY_BINS) -> DataFrame:
    """E13 + E14 in one row: ECE unweighted (mean gap over non-empty bins, parity),
    ECE weighted by bin size, Brier score, actual and predicted spike rate."""
    curve = reliability_curve(df, prob, label, n_bins)
    gap = F.abs(F.col("mean_predicted_prob") - F.col("fraction_positive"))
    ece = curve.agg(F.avg(gap).alias("ece"),
                    (F.sum(gap * F.col("rows")) / F.sum("rows")).alias("ece_weighted"),
                    F.count(F.lit(1)).alias("non_empty_bins"))
    p, y = F.col(prob).cast("double"), F.col(label).cast("double")
    brier = df.agg(F.avg((p - y) * (p - y)).alias("brier_score"),
                   F.avg(y).alias("actual_spike_rate"), F.avg(p).alias("predicted_spike_rate"))
    return ece.crossJoin(brier)  # 1 x 1 rows


def fit_isotonic(fit_df: DataFrame, prob: str = "spike_prob", label: str = "spike"):
    """Isotonic (non-decreasing) fit with MLlib; out-of-range inputs are clipped
    to the end values and inputs between knots are interpolated linearly.  Rows are reduced to
    (probability, mean label, count) first - the same fit, from at most one row per bin."""
    points = fit_df.groupBy(F.col(prob).cast("double").alias(prob)).agg(
        F.avg(F.col(label).cast("double")).alias(label), F.count(F.lit(1)).cast("double").alias("_w"))
    return IsotonicRegression(featuresCol=prob, labelCol=label, weightCol="_w", predictionCol="_iso",
                              isotonic=True).fit(points)


def apply_isotonic(model, df: DataFrame, prob: str = "spike_prob",
                   out: str = "calibrated_prob") -> DataFrame:
    return model.setFeaturesCol(prob).setPredictionCol(out).transform(df)


def override_analysis(df: DataFrame, prob: str = "calibrated_prob", label: str = "spike",
                      threshold: float = C.OVERRIDE_THRESHOLD) -> DataFrame:
    """Rows whose probability exceeds ``threshold`` fall back to the historical
    mean; count, share, precision, recall.  With no override the metrics are NULL."""
    hit = F.col(prob) > F.lit(float(threshold))
    y = F.col(label)
    agg = df.agg(F.count(F.lit(1)).alias("_n"), F.count_if(hit).alias("override_count"),
                 F.sum(F.when(hit, y).otherwise(0)).cast("long").alias("spikes_caught"),
                 F.sum(y).cast("long").alias("total_spikes"))
    return agg.select(
        F.lit(float(threshold)).alias("override_threshold"), "override_count",
        rnd(F.try_divide(F.col("override_count") * 100.0, F.col("_n")), 2).alias("override_pct"),
        rnd(F.try_divide(F.col("spikes_caught").cast("double"), F.col("override_count")), 4)
        .alias("precision"),
        rnd(F.when(F.col("total_spikes") > 0, F.col("spikes_caught") / F.col("total_spikes"))
            .otherwise(F.lit(0.0)), 4).alias("recall"),
        "spikes_caught", "total_spikes",
        F.when(F.col("override_count") == 0, F.lit(None).cast("string"))
        .when(F.try_divide(F.col("spikes_caught").cast("double"), F.col("override_count"))
              > C.OVERRIDE_PRECISION_LIMIT, "override useful").otherwise("override too noisy")
        .alias("verdict"))


def calibration_report(train_scored: DataFrame, val_scored: DataFrame, threshold: DataFrame,
                       actual: str = C.TARGET, pred: str = "prediction", fit_on: str = "train"
                       ) -> DataFrame:
    """J13 end to end, one row.  ``fit_on="val"`` reproduces the reference (the
    calibrator is fitted and scored on the same validation rows, so its "after"
    numbers are not evidence); ``"train"`` fits on training probabilities."""
    tr = with_spike_label(train_scored, threshold, actual)
    va = with_spike_label(val_scored, threshold, actual)
    bins = spike_bins(tr, pred)
    # used by the isotonic fit, its scoring and two statistics passes: materialise
    # once in the shared checkpoint folder (also cuts the lineage)
    checkpoint_dir(val_scored.sparkSession)
    vp = spike_probability(va, bins, pred).checkpoint(eager=True)
    fit_src = vp if fit_on == "val" else spike_probability(tr, bins, pred)
    iso = fit_isotonic(fit_src)
    cal = apply_isotonic(iso, vp)
    before = calibration_stats(vp, "spike_prob")
    after = calibration_stats(cal, "calibrated_prob")
    over = override_analysis(cal)
    hist = tr.agg(F.avg(F.col(actual).cast("double")).alias("_hm"))

    def pre(df, tag):
        return df.select(*[rnd(c, 4).alias(f"{tag}_{c}") if c != "non_empty_bins"
                           else F.col(c).alias(f"{tag}_{c}") for c in df.columns])
    rep = (threshold.select(rnd("spike_threshold", 1).alias("spike_threshold"))
           .crossJoin(hist.select(rnd("_hm", 1).alias("historical_mean")))
           .crossJoin(pre(before, "uncal")).crossJoin(pre(after, "cal"))
           .crossJoin(after.select(F.col("ece").alias("_raw_ece"))).crossJoin(over))
    return rep.withColumns({
        "spike_percentile": F.lit(C.SPIKE_PERCENTILE),
        "ece_improvement": rnd(F.col("uncal_ece") - F.col("cal_ece"), 4),
        "brier_improvement": rnd(F.col("uncal_brier_score") - F.col("cal_brier_score"), 4),
        "calibration_verdict": band("_raw_ece", *C.CALIBRATION_BANDS),
    }).drop("_raw_ece")
