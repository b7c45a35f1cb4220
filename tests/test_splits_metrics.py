import datetime as dt

import numpy as np

from tripsmith.operators import metrics as M
from tripsmith.operators import splits as SP

T0 = dt.datetime(2024, 1, 1)


def frame(spark, n, tie_at=None):
    rows = []
    for i in range(n):
        t = T0 + dt.timedelta(hours=i)
        if tie_at is not None and i in tie_at:
            t = T0 + dt.timedelta(hours=min(tie_at))
        rows.append((f"{i:04d}", t, 100 + i))
    return spark.createDataFrame(rows, "id string, pickup_datetime timestamp, trip_duration int")


def test_temporal_split_positional_counts(spark):
    df = frame(spark, 101)
    got = {r.split: r.n for r in SP.temporal_split(df).groupBy("split").count()
           .withColumnRenamed("count", "n").collect()}
    assert got == {"train": int(101 * 0.75), "gap": int(101 * 0.8) - int(101 * 0.75),
                   "val": 101 - int(101 * 0.8)}


def test_date_split_midnight_semantics(spark):
    rows = [("a", dt.datetime(2024, 1, 20, 0, 0), 1), ("b", dt.datetime(2024, 1, 20, 0, 0, 1), 1),
            ("c", dt.datetime(2024, 1, 22, 0, 0), 1), ("d", dt.datetime(2024, 1, 27, 12), 1)]
    df = spark.createDataFrame(rows, "id string, pickup_datetime timestamp, trip_duration int")
    got = {r.id: r.split for r in SP.date_split(df, "2024-01-20", "2024-01-22", "2024-01-27").collect()}
    assert got == {"a": "train", "b": "gap", "c": "gap", "d": "test"}
    inc = {r.id: r.split for r in SP.date_split(df, "2024-01-20", "2024-01-22", "2024-01-27",
                                                end_inclusive=True).collect()}
    assert inc["b"] == "train" and inc["d"] == "val"


def test_folds_and_leakage(spark):
    df = frame(spark, 24 * 10)
    folds = [SP.Fold("f1", "2024-01-03", "2024-01-04", "2024-01-06"),
             SP.Fold("f2", "2024-01-05", "2024-01-06", "2024-01-08")]
    a = SP.assign_folds(df, folds)
    cnt = {(r.fold, r.role): r["count"] for r in a.groupBy("fold", "role").count().collect()}
    assert cnt[("f1", "train")] == 49 and cnt[("f1", "val")] == 48
    leak = SP.leakage_check(a, group="fold", split_col="role", order=("train", "val")).collect()
    assert not any(r.violated for r in leak)
    # empty later side counts as a violation
    empty = SP.leakage_check(SP.date_split(df, "2024-02-01", "2024-02-02", "2024-02-03")).collect()
    assert all(r.violated for r in empty)


def test_five_metrics_against_numpy(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(61, 3000, 500).astype(float)
    p = a + rng.normal(0, 200, 500)
    df = spark.createDataFrame([(str(i), float(x), float(y)) for i, (x, y) in enumerate(zip(a, p))],
                               "id string, actual double, pred double")
    r = M.five_metrics(df, "actual", "pred", rounded=False).first()
    e = a - p
    assert abs(r.rmse_seconds - np.sqrt(np.mean(e ** 2))) < 1e-9
    assert abs(r.mape_pct - np.mean(np.abs(e) / a) * 100) < 1e-9
    assert abs(r.mean_error_seconds - e.mean()) < 1e-9
    assert abs(r.p95_error_seconds - np.percentile(np.abs(e), 95)) < 1e-9
    assert abs(r.r2 - (1 - np.sum(e ** 2) / np.sum((a - a.mean()) ** 2))) < 1e-9


def test_mape_skips_zero_actual_and_r2_undefined(spark):
    df = spark.createDataFrame([("1", 0.0, 1.0), ("2", 10.0, 12.0)], "id string, actual double, pred double")
    r = M.five_metrics(df, "actual", "pred", rounded=False).first()
    assert abs(r.mape_pct - 20.0) < 1e-12
    const = spark.createDataFrame([("1", 5.0, 4.0), ("2", 5.0, 6.0)], "id string, actual double, pred double")
    assert M.five_metrics(const, "actual", "pred").first().r2 is None


def test_fold_summary_sample_std_and_band(spark):
    df = spark.createDataFrame([(286.5,), (304.5,), (322.5,), (352.9,)], "rmse_seconds double")
    r = M.fold_summary(df).first()
    v = np.array([286.5, 304.5, 322.5, 352.9])
    assert abs(r.std_rmse - round(v.std(ddof=1), 2)) < 1e-9
    assert r.stability == "MODERATE"


def test_bands_at_every_cut(spark):
    from tripsmith import config as C
    from tripsmith.functions.bands import band
    cases = {"OVERFIT_BANDS": [(15.0, "healthy"), (15.0001, "mild overfit"), (30.0, "mild overfit"), (30.0001, "severe overfit")],
             "SLICE_RATIO_BANDS": [(1.996, "excellent"), (2.0, "good"), (3.0, "moderate"), (4.0, "poor")],
             "STABILITY_BANDS": [(0.0499, "STABLE"), (0.05, "MODERATE"), (0.15, "VOLATILE")],
             "CALIBRATION_BANDS": [(0.0499, "good"), (0.05, "moderate"), (0.1, "poor")],
             "IMPROVEMENT_VS_BASELINE_BANDS": [(-0.1, "worse"), (0.0, "weak"), (10.0, "moderate"), (25.0, "strong")],
             "IMPROVEMENT_VS_LINEAR_BANDS": [(4.9, "barely beats linear"), (5.0, "moderate non-linearity"), (20.0, "strong non-linearity")],
             "TEST_GAP_BANDS": [(0.0, "matches or beats validation"), (0.01, "slight degradation"), (50.0, "slight degradation"),
                                (50.1, "significant degradation")]}
    for name, rows in cases.items():
        got = spark.createDataFrame([(x,) for x, _ in rows], "x double").select(band("x", *getattr(C, name)).alias("b")).collect()
        assert [r.b for r in got] == [label for _, label in rows]


def test_zero_actuals_are_counted(spark):
    from tripsmith.operators import metrics as M
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 8.0), (20.0, 25.0)], "actual double, pred double")
    r = M.five_metrics(df, "actual", "pred").first()
    assert r.zero_actuals == 1 and r.mape_pct == 22.5


def test_temporal_split_of_ties_and_empty_table(spark):
    from pyspark.sql import functions as F

    from tripsmith.operators.splits import temporal_split
    rows = [(f"k{i:03d}", 1_700_000_000 + (i // 50 if i < 150 else 3)) for i in range(400)]  # 250 rows share the last instant
    df = spark.createDataFrame(rows, "id string, s long").select("id", F.col("s").cast("timestamp").alias("pickup_datetime")).repartition(4)
    got = {r.id: r.split for r in temporal_split(df).collect()}
    order = [i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))]
    assert [got[i] for i in order] == ["train"] * 300 + ["gap"] * 20 + ["val"] * 80
    assert temporal_split(df.where("false")).count() == 0
