import tempfile

import numpy as np
from pyspark.sql import functions as F

from tripsmith import config as C
from tripsmith.operators import clean as CL
from tripsmith.operators import metrics as M
from tripsmith.operators import models as MD
from tripsmith.sources.tables import trips


def _data(spark):
    p = CL.processed(trips(spark, "/root/testdata/sf0.01"), "full")
    return p.where(F.col("pickup_datetime") < "2024-01-20"), p.where(F.col("pickup_datetime") >= "2024-01-22")


def test_linear_beats_lookup_and_roundtrips(spark):
    tr, va = _data(spark)
    model, left_out = MD.fit(MD.linear_pipeline(), tr)
    assert left_out == 0
    lin = M.five_metrics(MD.score(model, va, clip_min=60.0), C.TARGET, "prediction").first()
    look = M.five_metrics(MD.lookup_baseline(tr, va), C.TARGET, "prediction").first()
    assert lin.rmse_seconds < look.rmse_seconds
    path = tempfile.mkdtemp(prefix="tripsmith-model-") + "/linear"
    MD.save_model(model, path)
    again = MD.score(MD.load_model(path), va)
    diff = MD.score(model, va).select("id", F.col("prediction").alias("a")).join(
        again.select("id", F.col("prediction").alias("b")), "id").agg(F.max(F.abs(F.col("a") - F.col("b"))))
    assert diff.first()[0] < 1e-9
    table = MD.linear_coefficients(model, C.FEATURES, tr.count()).collect()
    assert len(table) == 12 and [r["rank"] for r in table] == list(range(1, 13)) and all(r.sign_ok for r in table)


def test_scoring_returns_every_row(spark):
    tr, va = _data(spark)
    spoilt = va.withColumn("distance_km", F.when(F.col("id").cast("long") % 5 == 0, None)
                           .when(F.col("id").cast("long") % 5 == 1, float("nan")).otherwise(F.col("distance_km")))
    some = tr.withColumn("hour", F.when(F.col("id").cast("long") % 10 != 0, F.col("hour")))
    for pipeline in (MD.linear_pipeline(), MD.gbt_pipeline(max_iter=2)):
        model, left_out = MD.fit(pipeline, some)
        assert left_out == some.where("hour is null").count() > 0
        out = MD.score(model, spoilt, clip_min=60.0)
        assert out.count() == va.count()
        empty = out.where(F.col("prediction").isNull() != (F.col("id").cast("long") % 5).isin(0, 1)).count()
        assert empty == 0 and out.where(F.isnan("prediction")).count() == 0


def test_weighted_gbt_fits_and_weights_spikes(spark):
    tr, va = _data(spark)
    thr = M.spike_threshold(tr)
    w = M.sample_weights(tr, thr)
    share = M.weight_share(w).first()
    assert share.spike_rows > 0 and 0 < share.spike_weight_share < 1
    rmse = {}
    for weight in (None, "weight"):
        model, _ = MD.fit(MD.gbt_pipeline(max_iter=5, weight_col=weight), w)
        rmse[weight] = M.five_metrics(MD.score(model, w.where("weight > 1")), C.TARGET, "prediction").first().rmse_seconds
        imp = MD.feature_importance(model, C.FEATURES).collect()
        assert len(imp) == 12 and abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    assert rmse["weight"] < rmse[None]
    assert MD.score(model, va).where(F.col("prediction").isNull()).count() == 0


def test_closed_form_least_squares_equals_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(1e6, 3, size=(500, 3))  # large offsets
    y = 4 + x @ np.array([2.0, -1.0, 0.5]) + rng.normal(size=500)
    w = rng.integers(1, 6, 500).astype(float)
    rows = [(*map(float, a), float(b), float(c)) for a, b, c in zip(x, y, w)]
    df = spark.createDataFrame([*rows, (None, 1.0, 1.0, 5.0, 1.0), (float("nan"), 1.0, 1.0, 5.0, 1.0)],
                               "a double, b double, c double, y double, w double")
    for weight in (None, "w"):
        coefs, intercept, std = MD.fit_ols(df, ["a", "b", "c"], "y", weight)
        k = np.sqrt(w if weight else np.ones(500))
        m = x.mean(0)
        beta = np.linalg.lstsq(np.c_[x - m, np.ones(500)] * k[:, None], y * k, rcond=None)[0]
        assert np.allclose([coefs[f] for f in "abc"], beta[:3], atol=1e-6)
        assert abs(intercept - (beta[3] - beta[:3] @ m)) < 1
    assert abs(std["a"] - np.sqrt(np.average((x[:, 0] - np.average(x[:, 0], weights=w)) ** 2, weights=w))) < 1e-6
