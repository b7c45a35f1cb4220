import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tripsmith import config as C
from tripsmith.operators import calibration as CA
from tripsmith.operators import clean as CL
from tripsmith.operators import estimators as E
from tripsmith.operators import metrics as M
from tripsmith.operators import models as MD
from tripsmith.operators.splits import Fold
from tripsmith.sources.sinks import scratch_path
from tripsmith.sources.tables import trips

FOLDS = [Fold("one", "2024-01-08", "2024-01-09", "2024-01-15"), Fold("two", "2024-01-15", "2024-01-16", "2024-01-22"),
         Fold("none", "2023-01-15", "2023-01-16", "2023-01-22")]


@pytest.fixture(scope="module")
def parts(spark):
    p = CL.processed(trips(spark, "/root/testdata/sf0.01"), "full")
    return p.where(F.col(C.TIME_COL) < "2024-01-20"), p.where(F.col(C.TIME_COL) >= "2024-01-22")


def test_every_model_survives_saving_inside_a_pipeline(spark, parts):
    tr, va = parts
    labelled = CA.with_spike_label(tr, M.spike_threshold(tr))
    stages = [E.LookupBaseline(), E.SpikeBins(), E.Calibrator(), E.LeastSquares(clip=60.0, predictionCol="linear"),
              E.BoostedTrees(inputCols=["distance_km", "hour"], predictionCol="boosted", settings={"trees": 2, "depth": 2, "patience": None})]
    fitted = Pipeline(stages=stages).fit(labelled)
    path = scratch_path(spark, "pipeline")
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    cols = ["id", "prediction", "is_fallback", "spike_prob", "calibrated_prob", "linear", "boosted"]
    a, b = ({r.id: tuple(r) for r in m.transform(va).select(cols).collect()} for m in (fitted, loaded))
    assert a == b and len(a) == va.count()
    look = {r.id: r.prediction for r in MD.lookup_baseline(tr, va).collect()}
    assert all(abs(look[i] - r[1]) < 1e-9 for i, r in a.items())
    assert loaded.stages[3].getOrDefault("clip") == 60.0 and loaded.stages[3].coefficients == fitted.stages[3].coefficients


def test_rows_without_a_feature_and_unseen_cells(spark, parts):
    tr, va = parts
    spoilt = va.withColumn("distance_km", F.when(F.col("id").cast("long") % 3 != 0, F.col("distance_km")))
    out = E.LeastSquares().fit(tr).transform(spoilt)
    assert out.count() == va.count() and out.where("prediction is null and distance_km is not null").count() == 0
    model = E.LookupBaseline().fit(tr.where("hour <> 3"))
    night = model.transform(va).where("hour = 3")
    assert night.where("not is_fallback").count() == 0 < night.count()
    assert E.LookupBaseline(inputCols=["vendor_id"]).fit(tr).transform(va).count() == va.count()


def test_walk_forward_of_an_estimator(spark, parts):
    df = parts[0].unionByName(parts[1])
    seen = {}
    got = {r.fold: r for r in E.walk_forward(df, FOLDS, E.LeastSquares(inputCols=["distance_km"]), {"clip": C.PRED_CLIP_MIN},
                                             each=seen.__setitem__).collect()}
    want = {r.fold: r for r in MD.walk_forward_linear(df, FOLDS[:2]).collect()}
    assert got.keys() == want.keys() == seen.keys()
    assert all(abs(got[f].rmse_seconds - want[f].rmse_seconds) < 0.02 and got[f].rows == want[f].rows for f in want)
    mllib = MD.linear_pipeline(["distance_km"])
    assert {r.fold for r in E.walk_forward(df, FOLDS, mllib).collect()} == {"one", "two"}
    trees = E.walk_forward(df, FOLDS[:1], E.BoostedTrees(), {"settings": {"trees": 3, "depth": 2, "rate": 0.5, "patience": None}}).first()
    assert trees.rows == want["one"].rows and trees.r2 > 0
    with pytest.raises(ValueError):
        E.walk_forward(df, FOLDS[2:], E.LeastSquares())
