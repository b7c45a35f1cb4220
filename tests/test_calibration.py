import numpy as np
from pyspark.sql import functions as F

from tripsmith.operators import calibration as CA


def test_bins_edges_and_max_in_no_bin(spark):
    rows = [(float(x), int(x > 15)) for x in range(0, 21)]     # preds 0..20
    df = spark.createDataFrame(rows, "prediction double, spike int")
    b = {r.bin: r for r in CA.spike_bins(df).collect()}
    edges = np.linspace(0, 20, 21)
    assert [b[i].low for i in range(20)] == list(edges[:-1]) and b[19].high == 20.0
    assert sum(r.train_rows for r in b.values()) == 20          # the maximum is in no bin
    # scoring side widens the last bin by +1 and maps outside values to 0
    val = spark.createDataFrame([(20.0,), (20.9,), (21.0,), (-1.0,)], "prediction double")
    got = [r.spike_prob for r in CA.spike_probability(val, CA.spike_bins(df)).orderBy("prediction").collect()]
    assert got == [0.0, 1.0, 1.0, 0.0]


def test_reliability_edge_goes_to_lower_bin(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.3,), (0.30000000000000004,), (1.0,)], "p double")
    got = [r.b for r in df.select(CA.reliability_bin("p").alias("b")).collect()]
    assert got == [0, 0, 2, 2, 9]


def test_isotonic_pools_ties_interpolates_and_clips(spark):
    fit = spark.createDataFrame([(0.1, 0), (0.1, 1), (0.2, 0), (0.3, 1)], "spike_prob double, spike int")
    model = CA.fit_isotonic(fit)
    q = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (0.25,), (0.3,), (0.9,)], "spike_prob double")
    got = [round(r.calibrated_prob, 9) for r in CA.apply_isotonic(model, q).orderBy("spike_prob").collect()]
    assert got == [round(x, 9) for x in [1 / 3, 1 / 3, 1 / 3, 2 / 3, 1.0, 1.0]]


def test_override_with_no_hits(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "calibrated_prob double, spike int")
    r = CA.override_analysis(df).first()
    assert r.override_count == 0 and r.precision is None and r.verdict is None
