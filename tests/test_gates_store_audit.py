import os
import tempfile

import pytest

from tripsmith.operators import audit as AU
from tripsmith.operators import gates as G
from tripsmith.sources import registry as R
from tripsmith.sources.tables import read_raw_csv, read_raw_csv_text

HEADER = ("id,vendor_id,pickup_datetime,dropoff_datetime,passenger_count,pickup_longitude,"
          "pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag,trip_duration")


def _csv(lines):
    d = tempfile.mkdtemp(prefix="tripsmith-csv-")
    p = os.path.join(d, "raw.csv")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return p


def test_csv_contract_bad_values_counted(spark):
    p = _csv([HEADER,
              "a,1,2016-01-01 10:00:00,2016-01-01 10:10:00,1,-73.98,40.75,-73.99,40.76,N,600",
              "b,x,not a time,2016-01-01 10:10:00,1,-73.98,40.75,-73.99,40.76,N,600"])
    bad = {r.column: r.bad_values for r in G.type_violations(read_raw_csv_text(spark, p)).collect()}
    assert bad["vendor_id"] == 1 and bad["pickup_datetime"] == 1 and bad["trip_duration"] == 0
    typed = read_raw_csv(spark, p).orderBy("id").collect()
    assert typed[1].vendor_id is None and typed[1].pickup_datetime is None


def test_missing_and_renamed_columns(spark):
    p = _csv([HEADER.replace("trip_duration", "duration")])
    df = read_raw_csv_text(spark, p)
    assert G.missing_columns(df) == ["trip_duration"]
    assert df.count() == 0


def test_quality_gates_flags_and_raise(spark):
    import datetime as dt
    rows = [(float(i % 3 == 0) * 0.0 + (0.0 if i % 3 == 0 else 40.7), -74.0, 40.7, -74.0,
             -5 if i == 1 else 600, dt.datetime(2016, 1, 1)) for i in range(30)]
    df = spark.createDataFrame(rows, "pickup_latitude double, pickup_longitude double, dropoff_latitude double,"
                               " dropoff_longitude double, trip_duration int, pickup_datetime timestamp")
    gates = {r.gate: r.violated for r in G.quality_gates(df, min_rows=10).collect()}
    assert gates["zero_rate:pickup_latitude"] and gates["negative_target"] and gates["bad_gps_rate"]
    assert not gates["row_count"] and not gates["future_timestamps"]
    with pytest.raises(G.GateViolation):
        G.raise_on_violation(G.quality_gates(df, min_rows=10))


def test_registry_unknown_and_services(spark):
    assert [r.feature for r in R.unknown_features(spark, ["hour", "nope"]).collect()] == ["nope"]
    with pytest.raises(ValueError):
        R.validate_feature_request(spark, ["hour", "nope"])
    inf = {r.feature for r in R.service_features(spark, "inference_features").collect()}
    train = {r.feature for r in R.service_features(spark, "training_features").collect()}
    assert len(inf) == 12 and train - inf == {"trip_count_last_1h", "avg_duration_same_hour_last7days"}


def test_registry_audit_flags_unavailable_feature(spark):
    rank = spark.createDataFrame([("distance_km", 10.0, 0.8, 1, True),
                                  ("trip_count_last_1h", 2.0, 0.15, 2, False),
                                  ("mystery", 1.0, 0.05000001, 3, False)],
                                 "feature string, mean_abs_attribution double, fraction double, rank int, dominant boolean")
    a = {r.feature: r.status for r in AU.registry_audit(rank, R.registry_features(spark)).collect()}
    assert a == {"distance_km": "OK", "trip_count_last_1h": "LEAKAGE", "mystery": "WARNING"}
    assert AU.leakage_verdict(AU.registry_audit(rank, R.registry_features(spark))).first().verdict == \
        "LEAKAGE_DETECTED"


def test_linear_attribution_is_additive(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(str(i), float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(100, 2)))]
    df = spark.createDataFrame(rows, "id string, a double, b double")
    scored = df.selectExpr("*", "5 + 3 * a - 2 * b as prediction")
    v = AU.additivity_violations(scored, {"a": 3.0, "b": -2.0}, 5.0, df).first()
    off = scored.selectExpr("id", "a", "b", "case when id = '7' then null when id < '2' then prediction + 1.5 else prediction end as prediction")
    assert AU.additivity_violations(off, {"a": 3.0, "b": -2.0}, 5.0, df).first().violations == \
        1 + sum(i < "2" for i, _, _ in rows)
    assert v.rows_checked == 100 and v.violations == 0 and v.max_abs_diff < 1e-9


def test_scenarios_take_any_feature_and_reject_unknown_keys(spark):
    df = spark.createDataFrame([("a", 3, 1, 2.5), ("b", 4, 2, 1.0)], "id string, hour int, month int, distance_km double")
    got = {(r.base_id, r.scenario): (r.hour, r.month, r.distance_km) for r in AU.scenario_rows(
        df, [{"scenario": "s", "month": 6}, {"scenario": "d", "distance_delta": 1.0}]).collect()}
    assert got == {("a", "s"): (3, 6, 2.5), ("b", "s"): (4, 6, 1.0), ("a", "d"): (3, 1, 3.5), ("b", "d"): (4, 2, 2.0)}
    with pytest.raises(ValueError):
        AU.scenario_rows(df, [{"scenario": "s", "colour": 1}])
    with pytest.raises(ValueError):
        AU.scenario_rows(df, [{"scenario": "s", "vendor_id": 1}])


def test_fingerprint_sees_nulls_places_and_content(spark):
    from tripsmith.sources.sinks import table_fingerprint

    def fp(rows):
        return table_fingerprint(spark.createDataFrame(rows, "a string, b string, c double").repartition(3)).first().fingerprint
    base = fp([(None, "1", 0.5), ("x", None, None)])
    assert base == fp([("x", None, None), (None, "1", 0.5)])
    others = [[("1", None, 0.5), ("x", None, None)], [(None, "1", 0.6), ("x", None, None)], [(None, "1", 0.5)],
              [("N", "1", 0.5), ("x", None, None)], [(None, "1|", 0.5), ("x", None, None)]]
    assert len({base, *map(fp, others)}) == len(others) + 1


def test_metrics_runs_are_kept_apart_and_replaced(spark):
    from tripsmith.operators import metrics as M
    from tripsmith.sources import sinks as SK
    from tripsmith.streaming.trips import scratch_path
    path = scratch_path(spark, "runs")

    def rows(x):
        return spark.createDataFrame([("base", 10.0 + x, 1.0, 60.0), ("new", 5.0 + x, -20.0, 30.0)],
                                     "model string, rmse_seconds double, mean_error_seconds double, p95_error_seconds double")
    for run, x in (("r1", 0.0), ("r2", 1.0), ("r2", 2.0)):
        SK.append_metrics(rows(x), path, run)
    stored = spark.read.parquet(path)
    assert stored.count() == 4
    out = {r.model: r for r in M.model_comparison(SK.one_run(stored, "r2"), "base", "base").collect()}
    assert len(out) == 2 and out["new"].improvement_vs_baseline_pct == 41.67 and out["new"].verdict_vs_baseline == "strong"


def test_point_in_time_recount_finds_planted_errors_and_hot_instants(spark, monkeypatch):
    from pyspark.sql import functions as F

    from tripsmith.operators import pit as P
    monkeypatch.setattr(P, "HOT_ROWS", 50)
    rows = [(str(k), 1_700_000_000 + (7 if k < 300 else (k * 977) % 20_000), 5 if k % 9 else None) for k in range(900)]
    df = spark.createDataFrame(rows, "id string, s long, trip_duration int").select(
        "id", F.col("s").cast("timestamp").alias("pickup_datetime"), "trip_duration").repartition(4)
    a = P.rolling_count(df)
    times = [(s, v) for _, s, v in rows]
    want = {i: sum(1 for t, v in times if v is not None and s - 3600 <= t < s) for i, s, _ in rows}
    assert {r.id: r.trip_count_last_1h for r in a.collect()} == want
    assert {r.id: r.trip_count_last_1h for r in P.rolling_count(df, method="halo").collect()} == want
    v = P.pit_violations(a).first()
    assert (v.rows_checked, v.violations) == (900, 0)
    bad = a.withColumn("trip_count_last_1h", F.col("trip_count_last_1h") + F.when(F.col("id").cast("long") % 100 == 1, 1).otherwise(0))
    assert P.pit_violations(bad).first().violations == 9


def test_split_is_found_before_features_are_joined(spark, monkeypatch):
    from tripsmith.operators import store as ST
    from tripsmith.operators.splits import temporal_split
    from tripsmith.plans.catalog import processed_full
    given = []
    monkeypatch.setattr(ST, "temporal_split", lambda df, *a: given.append(df.columns) or temporal_split(df, *a))
    df, available, _ = ST.get_historical_features(processed_full(spark, "/root/testdata/sf0.001"))
    assert "trip_count_last_1h" not in given[0] and "trip_count_last_1h" in df.columns and "split" not in available
