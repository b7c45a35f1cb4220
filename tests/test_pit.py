import datetime as dt

from tripsmith.operators import pit as PIT

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, pickup_datetime timestamp, trip_duration int")


def test_rolling_count_ties_excluded(spark):
    s = dt.timedelta(seconds=1)
    rows = [("a", T0, 100), ("b", T0, 100), ("c", T0, 100), ("d", T0 + 10 * s, 100),
            ("e", T0 + 3600 * s, 100), ("f", T0 + 3610 * s, 100)]
    for method in ("scan", "halo"):
        got = {r.id: r.trip_count_last_1h for r in PIT.rolling_count(frame(spark, rows), method=method).collect()}
        assert [got[k] for k in "abcdef"] == [0, 0, 0, 3, 4, 2], method


def test_rolling_count_counts_non_null_targets(spark):
    s = dt.timedelta(seconds=1)
    rows = [("a", T0, 1), ("b", T0 + s, 2), ("c", T0 + 2 * s, None), ("d", T0 + 3 * s, 4)]
    for method in ("scan", "halo"):
        got = {r.id: r.trip_count_last_1h for r in PIT.rolling_count(frame(spark, rows), method=method).collect()}
        assert [got[k] for k in "abcd"] == [0, 1, 2, 2]


def test_scan_equals_halo_on_skewed_time(spark):
    # a third of all rows share one instant, another third one hour
    rows = [(f"h{i}", T0, i % 50) for i in range(300)]
    rows += [(f"m{i}", T0 + dt.timedelta(minutes=i % 60, seconds=i % 7), 5) for i in range(300)]
    rows += [(f"r{i}", T0 + dt.timedelta(hours=i % 40, minutes=i % 13), 9) for i in range(300)]
    df = frame(spark, rows)
    a = {r.id: r.trip_count_last_1h for r in PIT.rolling_count(df, method="scan").collect()}
    b = {r.id: r.trip_count_last_1h for r in PIT.rolling_count(df, method="halo").collect()}
    assert a == b
    assert PIT.pit_violations(PIT.rolling_count(df)).first().violations == 0


def test_avg_same_hour_rows_frame_and_fallback(spark):
    d = dt.timedelta(days=1)
    rows = [("a", T0, 100), ("b", T0 + d, 200), ("c", T0 + 3 * d, 400), ("x", T0 + dt.timedelta(hours=1), 1000)]
    got = {r.id: r.avg_duration_same_hour_last7days for r in PIT.avg_same_hour(frame(spark, rows)).collect()}
    gmean = (100 + 200 + 400 + 1000) / 4
    assert got["a"] == gmean and got["x"] == gmean       # no history -> global mean
    assert got["b"] == 100.0 and got["c"] == 150.0       # previous observed days
    days = {r.id: r.avg_duration_same_hour_last7days
            for r in PIT.avg_same_hour(frame(spark, rows), frame="days", fallback="none").collect()}
    assert days["c"] == 150.0 and days["a"] is None


def test_no_window_has_two_moving_ends(spark, capsys):
    rows = [(str(i), dt.datetime(2024, 1, 1, 0, 0, i % 60), 100 if i % 7 else None) for i in range(200)] + [("n", None, 5), ("m", None, None)]
    halo = PIT.rolling_count(frame(spark, rows), method="halo")
    halo.explain()
    plan = capsys.readouterr().out
    assert "RangeFrame" in plan and f"-{PIT.HOUR_US}" not in plan  # such a window is summed anew for every row
    timed = {r.id: r.trip_count_last_1h for r in PIT.rolling_count(frame(spark, rows)).collect() if r.id not in ("n", "m")}
    assert {r.id: r.trip_count_last_1h for r in halo.collect()} == {**timed, "n": 2, "m": 2}
