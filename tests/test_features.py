import math

from pyspark.sql import functions as F

from tripsmith.functions.geo import haversine_km
from tripsmith.functions.numeric import rnd
from tripsmith.functions.time import time_feature_columns
from tripsmith.operators import clean as CL

RAW_COLS = ["id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
            "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
            "store_and_fwd_flag", "trip_duration"]


def raw(spark, rows):
    return spark.createDataFrame(rows, "id string, vendor_id int, pickup_datetime timestamp, "
                                 "dropoff_datetime timestamp, passenger_count int, pickup_longitude double, "
                                 "pickup_latitude double, dropoff_longitude double, dropoff_latitude double, "
                                 "store_and_fwd_flag string, trip_duration int")


def test_haversine_matches_formula(spark):
    df = spark.createDataFrame([(40.7580, -73.9855, 40.7127, -74.0134)], "a double, b double, c double, d double")
    got = df.select(haversine_km("a", "b", "c", "d").alias("km")).first().km
    p1, p2 = math.radians(40.7580), math.radians(40.7127)
    dp, dl = p2 - p1, math.radians(-74.0134) - math.radians(-73.9855)
    a = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    assert abs(got - 6371 * 2 * math.asin(math.sqrt(a))) < 1e-9


def test_time_features_monday_zero_and_rush(spark):
    import datetime as dt
    rows = [(dt.datetime(2024, 1, 1, 7, 0),), (dt.datetime(2024, 1, 6, 19, 59),), (dt.datetime(2024, 1, 7, 20, 0),)]
    df = spark.createDataFrame(rows, "t timestamp").select(*[c.alias(n) for n, c in time_feature_columns("t").items()])
    got = [tuple(r) for r in df.collect()]
    assert got == [(7, 0, 1, 0, 1), (19, 5, 1, 1, 1), (20, 6, 1, 1, 0)]


def _trip(i, dur, lat=40.7, lon=-74.0, dlat=40.75, dlon=-74.0, pax=1):
    import datetime as dt
    t = dt.datetime(2024, 1, 1, 12, 0)
    return (str(i), 1, t, t, pax, lon, lat, dlon, dlat, "N", dur)


def test_duration_bounds_are_strict(spark):
    df = raw(spark, [_trip(1, 60), _trip(2, 61), _trip(3, 7199), _trip(4, 7200)])
    ids = sorted(r.id for r in CL.clean(df, "full").collect())
    assert ids == ["2", "3"]


def test_distance_and_passenger_bounds(spark):
    # ~0.1 km north: 0.1 / 111.195 degrees
    step = 0.1 / (6371 * math.pi / 180)
    rows = [_trip(1, 600, dlat=40.7 + step * 0.999), _trip(2, 600, dlat=40.7 + step * 1.001),
            _trip(3, 600, pax=0), _trip(4, 600, pax=1)]
    ids = sorted(r.id for r in CL.clean(raw(spark, rows), "full").collect())
    assert ids == ["2", "4"]


def test_box_corners_inclusive(spark):
    rows = [_trip(1, 600, lat=40.4, lon=-74.5, dlat=41.0, dlon=-73.5),
            _trip(2, 600, lat=40.39, lon=-74.5, dlat=41.0, dlon=-73.5)]
    ids = sorted(r.id for r in CL.clean(raw(spark, rows), "full").collect())
    assert ids == ["1"]


def test_nan_coordinates_fail_filters(spark):
    rows = [_trip(1, 600, dlat=float("nan")), _trip(2, 600, dlat=None)]
    assert CL.clean(raw(spark, rows), "full").count() == 0
    assert CL.clean(raw(spark, rows), "model").count() == 0


def test_funnel_matches_fixture_counts(spark):
    from tripsmith.sources.tables import trips
    r = CL.clean_funnel(trips(spark, "/root/testdata/sf0.001")).first()
    assert (r.raw_rows, r.after_duration, r.after_distance, r.after_passengers, r.after_box) == \
        (1000, 967, 953, 743, 739)
    assert abs(r.sum_km - 1531.2183) < 1e-6


def test_rnd_is_half_even_on_binary_value(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,)], "x double")
    got = [r[0] for r in df.select(rnd("x", 2)).collect()] + [df.select(rnd(F.lit(2.5), 0)).first()[0]]
    assert got == [0.12, 0.38, 2.5, 2.0]


def test_filters_read_computed_columns(spark, capsys):
    from tripsmith.operators import clean as CL
    from tripsmith.sources.tables import trips
    CL.processed(trips(spark, "/root/testdata/sf0.001")).select("id").explain()
    plan = capsys.readouterr().out
    assert plan.count("104729") == 1  # the latitude's expression, not a copy of it in each condition
