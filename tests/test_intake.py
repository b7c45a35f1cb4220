import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tripsmith import config as C
from tripsmith.operators import pit as PIT
from tripsmith.operators import store as ST
from tripsmith.sources import sinks as SK
from tripsmith.sources import tables as TB
from tripsmith.streaming import demand as D
from tripsmith.streaming import trips as STR

HEADER = ",".join(C.RAW_COLUMNS)
GOOD = "7,1,2024-01-02 03:04:05,2024-01-02 03:14:05,2,-73.9,40.7,-73.8,40.8,N,600"


def test_csv_lines_are_typed_or_kept_apart(spark):
    path = SK.scratch_path(spark, "csv").removeprefix("file:")
    os.makedirs(path)
    lines = [GOOD, GOOD.replace("N", '"N, so"'), GOOD.replace("600", "oops"), GOOD + ",1", GOOD.rsplit(",", 3)[0], GOOD.replace("N", '"N'),
             GOOD.replace(",600", ',"600'), "", "just text", GOOD.replace("N", "").replace("7,", "8,", 1)]
    for k in range(2):
        with open(f"{path}/part{k}.csv", "w") as f:
            f.write("\n".join([HEADER, *lines]) + "\n")
    good, bad = TB.split_corrupt(TB.read_csv_lines(spark, path))
    rows = TB.typed_rows(good).collect()
    assert len(rows) == 8 and sorted(r.id for r in rows) == ["7"] * 6 + ["8"] * 2
    assert sorted(str(r.trip_duration) for r in rows) == ["600"] * 6 + ["None"] * 2
    assert {r.store_and_fwd_flag for r in rows} == {"N", "N, so", None}
    assert all(r.pickup_datetime == dt.datetime(2024, 1, 2, 3, 4, 5) for r in rows)
    counted = {r.fault: r.lines for r in SK.quarantine(bad, path + "-apart").collect()}
    assert counted == {"too many fields": 2, "too few fields": 4, "unclosed quote": 4}
    assert {r._line for r in bad.collect()} == set(lines[3:7]) | {"just text"}
    assert TB.read_csv_lines(spark, path).count() == 2 * (len(lines) - 1)


def brute_as_of(requests, view, ttl):
    out = {}
    for i, k, t in requests:
        held = [v for v in view if v[0] is not None and v[1] is not None and v[0] == k and t is not None and v[1] <= t]
        best = max(held, key=lambda v: (v[1], v[2]), default=None)
        out[i] = best[2] if best and (t - best[1]).total_seconds() <= ttl else None
    return out


@pytest.mark.parametrize("bucket", [3600, 86_400, 10_000_000])
def test_as_of_equals_brute_force(spark, bucket):
    rng = random.Random(bucket)
    start = dt.datetime(2024, 1, 1)
    at = lambda: start + dt.timedelta(minutes=rng.randrange(0, 14_400))
    key = lambda: rng.choice(["hot"] * 6 + ["b", "c", None])
    view = [(key(), at() if rng.random() > 0.03 else None, float(k)) for k in range(300)]
    view += [("hot", start, 900.0), ("hot", start, 901.0), ("late", start + dt.timedelta(days=20), 5.0)]
    requests = [(k, key(), at() if rng.random() > 0.03 else None) for k in range(400)] + [(900, "hot", start), (901, "none", start), (902, "late", start)]
    v = spark.createDataFrame(view, "user string, seen timestamp, x double").repartition(3)
    r = spark.createDataFrame([(*q, 1.5) for q in requests], "id int, user string, asked timestamp, x double").repartition(3)
    for ttl in (0, 7200, 200_000):
        rows = ST.as_of_features(r, v, "user", ["x"], "asked", "seen", ttl, bucket).collect()
        assert len(rows) == len(requests)
        assert {q.id: q.x for q in rows} == brute_as_of(requests, view, ttl)


def test_exact_demand_stream_counts_rows_late_ones_and_restarts(spark):
    """Rows in three arrivals; the second goes on from the first's checkpoint; a very late row is neither emitted nor counted."""
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"r{k}", start + dt.timedelta(seconds=rng.randrange(0, 36_000)), 1.0 if k % 7 else None) for k in range(500)]
    rows += [(f"t{k}", start + dt.timedelta(seconds=7200), 1.0) for k in range(30)]  # a hot instant
    cuts = [start + dt.timedelta(hours=h) for h in (3, 6, 11)]
    parts = [[r for r in rows if lo <= r[1] < hi] for lo, hi in zip([start, *cuts], cuts)]
    late = ("late", start + dt.timedelta(seconds=60), 1.0)
    parts[2] += [late, (None, None, 1.0), ("last", start + dt.timedelta(hours=15), 1.0)]
    schema = "id string, pickup_datetime timestamp, trip_duration double"
    for pieces in (3,):
        base = STR.scratch_path(spark, f"exact{pieces}")
        for group in ([0, 1], [2]):
            for k in group:
                spark.createDataFrame(parts[k], schema).coalesce(1).write.parquet(f"{base}/feed/arrival={k}")
            stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{base}/feed")
            path = D.run_exact(D.exact_demand(stream, pieces=pieces), base)
        got = {r.id: r.trip_count_last_1h for r in spark.read.parquet(path).collect()}
        assert spark.read.parquet(path).count() == len(got)
        live = spark.createDataFrame(rows, schema)
        want = {r.id: r.trip_count_last_1h for r in PIT.rolling_count(live).where(F.col("pickup_datetime") < start + dt.timedelta(hours=11)).collect()}
        assert got == want and len(want) == len(rows)
