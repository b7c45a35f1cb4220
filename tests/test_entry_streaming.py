import __spark_entry__ as E

from tripsmith.plans.catalog import ORACLES, QUERIES

# queries without a SQL oracle (rows-only check) and why
ROWS_ONLY = {"boosted_importance", "boosted_metrics", "attribution_power_boosted", "walk_forward_boosted"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].rows > 0
    assert set(df.columns) >= {"model", "rmse_seconds", "mape_pct", "mean_error_seconds",
                               "p95_error_seconds", "r2"}


def test_every_query_has_oracle_or_is_declared_rows_only():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(E.queries()) >= set(QUERIES)
    assert ORACLES.items() <= E.oracle_sql().items()


def test_stream_features_equal_batch(spark):
    from tripsmith.operators import clean as CL
    from tripsmith.sources.tables import trips
    from tripsmith.streaming import trips as STR
    sf = "/root/testdata/sf0.001"
    from tripsmith.sources.tables import table
    base = STR.scratch_path(spark, "t")
    STR.write_feed(table(spark, sf, "events"), base + "/feed")
    stream = STR.stream_features(STR.trip_stream(STR.events_stream(spark, base + "/feed")))
    path = STR.run_to_table(stream, base)
    STR.run_to_table(stream, base)  # started again with nothing new: nothing is read twice
    streamed = spark.read.parquet(path)
    batch = CL.processed(trips(spark, sf), "full")
    assert streamed.count() == batch.count() > 700
    assert streamed.select("id").exceptAll(batch.select("id")).count() == 0


def test_etl_end_to_end(spark):
    import tempfile

    from tripsmith.operators import clean as CL
    from tripsmith.plans.etl import run_etl
    from tripsmith.sources.tables import trips
    out = tempfile.mkdtemp(prefix="tripsmith-etl-") + "/processed"
    res = run_etl(trips(spark, "/root/testdata/sf0.001"), out, "events", min_rows=100,
                  verify_min_rows=100, run_id="t1")
    m = res.manifest.first()
    assert m.rows_after_cleaning == CL.processed(trips(spark, "/root/testdata/sf0.001"), "full").count() and m.run_id == "t1"
    shake = res.handshake.first()
    assert shake.matches and shake.rows_written == shake.rows_read == m.rows_after_cleaning
    assert not any(r.violated for r in res.verify.collect())
    # rerun gives the same fingerprint (idempotent overwrite)
    res2 = run_etl(trips(spark, "/root/testdata/sf0.001"), out, "events", min_rows=100,
                   verify_min_rows=100, run_id="t2")
    assert res2.manifest.first().processed_hash == m.processed_hash


def test_an_arrival_is_one_batch_however_many_files(spark):
    import os

    from tripsmith.operators import clean as CL
    from tripsmith.sources.tables import table, trips
    from tripsmith.streaming import trips as STR
    sf = "/root/testdata/sf0.001"
    base = STR.scratch_path(spark, "arrivals")
    path = STR.replay(table(spark, sf, "events").repartition(3), base, lambda s: STR.stream_features(STR.trip_stream(s())))
    base = base.removeprefix("file:")
    feed = [f for d in os.listdir(f"{base}/feed") for f in os.listdir(f"{base}/feed/{d}") if f.endswith(".parquet")]
    assert len(feed) > len(STR.FEED_CUTS) + 1 == len([f for f in os.listdir(f"{base}/checkpoint/commits") if f.isdigit()])
    assert spark.read.parquet(path).count() == CL.processed(trips(spark, sf), "full").count()
