import numpy as np
from pyspark.sql import functions as F

from tripsmith.operators import ordering as R
from tripsmith.operators.ordering import exact_percentile, prefix_sum, rows_at, with_global_position


def test_global_position_is_a_total_order(spark):
    rows = [(i % 3, f"k{i:03d}") for i in range(200)]   # heavy ties on the first key
    df = spark.createDataFrame(rows, "t int, k string")
    got = sorted((r.t, r.k, r.pos) for r in with_global_position(df, ["t", "k"]).collect())
    assert [p for _, _, p in got] == list(range(200))


def test_exact_percentile_matches_numpy_with_hot_value(spark):
    rng = np.random.default_rng(1)
    vals = np.concatenate([np.full(400, 7.0), rng.normal(100, 30, 800)])
    grp = np.array(["a"] * 600 + ["b"] * 600)
    df = spark.createDataFrame([(str(g), float(v), i) for i, (g, v) in enumerate(zip(grp, vals))],
                               "g string, v double, i long")
    whole = exact_percentile(df, "v", 0.95).first()[0]
    assert abs(whole - np.percentile(vals, 95)) < 1e-9
    per = {r.g: r.v_q for r in exact_percentile(df, "v", 0.3, by=["g"]).collect()}
    for g in ("a", "b"):
        assert abs(per[g] - np.percentile(vals[grp == g], 30)) < 1e-9


def test_prefix_sum_exclusive(spark):
    df = spark.createDataFrame([(k, w) for k, w in zip(range(50, 0, -1), range(1, 51))], "k long, w long")
    got = sorted((r.k, r.prefix) for r in prefix_sum(df, ["k"], "w").collect())
    ws = [w for _, w in sorted(zip(range(50, 0, -1), range(1, 51)))]
    assert [p for _, p in got] == list(np.cumsum([0] + ws[:-1]))


def test_exact_percentile_of_mostly_one_value_without_moving_rows(spark):
    rng = np.random.default_rng(2)
    vals = np.concatenate([np.full(9000, 3.0), rng.normal(0, 1, 1000)])
    rng.shuffle(vals)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for q in (0.0, 0.03, 0.05, 0.5, 0.97, 1.0):
            out = exact_percentile(df, "v", q)
            assert abs(out.first()[0] - np.percentile(vals, 100 * q)) < 1e-9
        plan = out._jdf.queryExecution().explainString(out._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert exact_percentile(df.where("v > 1e9"), "v", 0.5).count() == 0


def test_rows_at_cuts_through_ties(spark):
    rows = [(k // 40, f"k{k:04d}") for k in range(1000)] + [(13, f"z{k:04d}") for k in range(600)]
    df = spark.createDataFrame(rows, "t long, k string").repartition(5)
    order = sorted(rows)
    for fractions in ([0.75, 0.8], [0.0, 0.999], [0.4, 0.41], [0.5, 1.0]):
        want = [order[int(len(rows) * f)] if int(len(rows) * f) < len(rows) else None for f in fractions]
        assert rows_at(df, "t", "k", fractions) == want
    assert rows_at(df.where("false"), "t", "k", [0.5]) == [None]


def test_exact_percentile_of_few_rows(spark):
    for n in (1, 2, 3, 5, 21, 101, 474, 475, 500):
        vals = [float((k * 7919) % 1009) for k in range(n)]
        df = spark.createDataFrame([(v,) for v in vals], "v double")
        for q in (0.05, 0.5, 0.95):
            assert abs(exact_percentile(df, "v", q).first()[0] - np.percentile(vals, 100 * q)) < 1e-9


def test_wide_brackets_are_narrowed_to_a_bounded_count(spark, monkeypatch):
    """All-distinct values, and hot ones, with a lowered bound and a wide first bracket."""
    rng = np.random.default_rng(5)
    vals = {"a": rng.normal(0, 1, 30_000), "b": np.concatenate([np.full(9_000, 0.25), rng.normal(0, 1, 21_000)]), "c": np.arange(40.0)}
    df = spark.createDataFrame([(g, float(v)) for g, x in vals.items() for v in x], "g string, v double").repartition(6)
    whole = np.concatenate(list(vals.values()))
    monkeypatch.setattr(R, "_SKETCH", 60)  # a coarse first bracket; the passes' steps are coarser still
    monkeypatch.setattr(R, "_ERRORS", 6)
    monkeypatch.setattr(R, "_STEPS", 3)
    monkeypatch.setattr(R, "_GRID", [0.0, 1 / 3, 2 / 3, 1.0])
    monkeypatch.setattr(R, "MAX_COUNTED", 500)
    for q in (0.0, 0.31, 0.5, 0.95, 1.0):
        per = {r.g: r.v_q for r in exact_percentile(df, "v", q, by=["g"]).collect()}
        for g, x in vals.items():
            assert abs(per[g] - np.percentile(x, 100 * q)) < 1e-9
        assert abs(exact_percentile(df, "v", q).first()[0] - np.percentile(whole, 100 * q)) < 1e-9


def test_narrowing_bounds_the_counted_values(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_COUNTED", 300)
    monkeypatch.setattr(R, "_ERRORS", 2000)  # the first bracket holds 8 % of the rows
    rng = np.random.default_rng(7)
    x = rng.permutation(50_000).astype(float)
    df = spark.createDataFrame([(float(v), f"k{int(v):05d}") for v in x], "v double, k string").repartition(5)
    base = df.select(df.v.alias("_v"))
    first = base.agg(*R.bracket("_v", 0.6))
    lo, hi, _ = R.narrowed(base, first.checkpoint(), 0.6, []).first()
    wide_lo, wide_hi, _ = first.first()
    assert wide_hi - wide_lo > 3000 and hi - lo <= 330 and lo <= 0.6 * 49_999 <= hi
    order = sorted((int(v), f"k{int(v):05d}") for v in x)
    assert rows_at(df, "v", "k", [0.3, 0.75, 1.0]) == [order[15_000], order[37_500], None]


def test_rows_at_shared_values_read_the_table_three_times(spark):
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(1000).selectExpr("id div 200 as v", "cast(id as string) as k").repartition(4)
    want = sorted((r.v, r.k) for r in df.collect())
    counted = df.mapInArrow(read, df.schema)
    assert rows_at(counted, "v", "k", [0.25, 0.5, 0.7]) == [want[250], want[500], want[700]]
    assert seen.value == 3000  # sketches, counts, rows of all shared values
