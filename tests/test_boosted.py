import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripsmith.operators import boosted as B
from tripsmith.sources.sinks import scratch_path

FEATURES = ["a", "b", "c"]


def rows(n=1500, seed=1):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 12, n).astype(float), rng.normal(0, 1, n).round(2), rng.choice([0.0, 1.0], n)], axis=1)
    x[rng.random(x.shape) < 0.06] = np.nan
    y = 10 * np.nan_to_num(x[:, 0], nan=3.0) + 20 * (np.nan_to_num(x[:, 1], nan=-1.0) > 0.3) + 5 * np.nan_to_num(x[:, 2]) + rng.normal(0, 2, n)
    return x, y.round(3), rng.integers(1, 4, n).astype(float)


def frame(spark, x, y, w):
    data = [(f"k{i}", *(None if math.isnan(v) else float(v) for v in r), float(t), float(u)) for i, (r, t, u) in enumerate(zip(x, y, w))]
    return spark.createDataFrame(data, "id string, a double, b double, c double, y double, w double").repartition(4)


def brute_tree(x, y, w, depth, p, cuts):
    """One tree on raw values, grown by trying every cut and both sides for missing values; predictions of the rows."""
    base = (w * y).sum() / w.sum()
    out = np.full(len(y), base)
    level = [np.arange(len(y))]
    for d in range(depth + 1):
        after = []
        for mine in level:
            r, u = (y - base)[mine], w[mine]
            out[mine] = base + p.rate * (u * r).sum() / (u.sum() + p.l2)
            if d == depth:
                continue
            best = None
            for j in range(x.shape[1]):
                v, none = x[mine, j], np.isnan(x[mine, j])
                for side in ((True, False) if none.any() else (True,)):
                    for c in cuts[j]:
                        left = np.where(none, side, v <= c)
                        hl, hr = u[left].sum(), u[~left].sum()
                        if hl < p.min_weight or hr < p.min_weight:
                            continue
                        gl, gr = (u * r)[left].sum(), (u * r)[~left].sum()
                        gain = gl ** 2 / (hl + p.l2) + gr ** 2 / (hr + p.l2) - (gl + gr) ** 2 / (hl + hr + p.l2)
                        if gain > 1e-6 and (best is None or gain > best[0] * (1 + 1e-9)):
                            best = (gain, left)
            if best is not None:
                after += [mine[best[1]], mine[~best[1]]]
        level = after
    return out


@pytest.mark.parametrize("depth, weight", [(1, None), (3, "w")])
def test_one_tree_equals_brute_force(spark, depth, weight):
    x, y, w = rows()
    p = B.Params(trees=1, depth=depth, rate=0.7, row_share=1.0, column_share=1.0, patience=None, bins=20)
    df = frame(spark, x, y, w)
    model = B.fit_boosted(df, FEATURES, "y", weight=weight, params=p)
    cuts = [sorted({np.sort(v[~np.isnan(v)])[max(0, math.ceil((k + 1) / 20 * (~np.isnan(v)).sum()) - 1)] for k in range(19)}) for v in x.T]
    want = brute_tree(x, y, w if weight else np.ones(len(y)), depth, p, cuts)
    got = {r.id: r.p for r in df.select("id", model.score().alias("p")).collect()}
    assert np.allclose([got[f"k{i}"] for i in range(len(y))], want, atol=1e-9)
    cover = {r.node: r.cover for r in model.node_table(spark).collect()}
    assert abs(cover[0] - (w.sum() if weight else len(y))) < 1e-9 and abs(cover[1] + cover[2] - cover[0]) < 1e-9


def test_boosting_lowers_the_error_stops_and_is_saved(spark, monkeypatch):
    monkeypatch.setattr(B, "WRITE_EVERY", 3)
    x, y, w = rows()
    xv, yv, wv = rows(500, seed=2)
    p = B.Params(trees=60, depth=3, rate=0.4, patience=4, min_weight=5.0)
    train, val = frame(spark, x, y, w), frame(spark, xv, yv, wv)
    model = B.fit_boosted(train, FEATURES, "y", validation=val, params=p)
    assert len(model.history) < 61 and len(model.trees) == int(np.argmin(model.history)) and model.history[len(model.trees)] < 0.3 * model.history[0]
    assert len(model.history) - 1 - len(model.trees) == 4
    scored = val.select("id", "y", model.score().alias("p"))
    rmse = scored.agg(F.sqrt(F.avg(F.pow(F.col("y") - F.col("p"), 2)))).first()[0]
    assert abs(rmse - min(model.history)) < 1e-9  # predictions kept in the rows equal the model's
    again = B.fit_boosted(train.repartition(7), FEATURES, "y", validation=val, params=p)
    assert np.allclose(again.history, model.history)  # rows are drawn by key, not by place
    path = scratch_path(spark, "model")
    model.save(spark, path)
    loaded = B.BoostedModel.load(spark, path)
    assert np.array_equal(loaded.predict(xv), model.predict(xv)) and loaded.history == model.history
    imp = model.importance(spark).collect()
    assert imp[0].feature == "a" and abs(sum(r.importance for r in imp) - 1) < 1e-9 and all(r.splits > 0 for r in imp)


def expectation(model, tree, k, row, known):
    """What a tree says of a row of which only some features are known: unknown splits weigh their children by cover."""
    if tree.feature[k] < 0:
        return tree.value[k]
    f, a, b = tree.feature[k], 2 * k + 1, 2 * k + 2
    if f in known:
        v = row[f]
        left = tree.missing_left[k] if math.isnan(v) else v <= tree.cut[k]
        return expectation(model, tree, a if left else b, row, known)
    return (tree.cover[a] * expectation(model, tree, a, row, known) + tree.cover[b] * expectation(model, tree, b, row, known)) / tree.cover[k]


def test_attributions_equal_shapley_values_over_all_subsets(spark):
    x, y, w = rows(600)
    model = B.fit_boosted(frame(spark, x, y, w), FEATURES, "y", params=B.Params(trees=4, depth=4, rate=0.5, min_weight=3.0, patience=None))
    some = np.concatenate([x[:40], [[np.nan] * 3, [np.nan, 1.0, np.nan], [1e9, -1e9, 0.5]]])
    df = frame(spark, some, np.zeros(len(some)), np.ones(len(some)))
    got = {r.id: r.phi for r in df.select("id", model.attributions().alias("phi")).collect()}
    assert abs(model.expected_value() - (model.base + sum(expectation(model, t, 0, some[0], set()) for t in model.trees))) < 1e-9
    for i, row in enumerate(some):
        for f in range(3):
            rest = [j for j in range(3) if j != f]
            want = 0.0
            for n in range(3):
                for s in itertools.combinations(rest, n):
                    k = math.factorial(n) * math.factorial(2 - n) / 6
                    want += k * sum(expectation(model, t, 0, row, {*s, f}) - expectation(model, t, 0, row, set(s)) for t in model.trees)
            assert abs(got[f"k{i}"][f] - want) < 1e-9
    check = B.additivity(df.withColumn("prediction", model.score()), model, tolerance=1e-6).first()
    assert (check.rows_checked, check.violations) == (len(some), 0)
    spoilt = df.withColumn("prediction", F.when(F.col("id") != "k0", model.score() + F.when(F.col("id") == "k1", 2.0).otherwise(0.0)))
    assert B.additivity(spoilt, model).first().violations == 2
    assert B.tree_attribution(df, model).count() == 3 * len(some)
    assert model.leaf_path_table(spark).where("share <= 0 or share > 1").count() == 0


def test_edges(spark):
    x, y, w = rows(60)
    df = frame(spark, x, y, w)
    with pytest.raises(ValueError):
        B.fit_boosted(df.where("false"), FEATURES, "y")
    flat = B.fit_boosted(df.withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(1.0)), ["a", "b"], "y",
                        params=B.Params(trees=2, row_share=1.0, patience=None))
    assert np.allclose([r[0] for r in df.withColumns({"a": F.lit(1.0)}).select(flat.score()).collect()], y.mean())
    gone = B.fit_boosted(df.withColumn("y", F.when(F.col("id") != "k3", F.col("y"))), FEATURES, "y", params=B.Params(trees=1, row_share=1.0, patience=None))
    assert gone.trees[0].cover[0] == 59
    assert df.where("false").select(gone.score()).count() == 0


def test_more_trees_plan_no_more_queries(spark):
    x, y, w = rows(300)
    df = frame(spark, x, y, w)
    planned = spark._jsparkSession.sharedState().statusStore().executionsCount
    counts = []
    for trees in (1, 4):
        before = planned()
        B.fit_boosted(df, FEATURES, "y", params=B.Params(trees=trees, depth=3, min_weight=3.0, patience=None))
        counts.append(planned() - before)
    assert counts[0] == counts[1]  # a level is a job over blocks of rows, not a query


def test_reducers_add_up_what_the_driver_adds_up(spark, monkeypatch):
    x, y, w = rows(900)
    assert [B._tasks(n, 8) for n in (0, 60_000, 250_000, 4_000_000, 24_000_000)] == [1, 1, 3, 8, 24]
    p = B.Params(trees=4, depth=3, min_weight=3.0, patience=None)
    monkeypatch.setattr(B, "TASK_ROWS", 200)
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    fits = [B.fit_boosted(frame(spark, x, y, w), FEATURES, "y", weight="w", params=p)]
    monkeypatch.setattr(B, "_FEW_TASKS", 1)
    fits.append(B.fit_boosted(frame(spark, x, y, w), FEATURES, "y", weight="w", params=p))
    assert np.allclose(fits[0].predict(x), fits[1].predict(x), atol=1e-9)


def test_shapley_values_of_long_paths_add_up():
    shares = [0.1 * (k + 1) for k in range(9)]
    start = time.perf_counter()
    table = B._shapley(3.0, shares)
    assert time.perf_counter() - start < 1.0  # no loop over subsets
    met = np.arange(2 ** 9)[:, None] >> np.arange(9) & 1
    assert np.allclose(table.sum(axis=1), 3.0 * (met.all(axis=1) - np.prod(shares)))
