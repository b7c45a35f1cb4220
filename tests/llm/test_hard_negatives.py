import math
import random

import numpy as np
from pyspark.sql import types as T

from tests.conftest import SF01
from tripsmith.llm import hard_negatives as H
from tripsmith.llm.common import table

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                     T.StructField("label", T.IntegerType()), T.StructField("rank", T.StringType()), T.StructField("_dim", T.StringType())])


def brute(rows, every=100):
    ok = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None
                               and None not in r[1] and all(map(math.isfinite, r[1]))), key=lambda r: (r[2], r[1])):
        ok.setdefault(i, ([math.floor(x * 256) for x in v], label))
    out = []
    for a, (x, label) in ok.items():
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (y, other) in ok.items() if i != a and len(y) == len(x))
        for p, pid in [(-s, i) for s, i, other in scored if other == label][:5]:
            fit = [(-s, i) for s, i, other in scored if other != label and 80 * p <= 100 * -s <= 100 * p][:5]
            out += [(a, pid, k + 1, i, p, s) for k, (s, i) in enumerate(fit)]
    return sorted(out)


def result(frame):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in frame.collect())


def test_given_table_in_one_cell_and_in_many(spark, monkeypatch):
    from tripsmith.llm.queries import op12_labels
    rows = op12_labels(table(spark, SF01, "embeddings"))
    held = [(r.vec_id, r.embedding, r.label) for r in rows.collect()]
    want = brute(held)
    assert result(H.hard_negatives(rows)) == want and len(want) > 20
    monkeypatch.setattr(H, "GRID_BYTES", 64 * 8 * 90)
    assert result(H.hard_negatives(rows, 10)) == brute(held, 10)


def test_edges(spark, monkeypatch):
    rng = random.Random(4)
    vec = lambda n=5: [rng.choice([-1.0, -0.25, 0.0, 0.125, 0.5, 1.0]) for _ in range(n)]
    hot = vec()
    rows = [(k, hot, 1 + k % 2) for k in range(150)] + [(200 + k, vec(), k % 3) for k in range(150)]
    rows += [(1000, None, 1), (1100, [1.0, None, 0.0, 0.0, 0.0], 1), (1200, [float("nan")] * 5, 1), (1300, [float("inf")] + [0.0] * 4, 1),
             (1400, hot, None), (None, hot, 1), (1500, [0.0] * 5, 1), (1600, [], 1), (1601, [], 2), (1602, [], 1), (1700, [1.0, 1.0], 1),
             (1701, [1.0, 0.5], 1), (1702, [1.0, 0.45], 3), (1800, vec(17), 1), (1801, vec(17), 1), (1802, vec(17), 2),
             (100, vec(), 0), (100, vec(), 2), (1900, [-1.0] * 3, 4), (1901, [1.0] * 3, 4), (1902, [1.0] * 3, 5)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS).repartition(3)
    want = brute([(r.vec_id, r.embedding, r.label) for r in frame.collect()])
    assert result(H.hard_negatives(frame)) == want
    assert {1600, 1700} <= {a for a, *_ in want} and 1900 not in {a for a, *_ in want}
    monkeypatch.setattr(H, "GRID_BYTES", 5 * 8 * 40)
    assert result(H.hard_negatives(frame)) == want
    assert result(H.hard_negatives(frame.where("false"))) == []
    assert result(H.hard_negatives(frame.where("vec_id % 100 > 0"))) == []
    big = spark.createDataFrame([(0, [1e6] * 5, 1, "", ""), (1, [1.0, 1e6, 1e6, 0.5, 7e5], 1, "", ""), (2, [9e5, 0.0, 1e6, 0.25, 7e5], 2, "", ""),
                                 (3, [9e5, 0.0, 1e6, 0.250001, 7e5], 2, "", "")], ROWS)
    assert result(H.hard_negatives(big)) == brute([(r.vec_id, r.embedding, r.label) for r in big.collect()]) != []


def test_bounds_hold_and_clustered_rows_are_ruled_out():
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((40, 4)).repeat(16, axis=1)
    x = np.floor(256 * (centres[rng.integers(0, 40, 8000)] + 0.1 * rng.standard_normal((8000, 64))))
    labels = rng.integers(0, 10, len(x))
    shard = H.Segments(np.arange(len(x)), labels, x)
    for k in range(0, 8000, 400):
        q, own = x[k], [level[0] for level in H.summaries(x[k:k + 1])]
        every = np.arange(len(x))
        scores = shard.vectors @ q
        for least, most in ((np.quantile(scores, 0.99), np.inf), (0.0, np.quantile(scores, 0.6))):
            left = shard.refined(every, q, own, least, most)
            assert set(np.flatnonzero((scores >= least) & (scores <= most))) <= set(left)
    shard.scored = 0
    for k in range(0, 8000, 400):
        best = [s for s, _ in shard.positives(k, int(labels[k]), x[k], [level[0] for level in H.summaries(x[k:k + 1])])]
        same = (x @ x[k])[(labels == labels[k]) & (np.arange(len(x)) != k)]
        assert best == sorted(same.tolist(), reverse=True)[:5]
    assert shard.scored < 0.5 * 20 * 800  # of the rows of one label
