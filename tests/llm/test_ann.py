import random

import numpy as np
from pyspark.sql import types as T

from tests.conftest import SF01
from tripsmith.llm import ann as A
from tripsmith.llm.common import table

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("rank", T.StringType()),
                        T.StructField("_v", T.StringType())])


def brute(rows, asked, k=5):
    """{query id: [(score, vec_id)]} over usable rows."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, x in ok:
        if asked(q):
            best = sorted({(-(x * y).sum() / np.sqrt((x ** 2).sum()) / np.sqrt((y ** 2).sum()), i) for i, y in ok if i != q and len(y) == len(x)})
            out[q] = [(i, -s) for s, i in best[:k]]
    return {q: v for q, v in out.items() if v}


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in v}) for q, v in want.items()) / sum(map(len, want.values()))


def test_recall_on_the_given_table_in_several_shards_and_blocks(spark, monkeypatch):
    vectors = table(spark, SF01, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    want = brute(rows, lambda q: q % 50 == 0)
    assert recall(found(A.nearest(vectors, vectors.where("vec_id % 50 = 0"))), want) >= 0.99
    monkeypatch.setattr(A, "SHARD_ROWS", 100)
    monkeypatch.setattr(A, "QUERY_BLOCK", 3)
    monkeypatch.setattr(A, "CANDIDATES", 1200)
    assert recall(found(A.nearest(vectors, vectors.where("vec_id % 50 = 0"))), want) >= 0.9


def test_recall_of_one_large_shard():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((16_384, 64)).astype(np.float32).astype(float)
    f = A.Forest(np.arange(len(x)), x, 5)
    norm = np.sqrt((x ** 2).sum(axis=1))
    hit = 0
    got = {}
    for q, i, _ in f.search(np.arange(0, len(x), 400), x[::400]):
        got.setdefault(q, set()).add(i)
    for q, near in got.items():
        score = x @ x[q] / norm / norm[q]
        score[q] = -2
        hit += len(near & set(np.argsort(-score)[:5].tolist()))
    assert hit / (5 * len(got)) >= 0.9


def test_full_clustered_shards_score_a_tenth():
    """Production parameters on two full shards of clustered vectors: recall over both, and the share that is scored."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((400, 64))
    x = centres[rng.integers(0, 400, 2 * A.SHARD_ROWS)] + 0.5 * rng.standard_normal((2 * A.SHARD_ROWS, 64))
    ids, asked = np.arange(len(x)), np.arange(0, len(x), 300)
    near, scored = {}, 0
    for part in (ids % 2 == 0, ids % 2 == 1):
        f = A.Forest(ids[part], x[part], 5)
        for q, i, s in f.search(asked, x[asked]):
            near.setdefault(q, []).append((-s, i))
        scored += f.scored
    unit = x / np.sqrt((x ** 2).sum(axis=1))[:, None]
    hit = 0
    for q in asked.tolist():
        score = unit @ unit[q]
        score[q] = -2
        hit += len({i for _, i in sorted(near[q])[:5]} & set(np.argsort(-score)[:5].tolist()))
    assert hit >= 0.9 * 5 * len(asked) and scored <= 0.1 * len(x) * len(asked)


def test_edges(spark):
    rng = random.Random(1)
    vec = lambda: [rng.uniform(-1, 1) for _ in range(4)]
    hot = vec()
    rows = [(k, hot) for k in range(300)] + [(1000 + k, vec()) for k in range(50)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 4), (2003, [1.0, None, 0.0, 0.0]), (2004, [float("nan")] * 4), (2005, [float("inf"), 0.0, 0.0, 0.0]),
             (None, hot), (50, hot), (2050, [1.0, 2.0]), (2051, [2.0, 1.0]), (2100, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3)
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    got, want = found(A.nearest(frame, frame.where("vec_id % 50 = 0"))), brute(rows, lambda q: q % 50 == 0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a - b) < 1e-12 for q in got for (_, a), (_, b) in zip(got[q], want[q]))
    assert 2100 not in got and [i for i, _ in got[2050]] == [2051] and [i for i, _ in got[0]] == [1, 2, 3, 4, 5]
    assert A.nearest(frame.where("false"), frame.where("false")).count() == 0
    assert A.nearest(frame, frame.where("false")).count() == 0
