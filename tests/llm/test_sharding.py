import random
import zlib
from collections import Counter

import numpy as np

from tests.conftest import SF01
from tripsmith.llm import sharding as S
from tripsmith.llm.common import table


def check(rows, pairs, shards):
    assert len(rows) == len(pairs)
    want = sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    load = np.zeros(shards)
    slots = [[] for _ in range(shards)]
    for r in rows:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots)
    return load


def test_given_table(spark):
    docs = table(spark, SF01, "documents")
    rows = S.assign_shards(docs).collect()
    load = check(rows, [(r.doc_id, r.text) for r in docs.collect()], 40)
    assert load.max() / load.mean() < 1.05 and load.min() / load.mean() > 0.95
    assert S.assign_shards(docs).orderBy("doc_id").collect() == sorted(rows, key=lambda r: r.doc_id)
    homes = {}
    for r in rows:
        homes.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())  # no text is hot here


def test_hot_text_is_split_and_slices_stay_balanced(make_docs, monkeypatch):
    monkeypatch.setattr(S, "SLICE", 200)
    rng = random.Random(2)
    pairs = [(k, "hot text of some length, again and again") for k in range(2000)]
    pairs += [(5000 + k, "w " * rng.randint(1, 60) + str(k // 2)) for k in range(3000)]
    rows = S.assign_shards(make_docs(pairs), shards=8).collect()
    load = check(rows, pairs, 8)
    assert load.max() / load.mean() < 1.01
    count = np.bincount([r.shard for r in rows])
    assert count.max() / count.mean() < 1.02


def test_edges(make_docs):
    pairs = [(1, None), (2, ""), (None, "no id"), (3, "x" * 200_000), (4, "same"), (4, "same"), (4, "same"), (None, None)]
    check(S.assign_shards(make_docs(pairs), shards=3).collect(), pairs, 3)
    assert S.assign_shards(make_docs([])).count() == 0
    check(S.assign_shards(make_docs([(1, "a")])).collect(), [(1, "a")], 40)


def test_pack_prefers_the_highest_dot_product():
    residual = np.array([[10.0, 0.1], [0.1, 10.0]])
    assert S.pack(np.array([[1.0, 0.0], [0.0, 1.0]]), residual).tolist() == [0, 1]


def test_written_shards_hold_what_was_assigned(spark, make_docs):
    from tripsmith.llm.common import scratch_path
    docs = make_docs([(k, "some text " * (k % 9)) for k in range(200)])
    assigned = S.assign_shards(docs, shards=4)
    path = scratch_path(spark, "shards")
    S.write_shards(docs, assigned, path)
    back = {(r.doc_id, r["_shard"], r["_slot"]) for r in spark.read.parquet(path).collect()}
    assert back == {(r.doc_id, r.shard, r.slot) for r in assigned.collect()}


def test_rows_without_id_of_a_hot_text_are_spread(make_docs):
    """A third of the rows share a text and have no id: they fill every shard evenly, with gapless slots."""
    rows = S.assign_shards(make_docs([(None, "hot text here")] * 900 + [(k, f"other text {k}") for k in range(300)]), 6).collect()
    size = Counter(r.shard for r in rows)
    hot = Counter(r.shard for r in rows if r.doc_id is None)
    assert len(rows) == 1200 and len(size) == len(hot) == 6 and max(hot.values()) < 2 * min(hot.values())
    assert all(sorted(r.slot for r in rows if r.shard == s) == list(range(n)) for s, n in size.items())
