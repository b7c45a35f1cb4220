import inspect
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as CP
from tests.llm.test_decontaminate import edit_distance_to_substring
from tests.llm.test_minhash import brute
from tripsmith.llm import decontaminate, secret_scan
from tripsmith.llm.common import scratch_path, table

_WORDS = random.Random(12)
CALM = ["".join(_WORDS.choices("abcdefghijklmnopqrstuvwxyz", k=_WORDS.randint(2, 9))) for _ in range(600)]
RUDE = ["zonkhead", "blatfool", "grotwit"]


@pytest.fixture(scope="module")
def corpus(spark):
    """A folder with documents, labels and benchmark that hold every case a stage decides on."""
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(CALM) + str(rng.randrange(50)) for _ in range(n))
    docs = [(k, say(60)) for k in range(300)]
    docs += [(1000 + k, say(50) + " " + " ".join(rng.choices(RUDE, k=4))) for k in range(100)]
    docs += [(2000 + k, docs[5][1]) for k in range(4)]  # exact copies
    docs += [(2010 + k, docs[6][1].rsplit(" ", k + 1)[0] + " end" * (k + 1)) for k in range(4)]  # near copies
    items = [(k, say(12)) for k in range(5)]
    docs += [(3000 + k, say(20) + " " + items[k][1].upper() + " " + say(20)) for k in range(5)]
    docs += [(3010, say(20) + " " + items[0][1][:30] + "#" + items[0][1][31:] + " " + say(9)), (3011, say(9) + " " + items[1][1][:20] + " " + say(9))]
    docs += [(4000, say(30) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + say(5)), (4001, "my_secret = 'abCD12efgh34'\n" + say(30))]
    docs += [(5000, None), (5001, ""), (None, say(40)), (6000, "twice"), (6000, "twice")]
    path = scratch_path(spark, "corpus")
    labels = [(i, 1, int(1000 <= i < 1100)) for i, _ in docs if i is not None and i < 1100]
    spark.createDataFrame([(i, t, "en", "s", None, "x") for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long, _gone string") \
        .repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, items


def test_stages_one_by_one(spark, corpus):
    path, docs, items = corpus
    frames = [table(spark, path, "documents")]
    for _, stage in CP.STAGES:
        frames.append(stage(spark, frames[-1], path))
        out = scratch_path(spark, "stage")
        frames[-1].write.parquet(out)
        frames[-1] = spark.read.parquet(out)
    rows = [[(r.doc_id, r.text) for r in f.collect()] for f in frames[:5]]
    assert all(f.columns == frames[0].columns for f in frames[:5])
    key = lambda r: (str(r[0]), str(r[1]))

    assert sorted(rows[1], key=key) == sorted((r for r in docs if r[0] is None or not 1000 <= r[0] < 1100), key=key)

    groups = {i: c for i, _, c, _ in brute(sorted({r for r in rows[1] if r[0] is not None}), 80)}
    want = [r for r in rows[1] if r[0] is None] + sorted({r for r in rows[1] if r[0] is not None and groups[r[0]] == r[0]}, key=key)
    assert sorted(rows[2], key=key) == sorted(want, key=key) and len(rows[2]) < len(rows[1]) - 7

    leaked = {(i, t) for i, t in rows[2] for _, item in items
              if edit_distance_to_substring(a := decontaminate.normal(item), decontaminate.normal(t)) <= int(decontaminate.ERROR_RATE * len(a)) and t}
    assert {i for i, _ in leaked} == {3000, 3001, 3002, 3003, 3004, 3010}
    assert sorted(rows[3], key=key) == sorted((r for r in rows[2] if r not in leaked), key=key)

    assert sorted(rows[4], key=key) == sorted(((i, secret_scan.redact(t)) for i, t in rows[3]), key=key)
    assert any("[SECRET]" in (t or "") for _, t in rows[4]) and "24be64439e3e49cf" not in str(rows[4])

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coded = sorted((str(r.doc_id), bytes(r.ids), r.n_tokens, r.decoded) for r in frames[5].collect())
    encode = lambda text: t.encode(text or "", add_special_tokens=False).ids
    assert coded == sorted((str(i), np.array(encode(x), "<u4").tobytes(), len(encode(x)), x or "") for i, x in rows[4])


def test_run_applies_the_stages(spark, corpus):
    path, _, _ = corpus
    assert [n for n, _ in CP.STAGES] == ["toxicity", "near_dedup", "decontaminate", "secrets", "tokens"]
    assert all(len(inspect.signature(f).parameters) == 3 for _, f in CP.STAGES) and CP.ORACLE_SQL is None
    out = CP.run(spark, path)
    assert out.columns == ["doc_id", "ids", "n_tokens", "decoded"] and out.where("n_tokens > 0").count() > 250


def test_empty_corpus(spark, corpus):
    path, _, _ = corpus
    docs = table(spark, path, "documents").where("false")
    for name, stage in CP.STAGES:
        out = stage(spark, docs, path)
        assert out.count() == 0
        docs = out if name != "tokens" else docs


def test_queries_are_registered():
    import __spark_entry__ as E
    from tripsmith.llm.queries import QUERIES
    assert {*QUERIES, "pipeline"} <= set(E.queries())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
