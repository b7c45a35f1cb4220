import random
import zlib

from pyspark.sql import types as T

from tests.conftest import SF01
from tripsmith.llm.common import table
from tripsmith.llm.toxicity import LetterModels, Scorer, fit, grams, scores

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType()),
                       T.StructField("text", T.StringType())])


def test_held_out_accuracy_on_the_given_table(spark):
    labels = {r.doc_id: r.toxic for r in table(spark, SF01, "labels").collect()}
    rows = [r for r in scores(table(spark, SF01, "documents"), table(spark, SF01, "labels")).collect()]
    assert len(rows) == table(spark, SF01, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    test = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(test) > 50 and sum(p == y for p, y in test) / len(test) > 0.9


def test_edge_rows(spark, make_docs):
    rng = random.Random(4)
    calm, rude = ["river", "stone", "light", "garden", "window"], ["zonkhead", "blatfool", "grotwit"]
    pairs = [(k, " ".join(rng.choices(calm, k=30) + (rng.choices(rude, k=3) if k % 3 == 0 else []))) for k in range(400)]
    pairs += [(500, None), (501, ""), (502, "12 34 !!"), (503, "river " * 40_000 + "zonkheads"), (None, "stone zonkhead"), (7, "river")]
    marks = [(k, 1, int(k % 3 == 0), "t") for k in range(400)] + [(None, 1, 1, "t"), (9, None, None, "t"), (12, 0, 0, "t"), (999, 1, 1, "t")]
    labels = spark.createDataFrame(marks, LABELS)
    rows = scores(make_docs(pairs), labels).collect()
    assert len(rows) == len(pairs)
    by = {r.doc_id: r for r in rows}
    assert by[500].score == by[501].score == by[502].score
    right = sum(r.predicted == (r.doc_id % 3 == 0) for r in rows if r.doc_id is not None and r.doc_id < 400 and r.doc_id != 7)
    assert right > 380
    assert not by[None].held_out and by[None].score >= 0.3
    assert {r.score for r in scores(make_docs(pairs), labels.where("toxic = 0")).collect()} == {0.0}
    assert scores(make_docs([]), labels).count() == 0
    assert isinstance(fit(make_docs([]), labels), Scorer)


def test_kneser_ney_by_hand():
    counts = {}
    for k, words in ((0, ["ab"] * 3 + ["cb"]), (1, ["ad"] * 2)):
        for word in words:
            for gram in grams(word):
                counts.setdefault(gram, [0, 0])[k] += 1
    model = LetterModels({g: tuple(c) for g, c in counts.items()})
    unigram = (2 + 0.5) / (7 + 0.5 * 6)  # b follows a and c; seven pairs, five letters and one unseen
    bigram = (1 - 0.75) / 2 + 0.75 * 2 / 2 * unigram  # ab and ad each have one left context
    assert abs(model.probability(0, "^ab") - ((3 - 0.75) / 3 + 0.75 * 1 / 3 * bigram)) < 1e-12
    assert abs(model.probability(1, "^ab") - 0.75 * 1 / 2 * bigram) < 1e-12
    assert model.probability(0, "^xb") == model.probability(1, "^xb") == unigram
    for k in (0, 1):
        assert abs(sum(model.probability(k, "^a" + w) for w in "abcd$?") - 1) < 1e-12


def test_sequences_seen_once_are_kept(make_docs, spark):
    pairs = [(k, "river stone" if k % 2 else "zonk head") for k in range(40)] + [(1000, "quixpy")]
    marks = [(k, 1, int(k % 2 == 0), "t") for k in range(40)] + [(i, 1, 1, "t") for i in range(1000, 1040)]
    pairs += [(i, f"quix{chr(97 + i % 26)}{i}") for i in range(1001, 1040)]
    model = fit(make_docs(pairs), spark.createDataFrame(marks, LABELS)).models
    assert any(sum(c) == 1 for g, c in model.counts.items() if len(g) > 1)
