import random

from pyspark.sql import types as T

from tripsmith.llm import decontaminate as D

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.StringType())])


def edit_distance_to_substring(item, text):
    row, best = list(range(len(item) + 1)), len(item)
    for c in text:
        new = [0]
        for i in range(1, len(item) + 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (item[i - 1] != c)))
        row, best = new, min(best, new[-1])
    return best


def test_myers_against_the_table():
    rng = random.Random(2)
    for _ in range(1500):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 30)))
        assert D.myers(item, text)[0] == edit_distance_to_substring(item, text)


def test_matches_against_brute_force(spark, make_docs):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, say(30)) for k in range(6)] + [(6, None), (7, ""), (0, None), (8, "tiny")]
    items.append((9, items[1][1].upper().replace(" ", "\n ")))  # equal to item 1 but for case and spaces

    def edited(text, n):
        chars = list(text)
        for _ in range(n):
            at = rng.randrange(len(chars))
            chars[at:at + 1] = rng.choice([["#"], [], [chars[at], "#"]])
        return "".join(chars)

    docs = [(10, None), (11, ""), (12, say(200)), (13, "a tiny one")]
    for k in range(6):
        n = len(items[k][1])
        for j, e in enumerate((0, int(0.03 * n), int(0.07 * n), int(0.2 * n))):
            docs.append((100 + 10 * k + j, say(40) + " " + edited(items[k][1], e) + " " + say(20)))
    docs += [(100, docs[4][1]), (400, say(30_000) + " " + items[2][1])]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    got = sorted({(r.doc_id, r.item_id, r.distance) for r in D.matches(make_docs(docs), frame).collect()})
    want = set()
    for i, text in docs:
        for k, item in items:
            a = D.normal(item)
            if a and text and len(text) < 20_000:
                d = edit_distance_to_substring(a, D.normal(text))
                if d <= int(D.ERROR_RATE * len(a)):
                    want.add((i, k, d))
    want.add((400, 2, 0))
    assert got == sorted(want)
    assert D.matches(make_docs([]), frame).count() == 0
    assert D.matches(make_docs(docs), frame.where("false")).count() == 0


def test_blocks_of_items_give_the_same(spark, make_docs, monkeypatch):
    items = spark.createDataFrame([(k, f"item number {k} says hello to world {k * 7919}", "x") for k in range(9)], ITEMS)
    docs = make_docs([(k, f"before. Item number {k} says hello to world {k * 7919} after") for k in range(12)])
    one = sorted(D.matches(docs, items).collect())
    monkeypatch.setattr(D, "BLOCK_ITEMS", 2)
    assert sorted(D.matches(docs, items).collect()) == one and {(k, k) for k in range(9)} <= {(r.doc_id, r.item_id) for r in one}


def test_items_without_id_and_blocks_by_bytes(spark, make_docs, monkeypatch):
    """A passage without id is found as well, whether the items fit one block or need many."""
    items = spark.createDataFrame([(None, "nameless passage of the benchmark", "x"), (None, "another one that has no number", "x"),
                                   (1, "numbered passage of the benchmark", "x")], ITEMS)
    docs = make_docs([(1, "a nameless passage of the benchmark."), (2, "Another one that has no number, and the nameless passage of the benchmark"),
                      (3, "numbered passage of the benchmark"), (4, "clean")])
    found = lambda: sorted(((r.doc_id, r.item_id, r.distance) for r in D.matches(docs, items).collect()), key=str)
    want = [(1, None, 0), (2, None, 0), (3, 1, 0)]
    got = found()
    assert [g for g in got if g[2] == 0] == want
    monkeypatch.setattr(D, "BLOCK_BYTES", 40)
    assert len(list(D.item_blocks(items))) >= 3 and found() == got
