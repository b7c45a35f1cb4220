import random
import re
import zlib
from collections import Counter

from tests.conftest import SF001
from tripsmith.llm.common import LOWER_AZ, table
from tripsmith.llm import spelling
from tripsmith.llm.spelling import deal_cells, entries, near_words, runs, signed, spelling_groups


def counts(pairs):
    n = Counter()
    for i, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.encode().translate(LOWER_AZ).decode()
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if c >= 3 and len(w) >= 5}


def near(words):
    """Words at edit distance one of each word: those that share all letters around a gap, or are what the gap leaves."""
    gaps = {}
    for w in words:
        for i in range(len(w)):
            gaps.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    out = {w: set() for w in words}
    for (_, rest), held in gaps.items():
        held = held | ({rest} & set(words))
        for a in held:
            out[a] |= held - {a}
    return out


def brute(pairs):
    n = counts(pairs)
    links = near(n)
    form = {}
    for w in n:
        best = min(links[w], key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(links[w]), n.get(form[w]))
    return out


def result(frame):
    rows = frame.collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(got) == len(rows)
    return got


def test_given_table(spark):
    docs = table(spark, SF001, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = result(spelling_groups(docs))
    assert got == want and any(f for f, *_ in got.values()) and len({r for _, r, *_ in got.values()}) < len(got)


def test_edges(make_docs):
    rng = random.Random(5)
    base = ["colour", "color", "colours", "grüßen", "GrÜßen", "abcde", "abced", "edcba", "aaaaa", "aaaaaa", "aaaaaaa", "x" * 70, "x" * 71]
    pool = base + ["".join(rng.choice("abeé×") for _ in range(rng.randint(4, 7))) for _ in range(150)]
    pairs = [(k, rng.choice([" ", "7", "’", "Ā", "_"]).join(rng.choice(pool) for _ in range(60))) for k in range(120)]
    pairs += [(None, "colour nameless nameless nameless"), (500, None), (501, ""), (502, "1 2 3"), (503, "longest" * 3000), (504, "longest" * 3000),
              (505, "longest" * 3000)] + [(7, "twice twice")] * 3
    got = result(spelling_groups(make_docs(pairs)))
    assert got == brute(pairs)
    assert "nameless" in got and "longest" * 3000 in got
    assert spelling_groups(make_docs([])).count() == 0
    assert spelling_groups(make_docs([(1, None)])).count() == 0


def test_forms_double_and_roots_end(make_docs):
    """A chain of four words, each twice as frequent as the one before, has one root."""
    chain = ["abcdef", "abcdeg", "abcdhg", "abckhg"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(40 * 3 ** k))
    got = result(spelling_groups(make_docs([(1, text)])))
    assert [got[w][0] for w in chain if w in got] == [*chain[1:], None]
    assert {got[w][1] for w in chain} == {"abckhg"}


def test_near_vectors_share_a_signature():
    rng = random.Random(2)
    for _ in range(2000):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 12)))
        i, c = rng.randrange(len(w)), rng.choice("abcdefé")
        v = rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])
        a, b = "".join(sorted(w)), "".join(sorted(v))
        cell = deal_cells({("a", 1): 5, ("b", 1): 3, ("c", 1): 9}, 10)
        (s, x), (t, y) = signed(a, cell), signed(b, cell)
        assert set(s) & set(t) and (x ^ y).bit_count() <= 2
        assert len(set(entries(a)) ^ set(entries(b))) <= 2


def test_near_words_of_one_letter_set(spark):
    words = spark.createDataFrame([("abcde", 3), ("abced", 9), ("abcdf", 4), ("abcd", 5), ("zabcde", 1)], "word string, n long")
    got = {(r.word, r.other) for r in near_words(words).collect()}
    one = {("abcde", "abcdf"), ("abcde", "abcd"), ("abcdf", "abcd"), ("abcde", "zabcde"), ("abced", "abcd")}
    assert got == one | {(b, a) for a, b in one}


def test_runs_stop_at_rows():
    import numpy as np
    text = ["ab", "Cdé x", "", "×y"]
    raw = "".join(text).encode()
    offs = np.cumsum([0, *(len(t.encode()) for t in text)])
    letters, ends, rows = runs(np.frombuffer(raw, np.uint8), offs)
    cut = np.concatenate([[0], ends])
    words = [letters[a:b].tobytes().decode() for a, b in zip(cut, cut[1:])]
    assert words == ["ab", "cdé", "x", "×y"] and rows.tolist() == [0, 1, 1, 3]


def test_no_table_is_broadcast_because_spark_takes_it_to_be_small(make_docs, monkeypatch):
    """Signatures, 21 a vector, were sized as the words' file and sent through the driver."""
    plans, write = [], spelling.materialise
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(spelling, "materialise", lambda df, name: (plans.append(plan(df)), write(df, name))[1])
    pairs = [(k, "colour colour colour color color color") for k in range(9)]
    out = spelling_groups(make_docs(pairs))
    assert result(out) == brute(pairs)
    plans.append(plan(out))
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
