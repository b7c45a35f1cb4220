import random

import numpy as np
import pytest

from tripsmith.llm import minhash as M
from tripsmith.llm.common import LOWER_AZ


def brute(pairs, percent=85):
    """Components over all pairs of full shingle sets."""
    sets = []
    for i, text in pairs:
        w = (text or "").encode().translate(LOWER_AZ).split()
        sets.append((i, {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    to = {i: i for i, _ in pairs}

    def root(x):
        while to[x] != x:
            x = to[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                to[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets)


def family(rng, vocabulary, size, n, rate):
    base = rng.choices(vocabulary, k=n)
    return [" ".join(w if rng.random() > rate else rng.choice(vocabulary) for w in base) for _ in range(size)]


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 300))) for _ in range(60)]
    texts += family(rng, vocabulary, 60, 120, 0.015) + family(rng, vocabulary, 30, 40, 0.02) + family(rng, vocabulary, 10, 9, 0.02)
    texts += ["same Text of some words"] * 15 + ["Same text\nof SOME words"] + ["one"] * 3 + ["one two", "", " \n", None]
    texts += [" ".join(f"v{k}" for k in range(30_000)), " ".join(f"v{k}" for k in range(1, 30_001))]
    return list(enumerate(texts))


def result(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in frame.collect())


@pytest.mark.parametrize("percent", [85, 80])
def test_against_brute_force(make_docs, pairs, percent):
    assert result(M.near_duplicates(make_docs(pairs), percent)) == brute(pairs, percent)


def test_large_families_are_compared_across_blocks(make_docs, pairs, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 8)
    monkeypatch.setattr(M, "BUCKET", 20)
    assert result(M.near_duplicates(make_docs(pairs))) == brute(pairs)


def test_missing_and_repeated_ids(make_docs):
    text = "a b c d e f g h"
    rows = M.near_duplicates(make_docs([(None, text), (5, text), (5, text), (3, "other words here"), (None, "lonely null"), (None, None)])).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=str)
    assert got == sorted([(None, 4, 5, False), (5, 4, 5, True), (5, 4, 5, True), (3, 1, 3, True), (None, 1, None, True), (None, 0, None, True)], key=str)
    assert M.near_duplicates(make_docs([])).count() == 0


def test_estimates_correct_chance_agreement():
    rng = np.random.default_rng(1)
    for shared, own in ((0, 3000), (2000, 1000), (2700, 300), (60, 10)):
        common = rng.integers(0, 1 << 63, shared, np.uint64) * np.uint64(2)
        errors = []
        for _ in range(20):
            a, b = (np.unique(np.concatenate((common, rng.integers(0, 1 << 63, own, np.uint64) * np.uint64(2) + np.uint64(1)))) for _ in range(2))
            guess = M.estimate(M.registers(a, M.REGISTERS), M.registers(b, M.REGISTERS)[None, :], len(a), np.array([len(b)]))[0]
            errors.append(guess - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < M.SLACK


def test_components_of_chains_and_stars(spark):
    from tripsmith.llm.components import components
    links = [(k, k + 1) for k in range(1, 60)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7), (200, 201), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[k] == 1 for k in range(1, 61)) and all(got[100 + k] == 100 for k in range(50)) and got[201] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_broadcasts(make_docs, pairs, monkeypatch):
    from tripsmith.llm import common
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert result(M.near_duplicates(make_docs(pairs))) == brute(pairs)


def compared(monkeypatch):
    """Rows of sets that tasks get to compare, call by call."""
    calls, links = [], M._links
    monkeypatch.setattr(M, "_links", lambda blocks, percent: (calls.append(blocks.count()), links(blocks, percent))[1])
    return calls


def test_texts_with_a_common_line_are_no_family(make_docs, monkeypatch):
    """Buckets that a frequent line fills stayed whole, so that all texts with it were compared, blocks squared."""
    monkeypatch.setattr(M, "BLOCK", 8)
    monkeypatch.setattr(M, "BUCKET", 20)
    rng = random.Random(3)
    line = "one line that very many short texts of this table begin with"
    texts = [f"{line} " + " ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randint(30, 40))) for _ in range(300)]
    texts += [t + " end" for t in texts[:20]] + [line, line + " x", None]
    rows = list(enumerate(texts))
    calls = compared(monkeypatch)
    assert result(M.near_duplicates(make_docs(rows))) == brute(rows)
    assert sum(calls) < 150


def test_joined_blocks_are_not_compared_for_a_few_others(make_docs, monkeypatch):
    """A family of near copies of which every block holds some texts of no component."""
    monkeypatch.setattr(M, "BLOCK", 16)
    monkeypatch.setattr(M, "BUCKET", 10)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(300)]

    def changed(n):
        words = list(base)
        for at in rng.sample(range(300), n):
            words[at] = f"x{rng.randrange(99999)}"
        return " ".join(words)

    rows = list(enumerate([changed(1) for _ in range(400)] + [changed(13) for _ in range(24)]))
    calls = compared(monkeypatch)
    got = result(M.near_duplicates(make_docs(rows)))
    assert got == brute(rows)
    assert sum(k for _, _, _, k in got) > 10
    assert sum(calls[1:]) < 424 * 10
