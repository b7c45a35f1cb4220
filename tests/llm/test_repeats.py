import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tripsmith.llm import repeats as R
from tripsmith.llm import suffix_array as S


def test_suffix_arrays_and_prefixes_by_sorting(monkeypatch):
    rng = random.Random(5)
    for trial in range(1500):
        t = np.array([rng.randint(0, rng.choice([1, 2, 4, 250])) for _ in range(rng.randint(1, 40))], np.uint8)
        if trial % 3 == 0:
            t = np.tile(t[:rng.randint(1, 6)], rng.randint(1, 9))
        monkeypatch.setattr(S, "VECTOR_ROWS", rng.choice([1, 100, 10**9]))
        sa, raw = S.suffix_array(t), t.tobytes()
        assert sa.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        prefix = S.common_prefixes(t, sa)
        for a, b in zip(sa[:-1], sa[1:]):
            n = next((k for k in range(len(raw)) if raw[a + k:a + k + 1] != raw[b + k:b + k + 1] or a + k >= len(raw) or b + k >= len(raw)))
            assert prefix[b] == n
        assert prefix[sa[0]] == 0


def test_blocks_of_buckets_by_sorting(monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(S, "VECTOR_ROWS", 10**9)
    for _ in range(600):
        for name, value in (("BLOCK_ROWS", rng.choice([1, 3, 20, 4096])), ("FEW", rng.choice([0, 2, 32])), ("DEEP", rng.choice([0, 1, 3, 1000]))):
            monkeypatch.setattr(S, name, value)
        t = [rng.randint(0, rng.choice([1, 3, 9, 70000])) for _ in range(rng.randint(2, 60))]
        t += [rng.choice(t)] * rng.randint(0, 12) + t[:rng.randint(0, 20)] * rng.randint(0, 4)
        assert S.suffix_array(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_strings_of_many_symbols_take_few_steps(monkeypatch):
    """Induction went suffix by suffix over names; now a step handles a block of buckets."""
    steps = []
    put = S._put
    monkeypatch.setattr(S, "_put", lambda *a: steps.append(1) or put(*a))
    rng = np.random.default_rng(4)
    t = np.tile(rng.integers(0, 30_000, 60_000), 2)
    sa = S.suffix_array(t)
    assert 0 < len(steps) < len(t) / 100
    assert np.array_equal(np.sort(sa), np.arange(len(t)))
    where = np.empty(len(t) + 1, np.int64)
    where[sa], where[-1] = np.arange(len(t)), -1
    first, second = t[sa], where[sa + 1]
    assert (((first[1:] > first[:-1]) | ((first[1:] == first[:-1]) & (second[1:] > second[:-1])))).all()


def brute(pairs, length):
    count = Counter()
    for _, t in pairs:
        b = (t or "").encode()
        count.update(b[k:k + length] for k in range(len(b) - length + 1))
    out = []
    for i, t in pairs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - length + 1):
            if count[b[k:k + length]] > 1:
                gone[k:k + length] = True
        gone = gone[:len(b)]
        n = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(b), int(gone.sum()), n, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    say = lambda n: " ".join(word() for _ in range(n))
    passage, short = say(120), say(12)
    texts = [say(rng.randint(1, 400)) for _ in range(30)]
    texts += [say(20) + passage + say(30) for _ in range(12)] + [say(5) + short + say(9) for _ in range(40)]
    texts += [texts[3]] * 5 + [texts[4][:len(texts[4]) // 2], texts[5] + texts[5], "a" * 1500, "ab" * 900 + "c", "a" * 399, "\0" * 500, "x\0y" * 300]
    texts += [None, "", "short"]
    out = list(enumerate(texts))
    return out + [(3, texts[3]), (None, passage), (None, texts[0])]


def got(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in frame.collect()), key=str)


@pytest.mark.parametrize("hot,shard,piece", [(1000, 2 << 20, 4 << 20), (2, 2 << 20, 4 << 20), (1000, 3000, 4 << 20), (1000, 2 << 20, 700)])
def test_against_brute_force(make_docs, pairs, monkeypatch, hot, shard, piece):
    for name, value in (("HOT", hot), ("SHARD_BYTES", shard), ("PIECE", piece)):
        monkeypatch.setattr(R, name, value)
    assert got(R.remove_repeats(make_docs(pairs), length=120)) == brute(pairs, 120)


def test_contract_length_empty_table_and_remaining_bytes(make_docs, pairs):
    out = R.remove_repeats(make_docs(pairs), keep_text=True)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 and len(r.kept) == r.n_bytes - r.n_removed for r in out.collect())
    assert got(out) == brute(pairs, 400)
    assert R.remove_repeats(make_docs([])).count() == 0


def test_without_broadcasts(make_docs, pairs, monkeypatch):
    from tripsmith.llm import common
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(R, "BROADCAST_ROWS", 0)
    assert got(R.remove_repeats(make_docs(pairs), length=120)) == brute(pairs, 120)
