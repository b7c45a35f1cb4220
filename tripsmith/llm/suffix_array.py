"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified smaller-type (S) or larger-type (L) than their successor.  The
leftmost S of each run (LMS) begin substrings that are sorted by one induction, named,
and, while names repeat, sorted as suffixes of the shorter string of names by the same
method.  A second induction from the sorted LMS suffixes then gives the array.

An induction goes bucket by bucket over few symbols: all suffixes of a bucket that are known
at a time are handled in one vector step, so a bucket takes one step and one more for each
repeat of its symbol in a row.  Strings of names have many symbols with few suffixes each;
there neighbouring buckets form a block, whose suffixes are handled together: those that its
own suffixes induce in it are found in rounds, mostly one or two, and put in order.
"""

from __future__ import annotations

from operator import itemgetter

import numpy as np

#: Suffixes a symbol must have on average for vector steps of one bucket to pay.
VECTOR_ROWS = 100
#: Suffixes of a block of buckets, those of a round that go one by one, and rounds from which a block goes bucket by bucket.
BLOCK_ROWS = 4096
FEW = 32
DEEP = 1000


def _smaller(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the empty suffix is the smallest."""
    n = len(t)
    step = np.empty(n, np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int64) - t[:-1])
    step[-1] = -1
    # the next position whose step is not 0 decides
    at = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


class _Buckets:
    """Where suffixes of each first symbol stand."""

    def __init__(self, t: np.ndarray):
        self.size = np.bincount(t)
        self.start = np.concatenate(([0], np.cumsum(self.size)[:-1]))
        self.used = np.flatnonzero(self.size)


def _put(sa, at, t, found, sign):
    """Append suffixes to their buckets in order, forwards (1) or backwards (-1)."""
    symbol = t[found]
    order = np.argsort(symbol, kind="stable")
    found, symbol = found[order], symbol[order]
    head = np.flatnonzero(np.concatenate(([True], symbol[1:] != symbol[:-1])))
    count = np.diff(np.concatenate((head, [len(symbol)])))
    rank = np.arange(len(symbol)) - np.repeat(head, count)
    sa[at[symbol] + sign * rank] = found
    at[symbol[head]] += sign * count


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, b: _Buckets) -> np.ndarray:
    """The array of all suffixes from LMS suffixes in order."""
    n = len(t)
    sa = np.full(n, -1, np.int32 if n < 1 << 31 else np.int64)
    held = np.bincount(t[lms], minlength=len(b.size))
    lms = lms[np.argsort(t[lms], kind="stable")]
    first = np.concatenate(([0], np.cumsum(held)))
    seat = np.arange(len(lms)) + (b.start + b.size - first[1:])[t[lms]]  # the last places of their buckets
    at = b.start.copy()
    sa[at[t[n - 1]]] = n - 1  # the empty suffix, smallest of all, induces the last symbol
    at[t[n - 1]] += 1
    blocks = _blocks(n, b)

    def larger_of_bucket(c: int) -> None:
        lo = b.start[c]
        while lo < at[c]:
            hi = at[c]
            before = sa[lo:hi] - 1
            before = before[before >= 0]
            before = before[~smaller[before]]
            if len(before):
                _put(sa, at, t, before, 1)
            lo = hi
        if held[c]:
            before = lms[first[c]:first[c + 1]] - 1
            before = before[before >= 0]
            if len(before):
                _put(sa, at, t, before, 1)

    def smaller_of_bucket(c: int) -> None:
        hi = b.start[c] + b.size[c] - 1
        while hi > at[c]:
            lo = at[c]
            before = sa[lo + 1:hi + 1][::-1] - 1
            before = before[before >= 0]
            before = before[smaller[before]]
            if len(before):
                _put(sa, at, t, before, -1)
            hi = lo
        before = sa[b.start[c]:larger_end[c]][::-1] - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        if len(before):
            _put(sa, at, t, before, -1)

    larger = ~smaller
    for used in blocks:
        c, d = used[0], used[-1] + 1
        if len(used) == 1:
            larger_of_bucket(c)
            continue
        lo = b.start[c]
        place = np.flatnonzero(sa[lo:b.start[d - 1] + b.size[d - 1]] >= 0) + lo
        seeds = slice(first[c], first[d])
        if not _put_block(sa, at, t, larger, np.concatenate((sa[place], lms[seeds])), np.concatenate((place, seat[seeds])), c, d, 1):
            for c in used:
                larger_of_bucket(c)
    larger_end = at
    at = b.start + b.size - 1
    for used in reversed(blocks):
        c, d = used[0], used[-1] + 1
        if len(used) == 1:
            smaller_of_bucket(c)
            continue
        lo = b.start[c]
        place = np.flatnonzero(sa[lo:b.start[d - 1] + b.size[d - 1]] >= 0) + lo
        if not _put_block(sa, at, t, smaller, sa[place], place, c, d, -1):
            for c in used[::-1]:
                smaller_of_bucket(c)
    return sa


def _blocks(n: int, b: _Buckets) -> list[np.ndarray]:
    """Used symbols, each alone if they have many suffixes, else neighbours of about ``BLOCK_ROWS`` together."""
    if n >= VECTOR_ROWS * len(b.used):
        return list(b.used.reshape(-1, 1))
    block = b.start[b.used] // BLOCK_ROWS
    return np.split(b.used, np.flatnonzero(np.diff(block)) + 1)


def _put_block(sa, at, t, kind, known, place, c, d, sign) -> bool:
    """Induce from the suffixes of the symbols c..d-1; False (and nothing done) if they nest deeper than ``DEEP``.

    known: those in the array or seeds, at ``place``.  They induce others of the same symbols, and these
    others, found round by round.  Each goes behind those known in its bucket, in order of its
    successor; sorting again settles one more round each time.
    """
    order = np.argsort(sign * place)
    known, place = known[order], place[order]
    found, after, symbols, total, rounds = [known], [], [], len(known), 0
    latest, index = known, np.arange(len(known))
    while len(latest) > FEW:  # a round has no more suffixes than the one before
        before = latest - 1
        good = np.flatnonzero(before >= 0)
        good = good[kind[before[good]]]
        symbol = t[before[good]].astype(np.int64)
        inside = np.flatnonzero((symbol < d) if sign > 0 else (symbol >= c))
        rounds += 1
        if rounds > DEEP:
            return False
        symbol, good = symbol[inside], good[inside]
        order = np.argsort(sign * symbol, kind="stable")  # right within a round
        good = good[order]
        latest, behind, index = before[good], index[good], total + np.arange(len(good))
        total += len(good)
        found.append(latest)
        after.append(behind)
        symbols.append(symbol[order])
    few = list(zip(latest.tolist(), index.tolist()))
    rest = []  # symbol, suffix, number of its successor
    while few:
        rounds += 1
        if rounds > DEEP:
            return False
        made = []
        for i, k in few:
            if i > 0 and kind[i - 1]:
                symbol = int(t[i - 1])
                if c <= symbol < d:
                    made.append((sign * symbol, i - 1, k))
        made.sort(key=itemgetter(0))
        few = [(i, total + k) for k, (_, i, _) in enumerate(made)]
        total += len(made)
        rest += made
    if rest:
        signed, latest, behind = np.array(rest, np.int64).T
        found.append(latest)
        after.append(behind)
        symbols.append(sign * signed)
    if total > len(known):
        new, after, symbol = (np.concatenate(x) for x in (found[1:], after, symbols))
        order = np.argsort(symbol, kind="stable")
        by_bucket = symbol[order]
        head = np.flatnonzero(np.concatenate(([True], by_bucket[1:] != by_bucket[:-1])))
        count = np.diff(np.concatenate((head, [len(new)])))
        seats = at[by_bucket] + sign * (np.arange(len(new)) - np.repeat(head, count))
        full = np.concatenate((place, np.empty(len(new), np.int64)))
        own = full[len(place):]
        own[order] = seats
        apart = symbol * (2 * len(t) + 2)
        for _ in range(rounds):  # until rounds are merged
            was = own.copy()
            own[np.argsort(apart + sign * full[after], kind="stable")] = seats
            if np.array_equal(own, was):
                break
        sa[own] = new
        at[by_bucket[head]] += sign * count
        known = np.concatenate((known, new))[np.argsort(sign * full)]
    known = known - 1
    known = known[known >= 0]
    known = known[kind[known]]
    known = known[t[known] >= d] if sign > 0 else known[t[known] < c]
    if len(known):
        _put(sa, at, t, known, sign)
    return True


def _names(t: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks (from 1, in order of position) of LMS substrings, which stand sorted in ``order``."""
    n = len(t)
    length = np.empty(len(lms), np.int64)
    length[:-1] = np.diff(lms) + 1
    length[-1] = n - lms[-1] + 1  # its last symbol is the end, which nothing equals
    place = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    place[lms] = np.arange(len(lms))
    index = place[order]
    size = length[index]
    same = size[1:] == size[:-1]
    same &= (order[1:] != lms[-1]) & (order[:-1] != lms[-1])
    alive, k = np.flatnonzero(same), 0
    while len(alive):
        differ = t[order[alive + 1] + k] != t[order[alive] + k]
        same[alive[differ]] = False
        k += 1
        alive = alive[~differ]
        alive = alive[size[alive] > k]
    name = np.empty(len(lms), np.int64)
    name[index] = np.concatenate(([1], 1 + np.cumsum(~same)))
    return name


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of the suffixes of non-negative integers; a suffix's prefix counts as smaller."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    t = t.astype(np.uint8 if t.max() < 1 << 8 else np.uint16) if t.max() < 1 << 16 else t  # these are sorted by digits
    smaller = _smaller(t)
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    b = _Buckets(t)
    if len(lms) > 1:
        once = _induce(t, smaller, lms, b)
        mark = np.zeros(n, bool)
        mark[lms] = True
        order = once[mark[once]]
        name = _names(t, lms, order)
        most = int(name.max())
        if most == len(lms):
            lms = order
        else:
            lms = lms[suffix_array(name)]
    return _induce(t, smaller, lms, b)


def common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """PLCP: the common prefix of each suffix with the one before it in the array, by position.

    Where a suffix and its neighbour follow equal symbols, the value is one less than at the
    position before; only the others are compared, eight bytes at a time.  ``t`` is uint8.
    """
    n = len(t)
    neighbour = np.full(n, -1, np.int64)
    neighbour[sa[1:]] = sa[:-1]
    padded = np.concatenate((t, np.zeros(16, np.uint8))).astype(np.uint64)
    word = np.zeros(n + 8, np.uint64)
    for k in range(8):
        word |= padded[k:n + 8 + k] << np.uint64(8 * k)
    position = np.arange(n)
    begin = (neighbour <= 0) | (position == 0)
    begin[1:] |= t[np.maximum(neighbour[1:], 1) - 1] != t[:-1]
    start = np.flatnonzero(begin)
    out = np.zeros(n, np.int64)
    alive = start[neighbour[start] >= 0]
    k = 0
    while len(alive):
        other = neighbour[alive]
        room = n - np.maximum(alive, other) - k
        delta = word[np.minimum(alive + k, n)] ^ word[np.minimum(other + k, n)]
        here = np.full(len(alive), 8)
        differ = np.flatnonzero(delta)
        lowest = delta[differ] & (~delta[differ] + np.uint64(1))  # a power of two, exact as a float
        here[differ] = (np.log2(lowest.astype(np.float64)).astype(np.int64)) >> 3
        here = np.minimum(here, np.maximum(room, 0))
        out[alive] += here
        k += 8
        alive = alive[here == 8]
    last = np.maximum.accumulate(np.where(begin, position, 0))
    return np.maximum(out[last] - (position - last), 0)
