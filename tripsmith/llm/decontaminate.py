"""Operator 8: benchmark decontamination by pigeonhole edit matching.

A test item may occur in a text with up to ``floor(rate * length)`` edits.  Cut into
budget-plus-one pieces, at least one piece must then occur unchanged.  One automaton
finds all pieces in a text; around each hit Myers' bit-parallel recurrence computes
the least edit distance of the item to any substring.

Texts and items are compared in lower case with runs of white space as one space.
Items are read in blocks of about ``BLOCK_ITEMS`` and ``BLOCK_BYTES``; each block passes over all
texts, and is collected, used and destroyed before the next one.

Results: a row per (text row, item) within budget, so clean rows do not appear.  Null
and empty texts or items match nothing; item rows repeated with the same id count
once, equal items with different ids are all reported.  Items without id are searched like others
and reported as one, with a null item_id.  Texts of any length are searched whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import ahocorasick
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsmith.llm.common import materialise

ERROR_RATE = 0.08
BLOCK_ITEMS, BLOCK_BYTES = 10_000, 16 << 20


def normal(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces of nearly equal length that cover the item."""
    cuts = [len(item) * k // (budget + 1) for k in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str) -> tuple[int, int]:
    """(distance, end): least edit distance of the item to a substring, and the first end of such."""
    m = len(item)
    ones, high = (1 << m) - 1, 1 << (m - 1)
    where: dict[str, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    pv, mv, now, best, end = ones, 0, m, m, 0
    for j, c in enumerate(text):
        eq = where.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (ones & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            now += 1
        elif mh & high:
            now -= 1
        ph = (ph << 1) & ones  # the empty prefix matches anywhere, so no carry comes in
        mh = (mh << 1) & ones
        pv = mh | (ones & ~(xv | ph))
        mv = ph & xv
        if now < best:
            best, end = now, j + 1
    return best, end


class Matcher:
    """Automaton and items of one block."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, n, int(rate * len(n))) for i, n in sorted({(i, normal(t)) for i, t in items}, key=lambda r: (r[0] is not None, r[0] or 0, r[1])) if n]
        where: dict[str, list[tuple[int, int]]] = {}
        for k, (_, item, budget) in enumerate(self.items):
            for at, piece in pieces(item, budget):
                where.setdefault(piece, []).append((k, at))
        self.automaton = None
        if where:
            self.automaton = ahocorasick.Automaton()
            for piece, users in where.items():
                self.automaton.add_word(piece, (len(piece), users))
            self.automaton.make_automaton()

    def __call__(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item id, distance, end in the normalised text), by item id."""
        if not text or self.automaton is None:
            return []
        text = normal(text)
        starts: dict[int, set[int]] = {}
        for end, (size, users) in self.automaton.iter(text):
            for k, at in users:
                starts.setdefault(k, set()).add(end + 1 - size - at)
        best: dict[int, tuple[int, int]] = {}
        for k, candidates in starts.items():
            item_id, item, budget = self.items[k]
            if (at := text.find(item)) >= 0:
                found = (0, at + len(item))
            else:
                found = (budget + 1, 0)
                low = high = None
                for start in [*sorted(candidates), None]:
                    if low is not None and (start is None or start - budget > high):
                        distance, end = myers(item, text[max(low, 0):high])
                        found = min(found, (distance, max(low, 0) + end))
                        low = None
                    if start is not None:
                        low = start - budget if low is None else low
                        high = start + len(item) + budget
            if found[0] <= budget:
                best[item_id] = min(found, best.get(item_id, found))
        return [(i, *best[i]) for i in sorted(best, key=lambda i: (i is not None, i))]


@lru_cache(maxsize=2)
def _built(items: tuple[tuple[int, str], ...], rate: float) -> Matcher:
    return Matcher(list(items), rate)


def _matcher(block: Broadcast) -> Matcher:
    """Built once in each Python worker."""
    return _built(*block.value)


def item_blocks(items: DataFrame, rate: float = ERROR_RATE) -> Iterator[Broadcast]:
    """Broadcasts of about BLOCK_ITEMS items and BLOCK_BYTES of text each, collected one at a time."""
    spark = items.sparkSession
    own = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("length(text) > 0")
    n, held = own.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    blocks = max(-(-n // BLOCK_ITEMS), -(-(held or 0) // BLOCK_BYTES), 1)
    own = own.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for b in range(blocks):
        yield spark.sparkContext.broadcast((tuple((r.item_id, r.text) for r in own.where(F.col("_b") == b).collect()), rate))


def matches(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance, end_at (code points of the normalised text)."""
    def block_matches(block: Broadcast) -> DataFrame:
        @F.pandas_udf("array<struct<item_id:long,distance:int,end_at:int>>")
        def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            match = _matcher(block)
            for part in parts:
                yield pd.Series([[{"item_id": i, "distance": d, "end_at": e} for i, d, e in match(t)] for t in part])

        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(run(F.col("text"))).alias("_m"))
        return found.select("doc_id", "_m.item_id", "_m.distance", "_m.end_at")

    blocks = item_blocks(items, rate)
    block, after = next(blocks), next(blocks, None)
    if after is None:
        return block_matches(block)
    out = []
    while block is not None:  # what a block finds is written, so that it can go
        out.append(materialise(block_matches(block), "matches"))
        block.destroy()
        block, after = after, next(blocks, None)
    found = reduce(DataFrame.unionAll, out)
    # items without id may come from several blocks
    best = found.where("item_id is null").groupBy("doc_id").agg(F.min(F.struct("distance", "end_at")).alias("_m"))
    return found.where("item_id is not null").unionAll(best.select("doc_id", F.lit(None).cast("long"), "_m.distance", "_m.end_at"))


def contaminated(text: Column, block: Broadcast) -> Column:
    """Whether a text holds an item of the block."""
    @F.pandas_udf("boolean")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        match = _matcher(block)
        for part in parts:
            yield pd.Series([bool(match(t)) for t in part], dtype=bool)

    return run(text)
