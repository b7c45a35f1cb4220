"""Operator 4: approximate nearest neighbours by a hash-prefix forest.

Vectors are dealt into shards.  In a shard each tree is a sorted array of 64-bit hash
strings (signs of random projections).  A query descends each tree to its longest
matching prefix; then all trees ascend together, one bit at a time, until the entries
that share the current prefix, counted over all trees, are enough.  These are
ranked by exact cosine in double precision, and the shards' best are merged.

How many are enough is measured in each shard: ``PROBES`` of its own vectors, evenly spaced, are
searched with ``CANDIDATES / 2^k`` entries and against all vectors, and the smallest number that
finds ``TARGET`` of their neighbours is taken, at most ``CANDIDATES``.  Clustered shards thus score a few
percent of their vectors; vectors without structure need most of them.

Equal vectors are one entry that keeps its ``k + 1`` smallest ids, so a vector held
by many rows crowds nothing out and its ties are exact.

Queries run in blocks against all shards: a task holds one shard (``SHARD_ROWS``
vectors) and one block (``QUERY_BLOCK`` queries).

Results: for each query its ``k`` nearest found, nearest first, ties to the smaller
vec_id; all candidates if fewer.  Rows whose id or vector is null, or whose vector is
empty, zero, or holds a null or non-finite component, take no part.  Rows that
share the query's id are the query itself.  Only vectors of one length are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripsmith.llm.common import materialise

NEIGHBOURS = 5
TREES, BITS = 24, 64
CANDIDATES, HALVINGS = 16_000, 6
PROBES, TARGET = 64, 0.97
SHARD_ROWS, QUERY_BLOCK = 16_384, 2_048
SEED = 20_240_101


class Forest:
    """Index of the distinct vectors of a shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
        _, first, kind = np.unique(vectors.view(f"V{vectors.shape[1] * 8}").ravel(), return_index=True, return_inverse=True)
        self.vectors = vectors[first]
        self.ids: list[list[int]] = [[] for _ in first]
        for i, c in zip(ids.tolist(), kind.ravel().tolist()):
            held = self.ids[c]
            if len(held) <= k and (not held or held[-1] != i):
                held.append(i)
        self.norms = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.k = k
        self.planes = np.random.default_rng(SEED).standard_normal((TREES, vectors.shape[1], BITS))
        keys = self.keys(self.vectors)
        self.order = [np.argsort(keys[t], kind="stable") for t in range(TREES)]
        self.keys_sorted = [keys[t][self.order[t]] for t in range(TREES)]
        #: Entries that a search asks for, and vectors that searches have scored.
        self.enough, self.scored = CANDIDATES, 0
        self._measure(keys)

    def _measure(self, keys: np.ndarray) -> None:
        """Set ``enough`` by the recall of a few of the shard's own vectors."""
        n = len(self.vectors)
        if n <= self.k + 1:
            return
        probes = np.unique(np.linspace(0, n - 1, PROBES).astype(int))
        unit = self.vectors / self.norms[:, None]
        near = unit[probes] @ unit.T
        near[np.arange(len(probes)), probes] = -np.inf
        best = np.argpartition(-near, self.k - 1, axis=1)[:, :self.k]
        for enough in (CANDIDATES >> h for h in range(HALVINGS, 0, -1)):
            found = self.candidates(keys[:, probes], enough)
            if sum(np.isin(b, f).sum() for b, f in zip(best, found)) >= TARGET * best.size:
                self.enough = enough
                return

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.sqrt((vectors ** 2).sum(axis=1))[:, None]
        out = np.empty((TREES, len(vectors)), np.uint64)
        for t in range(TREES):
            out[t] = np.packbits(unit @ self.planes[t] > 0, axis=1).view(">u8").ravel()
        return out

    def ranges(self, keys: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query, the entries that share the query's first ``length`` bits."""
        low = np.where(length >= 64, np.uint64(0), np.uint64(0xFFFFFFFFFFFFFFFF) >> np.minimum(length, 63).astype(np.uint64))
        lo = np.stack([np.searchsorted(s, k & ~low, "left") for s, k in zip(self.keys_sorted, keys)])
        hi = np.stack([np.searchsorted(s, k | low, "right") for s, k in zip(self.keys_sorted, keys)])
        return lo, hi

    def candidates(self, keys: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """Per query, the entries under the longest prefix that holds enough of them, for all trees together."""
        n = keys.shape[1]
        least, most = np.zeros(n, np.int64), np.full(n, BITS, np.int64)
        while (least < most).any():
            middle = (least + most + 1) // 2
            lo, hi = self.ranges(keys, middle)
            held = (hi - lo).sum(axis=0) >= enough
            least, most = np.where(held, middle, least), np.where(held, most, middle - 1)
        lo, hi = self.ranges(keys, least)
        for q in range(n):
            yield np.unique(np.concatenate([self.order[t][lo[t, q]:hi[t, q]] for t in range(TREES)]))

    def search(self, ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, int, float]]:
        """(query id, vec_id, cosine) of the best found."""
        norms = np.sqrt((queries ** 2).sum(axis=1))
        for q, (own, found) in enumerate(zip(ids.tolist(), self.candidates(self.keys(queries), self.enough))):
            self.scored += len(found)
            near = (self.vectors[found] * queries[q]).sum(axis=1) / (self.norms[found] * norms[q])
            cut = np.sort(near)[max(0, len(near) - self.k - 1)]  # one entry may be only the query itself
            best = sorted((-s, i) for c, s in zip(found[near >= cut].tolist(), near[near >= cut].tolist())
                          for i in self.ids[c] if i != own)
            for s, i in best[:self.k]:
                yield own, i, -s


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: rows of ``vectors`` near each row of ``queries``."""
    def usable(df: DataFrame) -> DataFrame:
        own = df.select(F.col(id_col).cast("long").alias("_id"), F.col(vector_col).cast("array<double>").alias("_v"))
        bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        return own.where(F.col("_id").isNotNull() & F.col("_v").isNotNull() & ~bad & F.exists("_v", lambda x: x != 0))

    spark = vectors.sparkSession
    base, asked = materialise(usable(vectors), "vectors"), materialise(usable(queries), "queries")
    shards = max(1, -(-base.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dim = F.size("_v").alias("_dim")
    own = base.select("_id", "_v", dim, F.lit(False).alias("_asked"), F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int").alias("_shard"),
                      F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    put = asked.select("_id", "_v", dim, F.lit(True).alias("_asked"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"),
                       F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(blocks)).cast("int").alias("_block"))

    def search(part: pa.Table) -> pa.Table:
        ids = part["_id"].to_numpy()
        matrix = part["_v"].combine_chunks().values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        asked_here = part["_asked"].to_numpy(zero_copy_only=False)
        rows = []
        if asked_here.any() and not asked_here.all():
            forest = Forest(ids[~asked_here], matrix[~asked_here], k)
            rows = list(forest.search(ids[asked_here], matrix[asked_here]))
        return pa.table({"query_id": pa.array([r[0] for r in rows], pa.int64()), "vec_id": pa.array([r[1] for r in rows], pa.int64()),
                         "score": pa.array([r[2] for r in rows], pa.float64())})

    found = own.unionAll(put.select(own.columns)).groupBy("_dim", "_shard", "_block").applyInArrow(
        search, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
