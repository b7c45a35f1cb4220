"""Operator 12: hard-negative mining with segment summaries.

Components become integers, floor(``SCALE`` * x), and a row's score is its inner product with
the anchor.  For every vector the mean m and the deviation d (root of the summed squares around
m) of its segments are stored, for 1, 4 and 16 segments.  Over a segment of length L the inner
product lies within L m m' - d d' and L m m' + d d', so the summed bounds of few segments rule
out most vectors; those that remain meet the bounds of more segments, and only the last ones
are scored exactly.

An anchor's positives are its first ``POSITIVES`` other rows of its label, and a positive's hard
negatives the first ``NEGATIVES`` rows of other labels whose score is at least ``BAND`` percent
of the positive's and not above it.  Higher scores come first, ties by smaller id.

Work is dealt as a grid: rows by hash into shards, anchors into blocks, each of ``GRID_BYTES``
of components, and a task holds one shard and one block.  It returns its best rows for each
anchor, so that the merge reads a few rows a shard.  The first grid finds positives, the second
negatives; no pair that both grids do not need leaves a task.

Results: rows with a null id, label, vector or component, or a component that is not finite,
take no part.  Of rows that share an id, the one with the smallest label, then vector, counts.
Only vectors of one length are compared; empty vectors score 0 among themselves.  A positive
below 0 has no negatives, as its band is empty.  Scores beyond a long raise an error.  Ties
and equal vectors are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripsmith.llm.common import materialise

POSITIVES, NEGATIVES, BAND = 5, 5, 80
SCALE = 256
#: Segments a vector is cut into, level by level.
LEVELS = (1, 4, 16)
#: Components of a shard or a block, in bytes.
GRID_BYTES = 16 << 20


def summaries(vectors: np.ndarray) -> list[np.ndarray]:
    """Per level, [sqrt(L) m, d] of each segment: products of the halves are the two parts of a bound."""
    out = []
    for n in LEVELS:
        if n > vectors.shape[1]:
            break
        cuts = np.linspace(0, vectors.shape[1], n + 1).astype(int)
        size = np.diff(cuts)
        mean = np.add.reduceat(vectors, cuts[:-1], axis=1) / size
        away = vectors - np.repeat(mean, size, axis=1)
        out.append(np.hstack([mean * np.sqrt(size), np.sqrt(np.add.reduceat(away * away, cuts[:-1], axis=1))]))
    return out


class Segments:
    """The vectors of a shard, ordered by label, with their summaries."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        self.levels = summaries(self.vectors)
        self.norms = np.sqrt((self.vectors ** 2).sum(axis=1))
        self.largest = np.abs(self.vectors).max(initial=0.0)
        #: Rows scored exactly, for measurements.
        self.scored = 0

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Integer inner products; doubles hold them while they stay below 2^53."""
        self.scored += len(rows)
        if len(query) * self.largest * np.abs(query).max(initial=0.0) < 2.0 ** 53:
            return (self.vectors[rows] @ query).astype(np.int64)
        whole = [int(x) for x in query.tolist()]
        return np.array([sum(int(x) * y for x, y in zip(v, whole)) for v in self.vectors[rows].tolist()], object)

    def refined(self, rows: np.ndarray, query: np.ndarray, summary: list[np.ndarray], least: float, most: float) -> np.ndarray:
        """Rows whose bounds at every level leave a score from ``least`` to ``most`` possible."""
        norm = np.sqrt((query ** 2).sum())
        for level, own in zip(self.levels, summary):
            if not len(rows):
                break
            half = len(own) // 2
            around, away = level[rows, :half] @ own[:half], level[rows, half:] @ own[half:]
            slack = 1e-9 * self.norms[rows] * norm + 1e-6  # of rounding
            rows = rows[(around + away + slack >= least) & (around - away - slack <= most)]
        return rows

    def positives(self, own: int, label: int, query: np.ndarray, summary: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        """(score, id) of the best rows of the label."""
        rows = np.arange(*np.searchsorted(self.labels, [label, label + 1]))
        rows = rows[self.ids[rows] != own]
        if len(rows) > POSITIVES and summary:
            half = len(summary[0]) // 2
            high = self.levels[0][rows] @ summary[0] if half else np.zeros(len(rows))
            likely = rows[np.argpartition(-high, POSITIVES - 1)[:POSITIVES]]
            rows = self.refined(rows, query, summary, float(min(self.exact(likely, query))), np.inf)
        yield from best(self.exact(rows, query), self.ids[rows], POSITIVES)

    def negatives(self, label: int, query: np.ndarray, summary: list[np.ndarray], positives: list[int]) -> Iterator[tuple[int, int, int]]:
        """(positive's score, score, id) of the best rows of other labels in each positive's band."""
        wanted = sorted({p for p in positives if p >= 0})
        if not wanted:
            return
        a, b = np.searchsorted(self.labels, [label, label + 1])
        rows = np.concatenate([np.arange(a), np.arange(b, len(self.labels))])
        rows = self.refined(rows, query, summary, wanted[0] * BAND / 100, wanted[-1])
        scores = self.exact(rows, query)
        for p in wanted:
            fits = (scores * 100 >= p * BAND) & (scores <= p) if scores.dtype == object else (scores >= -(-p * BAND // 100)) & (scores <= p)
            fits = fits.astype(bool)
            for s, i in best(scores[fits], self.ids[rows[fits]], NEGATIVES):
                yield p, s, i


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The first ``k`` (score, id), highest first, ties to the smaller id."""
    if len(scores) > 8 * k:
        keep = scores >= np.sort(scores)[-k]
        scores, ids = scores[keep], ids[keep]
    return sorted(zip(scores.tolist(), ids.tolist()), key=lambda r: (-r[0], r[1]))[:k]


def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """_id, _label, _v, _dim of the rows that take part, one for each id."""
    own = rows.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"),
                      F.col(vector_col).cast("array<double>").alias("_v"))
    bad = F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = own.where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & F.col("_v").isNotNull() & ~bad)
    own = materialise(own.withColumn("_dim", F.size("_v")), "vectors")
    repeated = materialise(own.groupBy("_id").count().where("count > 1").select("_id"), "repeated")
    if not repeated.limit(1).count():
        return own
    first = own.join(repeated, "_id", "left_semi").groupBy("_id").agg(F.min(F.struct("_label", "_v", "_dim")).alias("_r")).select("_id", "_r.*")
    return materialise(own.join(repeated, "_id", "left_anti").select(own.columns).unionByName(first), "vectors")


def _grid(base: DataFrame, asked: DataFrame, search, schema: str) -> DataFrame:
    """Run ``search(Segments, anchors)`` on every pair of a shard of ``base`` and a block of ``asked`` (with ``_scores``)."""
    at_once = max(1, GRID_BYTES // (8 * max(1, base.agg(F.max("_dim")).first()[0] or 0)))
    shards, blocks = (max(1, -(-df.count() // at_once)) for df in (base, asked))
    columns = ["_id", "_label", "_v", "_dim", "_scores", "_asked", "_shard", "_block"]
    own = base.select("*", F.lit(None).cast("array<long>").alias("_scores"), F.lit(False).alias("_asked"),
                      F.pmod(F.xxhash64("_id"), F.lit(shards)).cast("int").alias("_shard"),
                      F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block"))
    put = asked.select("*", F.lit(True).alias("_asked"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("_shard"),
                       F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(blocks)).cast("int").alias("_block"))
    names = [c.split()[0] for c in schema.split(", ")]

    def run(part: pa.Table) -> pa.Table:
        here = part["_asked"].to_numpy(zero_copy_only=False)
        rows = []
        if here.any() and not here.all():
            ids, labels, dim = part["_id"].to_numpy(), part["_label"].to_numpy(), part["_dim"][0].as_py()
            flat = pa.compute.list_flatten(part["_v"].combine_chunks()).to_numpy(zero_copy_only=False)
            vectors = np.floor(flat.reshape(len(ids), dim) * SCALE)
            shard = Segments(ids[~here], labels[~here], vectors[~here])
            anchors = vectors[here]
            levels = summaries(anchors)
            scores = part["_scores"].filter(pa.array(here)).to_pylist()
            for k, (own_id, label) in enumerate(zip(ids[here].tolist(), labels[here].tolist())):
                rows += search(shard, own_id, label, anchors[k], [level[k] for level in levels], scores[k])
        return pa.table({n: pa.array([r[j] for r in rows], pa.int64()) for j, n in enumerate(names)})

    return own.select(columns).unionAll(put.select(columns)).groupBy("_dim", "_shard", "_block").applyInArrow(run, schema)


def _ranked(df: DataFrame, by: list[str], score: str, key: str, k: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.col(score).desc(), key)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor_every: int = 100, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id ``anchor_every`` divides.
    """
    base = usable(rows, id_col, label_col, vector_col)
    anchors = base.where(F.col("_id") % anchor_every == 0)
    blank = anchors.withColumn("_scores", F.lit(None).cast("array<long>"))
    near = _grid(base, blank, lambda s, own, label, q, m, _: [(own, *r) for r in s.positives(own, label, q, m)],
                 "anchor_id long, positive_score long, positive_id long")
    positives = materialise(_ranked(near, ["anchor_id"], "positive_score", "positive_id", POSITIVES).drop("rank"), "positives")
    scores = positives.groupBy(F.col("anchor_id").alias("_id")).agg(F.collect_set("positive_score").alias("_scores"))
    found = _grid(base, materialise(anchors.join(scores, "_id"), "anchors"),
                  lambda s, own, label, q, m, p: [(own, *r) for r in s.negatives(label, q, m, p)],
                  "anchor_id long, positive_score long, negative_score long, negative_id long")
    kept = _ranked(found, ["anchor_id", "positive_score"], "negative_score", "negative_id", NEGATIVES)
    return positives.join(kept, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
