"""Boosted regression trees and their exact attribution (J4, J5, J7, K1(c)).

Features are binned once by the quantiles of a mergeable sketch; a row is then its bins (a byte a
feature), its target, weight and current prediction.  Rows are kept as blocks of arrays in a
persisted RDD, since a fit is many short jobs.  Every level of every tree is one job over these
blocks: tasks walk their rows down the tree so far and add up gradients by (node, feature, bin), and
the driver picks each node's split from a table of at most ``nodes x features x 256`` rows, whatever
the number of rows (many tasks' histograms are summed in a tree of reducers first).  Rows do not
move.  The first level's job also adds the tree before to the predictions, which stay persisted; they
are checkpointed every ``WRITE_EVERY`` trees, so a lost block is at most that many trees away.

Squared error, second-order gains with an L2 term: a leaf's value is ``rate * G / (H + l2)``, G the
summed weighted residuals and H the summed weights of its rows.  A split sends ``value <= cut``
left and missing values to the side with the larger gain; both children need ``min_weight``.  Each
tree sees a share of the rows (by a hash of the key and the tree) and of the features.  Fitting
stops when the validation RMSE has not improved for ``patience`` trees, and keeps the best round.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import rnd
from ..session import checkpoint_dir
from ..sources.sinks import remove_path, scratch_path

#: Bins of a feature; the last code is a missing value.
BINS, MISSING = 255, 255
#: Trees after which the rows and their predictions are checkpointed.
WRITE_EVERY = 10
#: Rows of a task: least (while cores are idle) and most; rows of a block.
TASK_ROWS, MOST_TASK_ROWS, BLOCK_ROWS = 100_000, 1_000_000, 65_536
#: Tasks whose histograms the driver adds up by itself.
_FEW_TASKS = 32
#: Rank error of the sketch that places the bins: one in so many rows.
_SKETCH = 50_000


@dataclass(frozen=True)
class Params:
    """What a fit may vary; the defaults are the fixed values of the reference model."""
    trees: int = 300
    depth: int = 5
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    l2: float = 2.0
    min_weight: float = 10.0
    patience: int | None = 20
    bins: int = BINS
    seed: int = 42


@dataclass
class Tree:
    """Nodes in heap order (the children of ``k`` are ``2k + 1`` and ``2k + 2``); feature -1 is a leaf."""
    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    value: np.ndarray

    @classmethod
    def blank(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1), np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool), np.zeros(n), np.zeros(n), np.zeros(n))

    def descend(self, go_left, n_rows: int, levels: int) -> np.ndarray:
        """Node of each row after some levels; ``go_left(rows, features, nodes)`` says which rows go left."""
        node = np.zeros(n_rows, np.int64)
        for _ in range(levels):
            rows = np.flatnonzero(self.feature[node] >= 0)
            if not len(rows):
                break
            at = node[rows]
            node[rows] = 2 * at + 2 - go_left(rows, self.feature[at], at)
        return node

    def nodes_of_bins(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """``bins``: features x rows.  A step looks the next node up by (node, bin); a leaf's next is itself."""
        n, code = len(self.feature), np.arange(256)
        left = np.where(code == MISSING, self.missing_left[:, None], code <= self.bin[:, None])
        here = np.arange(n)[:, None]
        after = np.where(self.feature[:, None] >= 0, 2 * here + 2 - left, here).ravel()
        row, start = np.arange(bins.shape[1]), np.maximum(self.feature, 0) * bins.shape[1]
        node, flat = np.zeros(len(row), np.int64), bins.ravel()
        for _ in range(levels):
            node = after.take((node << 8) + flat.take(start.take(node) + row))
        return node

    def nodes_of_values(self, values: np.ndarray, levels: int) -> np.ndarray:
        def left(rows, feature, at):
            x = values[rows, feature]
            return np.where(np.isnan(x), self.missing_left[at], x <= self.cut[at])
        return self.descend(left, len(values), levels)


@dataclass
class BoostedModel:
    """A fitted ensemble; a few numbers a node, so it is small whatever it was fitted on."""
    features: list[str]
    base: float
    trees: list[Tree]
    params: Params
    #: Validation RMSE after 0, 1, 2, ... trees (empty without validation rows).
    history: list[float] = field(default_factory=list)

    # -- tables -------------------------------------------------------------------------------
    def node_table(self, spark: SparkSession) -> DataFrame:
        """tree, node, feature, bin, cut, missing_left, gain (all null in a leaf), cover, value."""
        rows = []
        for t, tree in enumerate(self.trees):
            for k in _reached(tree):
                j = int(tree.feature[k])
                split = (self.features[j], int(tree.bin[k]), float(tree.cut[k]), bool(tree.missing_left[k]), float(tree.gain[k]))
                rows.append((t, k, *(split if j >= 0 else (None,) * 5), float(tree.cover[k]), float(tree.value[k])))
        return spark.createDataFrame(rows, "tree int, node int, feature string, bin int, cut double, missing_left boolean, gain double,"
                                           " cover double, value double")

    def importance(self, spark: SparkSession) -> DataFrame:
        """Feature, splits, total_gain, importance (mean gain a split, shares of one), rank."""
        gain, splits = np.zeros(len(self.features)), np.zeros(len(self.features), np.int64)
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(gain, tree.feature[inner], tree.gain[inner])
            np.add.at(splits, tree.feature[inner], 1)
        mean = gain / np.maximum(splits, 1)
        share = mean / (mean.sum() or 1.0)
        order = sorted(range(len(self.features)), key=lambda j: (-share[j], self.features[j]))
        return spark.createDataFrame([(self.features[j], int(splits[j]), float(gain[j]), float(share[j]), r + 1) for r, j in enumerate(order)],
                                     "feature string, splits long, total_gain double, importance double, rank int")

    # -- scoring ------------------------------------------------------------------------------
    def score(self, columns: dict[str, Column] | None = None) -> Column:
        """The prediction of a row from its features (by name; default: the frame's own).  Missing
        values go the way that their split has learned, so every row has a prediction."""
        model = self

        @F.arrow_udf("double")
        def run(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for part in parts:
                yield pa.array(model.predict(_matrix(part)))
        return run(*_inputs(self.features, columns))

    def predict(self, values: np.ndarray) -> np.ndarray:
        out = np.full(len(values), self.base)
        for tree in self.trees:
            out += tree.value[tree.nodes_of_values(values, self.params.depth)]
        return out

    # -- K1(c) --------------------------------------------------------------------------------
    def leaf_paths(self) -> list[list[tuple[float, list[tuple[int, float, float, bool, float]]]]]:
        """Per tree and leaf: (value, [(feature, low, high, missing, share)]).

        A path's conditions on one feature are one: ``low < x <= high``, or missing if ``missing``.
        ``share`` is the part of the rows that the feature's splits on the path let through.
        """
        out = []
        for tree in self.trees:
            leaves = []

            def walk(k, path, tree=tree, leaves=leaves):
                if tree.feature[k] < 0:
                    leaves.append((float(tree.value[k]), [(f, *held) for f, held in path.items()]))
                    return
                f, cover = int(tree.feature[k]), tree.cover[k]
                low, high, missing, share = path.get(f, (-np.inf, np.inf, True, 1.0))
                for child, a, b, ok in ((2 * k + 1, low, min(high, tree.cut[k]), bool(tree.missing_left[k])),
                                        (2 * k + 2, max(low, tree.cut[k]), high, not tree.missing_left[k])):
                    walk(child, {**path, f: (a, b, missing and ok, share * (tree.cover[child] / cover if cover else 0.0))})
            walk(0, {})
            out.append(leaves)
        return out

    def leaf_path_table(self, spark: SparkSession) -> DataFrame:
        """``leaf_paths`` as rows: tree, leaf, value, feature, low, high, missing, share."""
        rows = [(t, i, value, self.features[f], float(low), float(high), missing, float(share))
                for t, leaves in enumerate(self.leaf_paths()) for i, (value, path) in enumerate(leaves) for f, low, high, missing, share in path]
        return spark.createDataFrame(rows, "tree int, leaf int, value double, feature string, low double, high double, missing boolean, share double")

    def expected_value(self) -> float:
        """The prediction when no feature is known: leaves weighted by their rows."""
        return self.base + sum(value * float(np.prod([p[-1] for p in path])) for leaves in self.leaf_paths() for value, path in leaves)

    def attributions(self, columns: dict[str, Column] | None = None) -> Column:
        """array<double>: the exact Shapley value of each feature, in their order.

        The game of a leaf pays its value if all known features lie on its path, and else is worth
        that times the shares of the unknown ones.  A row's values depend only on which of the
        path's few features it meets, so they are looked up in a table of all such patterns.
        """
        tables = [(path, _shapley(value, [p[-1] for p in path])) for leaves in self.leaf_paths() for value, path in leaves if path]
        width = len(self.features)

        @F.arrow_udf("array<double>")
        def run(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for part in parts:
                x = _matrix(part).T.copy()
                none = np.isnan(x)
                phi = np.zeros((x.shape[1], width))
                for path, table in tables:
                    met = np.zeros(x.shape[1], np.int64)
                    for j, (f, low, high, missing, _) in enumerate(path):
                        inside = (x[f] > low) & (x[f] <= high)
                        met |= (inside | none[f] if missing else inside).astype(np.int64) << j
                    for j, (f, *_) in enumerate(path):
                        phi[:, f] += table[met, j]
                yield pa.FixedSizeListArray.from_arrays(pa.array(phi.ravel()), width).cast(pa.list_(pa.float64()))
        return run(*_inputs(self.features, columns))

    # -- A12 ----------------------------------------------------------------------------------
    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and a row of settings, as Parquet tables."""
        self.node_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = [(json.dumps({"features": self.features, "base": self.base, "params": asdict(self.params), "history": self.history,
                             "trees": len(self.trees)}),)]
        spark.createDataFrame(head, "settings string").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        head = json.loads(spark.read.parquet(f"{path}/settings").first()[0])
        params = Params(**head["params"])
        trees = [Tree.blank(params.depth) for _ in range(head["trees"])]
        place = {f: j for j, f in enumerate(head["features"])}
        for r in spark.read.parquet(f"{path}/nodes").collect():  # a bounded number of nodes a tree
            t, k = trees[r.tree], r.node
            t.cover[k], t.value[k] = r.cover, r.value
            if r.feature is not None:
                t.feature[k], t.bin[k], t.cut[k], t.missing_left[k], t.gain[k] = place[r.feature], r.bin, r.cut, r.missing_left, r.gain
        return cls(head["features"], head["base"], trees, params, head["history"])


def _reached(tree: Tree) -> Iterator[int]:
    todo = [0]
    while todo:
        k = todo.pop()
        yield k
        if tree.feature[k] >= 0:
            todo += [2 * k + 2, 2 * k + 1]


def _shapley(value: float, shares: Sequence[float]) -> np.ndarray:
    """[pattern of features met, feature]: Shapley values of a leaf's game.

    By the definition, a subset of k other features weighs ``k! (n - k - 1)! / n!``.  The worth of all
    subsets of k is a coefficient of the product of ``share + met * z`` over the others.
    """
    n = len(shares)
    met = (np.arange(2 ** n)[:, None] >> np.arange(n) & 1).astype(float)
    weight = [math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) for k in range(n)]
    out = np.zeros((2 ** n, n))
    for i in range(n):
        worth = np.zeros((2 ** n, n))
        worth[:, 0] = 1.0
        for j in range(n):
            if j != i:
                worth[:, 1:] = worth[:, 1:] * shares[j] + worth[:, :-1] * met[:, j:j + 1]
                worth[:, 0] *= shares[j]
        out[:, i] = value * (met[:, i] - shares[i]) * (worth @ weight)
    return out


def _inputs(features: Sequence[str], columns: dict[str, Column] | None) -> list[Column]:
    return [(columns[f] if columns else F.col(f)).cast("double") for f in features]


def _matrix(columns: Sequence[pa.Array]) -> np.ndarray:
    """Rows x features; nulls are NaN."""
    return np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in columns], axis=1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that draws of different trees are unrelated."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bin_edges(train: DataFrame, features: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """Upper edges of each feature's bins: distinct quantiles of its present values, in one pass."""
    at = F.array(*[F.lit((i + 1) / bins) for i in range(bins - 1)])

    def value(f):
        x = F.col(f).cast("double")
        return F.when(~F.isnan(x), x)
    row = train.agg(*[F.percentile_approx(value(f), at, _SKETCH).alias(f"_{j}") for j, f in enumerate(features)]).first()
    return [sorted(set(row[j] or [])) for j in range(len(features))]


def _binned(df: DataFrame, features: Sequence[str], edges: list[list[float]], target: str, weight: str | None, key: str,
            validation: Column) -> DataFrame:
    """bins (a byte a feature), y, w, h (hash of the key), val."""
    rows = df.where(F.col(target).isNotNull()).select(
        F.array(*_inputs(features, None)).alias("x"), F.col(target).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), F.xxhash64(key).alias("h"), validation.alias("val"))
    cuts = [np.array(e) for e in edges]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.compute.list_flatten(batch.column("x")).to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(cuts))
            out = np.empty(x.shape, np.uint8)
            for j, c in enumerate(cuts):
                out[:, j] = np.where(np.isnan(x[:, j]), MISSING, np.searchsorted(c, x[:, j], side="left"))
            held = pa.Array.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(np.arange(0, out.size + 1, len(cuts), dtype=np.int32)),
                                                                 pa.py_buffer(out.tobytes())])
            yield pa.record_batch([held, *(batch.column(c) for c in ("y", "w", "h", "val"))], ["bins", "y", "w", "h", "val"])

    return rows.mapInArrow(code, "bins binary, y double, w double, h long, val boolean")


@dataclass
class Block:
    """Some rows: bins (features x rows), target, weight, key hash, validation flag, prediction."""
    bins: np.ndarray
    y: np.ndarray
    w: np.ndarray
    h: np.ndarray
    val: np.ndarray
    p: np.ndarray


def _blocks(rows: DataFrame, width: int, base: float) -> RDD:
    """The binned rows as blocks, predicted by ``base``; partitions stay."""
    names = ("bins", "y", "w", "h", "val")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block():
            parts = [pa.concat_arrays([b.column(c) for b in held]) for c in names]
            offs = np.frombuffer(parts[0].buffers()[1], np.int32)[parts[0].offset:parts[0].offset + n + 1]
            codes = np.frombuffer(parts[0].buffers()[2], np.uint8)[offs[0]:offs[-1]].reshape(n, width)
            rest = [np.ascontiguousarray(x.to_numpy(zero_copy_only=False)) for x in parts[1:]]
            return pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in (codes.T, *rest)], names)
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield block()
                held, n = [], 0
        if n:
            yield block()

    def unpack(r) -> Block:
        y, w, h, val = (np.frombuffer(r[c], t) for c, t in (("y", float), ("w", float), ("h", np.int64), ("val", bool)))
        return Block(np.frombuffer(r["bins"], np.uint8).reshape(width, len(y)), y, w, h, val, np.full(len(y), base))

    packed = rows.select(*names).mapInArrow(pack, ", ".join(f"{c} binary" for c in names))
    return packed.rdd.map(unpack)


def _sampled(h: np.ndarray, tree: int, share: float, seed: int) -> np.ndarray:
    if share >= 1.0:
        return np.ones(len(h), bool)
    salt = np.uint64(((tree + 1) * 0x9E3779B97F4A7C15 + seed) % 2 ** 64)
    return _mix(h.astype(np.uint64) + salt) < np.uint64(int(share * 2 ** 64))


def _drawn(width: int, tree: int, share: float, seed: int) -> list[int]:
    """The features that a tree may split on."""
    keep = max(1, int(share * width))
    order = np.random.default_rng([seed, tree]).permutation(width)
    return sorted(order[:keep].tolist())


def _level(rows: RDD, tree: Tree, level: int, number: int, columns: list[int], width: int, p: Params) -> dict:
    """{node: [feature, bin, (G, H)] histogram}, and under -1 (summed squared error, weight) of the validation rows at level 0."""
    first, count = 2 ** level - 1, 2 ** level

    def add(blocks: Iterator[Block]) -> Iterator[tuple]:
        sums = np.zeros((2, len(columns), count * 256))
        error = np.zeros(2)
        for b in blocks:
            r, train = b.y - b.p, ~b.val
            if level == 0 and b.val.any():
                error += float((b.w[b.val] * r[b.val] ** 2).sum()), float(b.w[b.val].sum())
            take = _sampled(b.h, number, p.row_share, p.seed) & train
            node = tree.nodes_of_bins(b.bins, level) - first
            take = np.flatnonzero(take & (node >= 0))
            node, w = node[take] << 8, b.w[take]
            wr = w * r[take]
            for k, j in enumerate(columns):
                at = node + b.bins[j].take(take)
                sums[0, k] += np.bincount(at, wr, count * 256)
                sums[1, k] += np.bincount(at, w, count * 256)
        live = np.flatnonzero(sums[1].any(axis=0))  # cells that hold rows
        yield live, sums[:, :, live], error

    def merge(a: tuple, b: tuple) -> tuple:
        live = np.union1d(a[0], b[0])
        sums = np.zeros((2, len(columns), len(live)))
        for cells, part, _ in (a, b):
            sums[:, :, np.searchsorted(live, cells)] += part
        return live, sums, a[2] + b[2]

    parts, tasks = rows.mapPartitions(add), rows.getNumPartitions()
    found = [parts.treeReduce(merge)] if tasks > _FEW_TASKS else parts.collect()  # a bounded table a task
    sums, error = np.zeros((2, len(columns), count * 256)), np.zeros(2)
    for live, part, e in found:
        sums[:, :, live] += part
        error += e
    out = {-1: (float(error[0]), float(error[1]))}
    for k in np.flatnonzero(sums[1].reshape(len(columns), count, 256).any(axis=(0, 2))).tolist():
        table = np.zeros((width, 256, 2))
        table[columns] = sums[:, :, k * 256:(k + 1) * 256].transpose(1, 2, 0)
        out[first + k] = table
    return out


def best_split(table: np.ndarray, columns: Sequence[int], edges: list[list[float]], p: Params) -> tuple | None:
    """(gain, feature, bin, missing left, (G, H) left, (G, H) right) of a node's histogram; ties go to the first."""
    best = None
    for j in columns:
        n = len(edges[j])
        if not n:
            continue
        total, gone = table[j].sum(axis=0), table[j, MISSING]
        left = np.cumsum(table[j, :n], axis=0)
        for missing_left in ((True, False) if gone[1] > 0 else (True,)):
            a = left + gone if missing_left else left
            b = total - a
            ok = (a[:, 1] >= p.min_weight) & (b[:, 1] >= p.min_weight)
            if not ok.any():
                continue
            gain = np.where(ok, a[:, 0] ** 2 / (a[:, 1] + p.l2) + b[:, 0] ** 2 / (b[:, 1] + p.l2) - total[0] ** 2 / (total[1] + p.l2), -np.inf)
            k = int(np.argmax(gain))
            if gain[k] > 1e-6 and (best is None or gain[k] > best[0] * (1 + 1e-9)):
                best = (float(gain[k]), j, k, missing_left, a[k], b[k])
    return best


def _grow(rows: RDD, number: int, edges: list[list[float]], p: Params) -> tuple[Tree, tuple[float, float]]:
    """A tree, and the validation error of the trees before it."""
    width, tree, error = len(edges), Tree.blank(p.depth), (0.0, 0.0)
    columns, live = _drawn(width, number, p.column_share, p.seed), {0}
    for level in range(p.depth):
        found = _level(rows, tree, level, number, columns, width, p)
        if level == 0:
            error = found[-1]
        after = set()
        for k in sorted(live & set(found)):
            if level == 0:
                g, h = found[k][columns[0]].sum(axis=0)
                tree.cover[k], tree.value[k] = h, p.rate * g / (h + p.l2)
            split = best_split(found[k], columns, edges, p)
            if split is None:
                continue
            tree.gain[k], tree.feature[k], tree.bin[k], tree.missing_left[k] = split[0], split[1], split[2], split[3]
            tree.cut[k] = edges[split[1]][split[2]]
            for child, (g, h) in ((2 * k + 1, split[4]), (2 * k + 2, split[5])):
                tree.cover[child], tree.value[child] = h, p.rate * g / (h + p.l2)
                after.add(child)
        live = after
        if not live:
            break
    return tree, error


def fit_boosted(train: DataFrame, features: Sequence[str] = tuple(C.FEATURES), target: str = C.TARGET, validation: DataFrame | None = None,
                weight: str | None = None, key: str = C.KEY_COL, params: Params = Params()) -> BoostedModel:
    """Fit on ``train``; with ``validation`` rows, stop early and keep the best round.

    ``weight`` names a column of row weights (J7).  Rows without target take no part; missing
    features do.  Raises ValueError without training rows.
    """
    if not 2 <= params.bins <= BINS:
        raise ValueError(f"bins must be 2 to {BINS}")
    spark, features = train.sparkSession, list(features)
    edges = bin_edges(train.where(F.col(target).isNotNull()), features, params.bins)
    coded = _binned(train, features, edges, target, weight, key, F.lit(False))
    if validation is not None:
        coded = coded.unionByName(_binned(validation, features, edges, target, weight, key, F.lit(True)))
    path = scratch_path(spark, "boosted")
    coded.write.parquet(path)
    held = spark.read.schema(coded.schema).parquet(path)
    n, total, weights = held.agg(F.count(F.lit(1)), F.sum(F.when(~F.col("val"), F.col("w") * F.col("y"))),
                                 F.sum(F.when(~F.col("val"), F.col("w")))).first()
    if not weights:
        raise ValueError("no row to fit on")
    base, tasks = total / weights, _tasks(n, spark.sparkContext.defaultParallelism)
    rows = _blocks(held.repartition(tasks, "h"), len(features), float(base)).persist(StorageLevel.MEMORY_AND_DISK)
    model, kept = BoostedModel(features, float(base), [], params), None
    best = (np.inf, 0)
    for number in range(params.trees + 1):
        last = number == params.trees
        if last and validation is None:
            break
        before = rows
        if number:
            rows = _moved(rows, model.trees[-1], params.depth)
        if number and number % WRITE_EVERY == 0:
            checkpoint_dir(spark)
            rows.checkpoint()
        if last:  # only the error of the last tree is still wanted
            tree, error = None, _level(rows, Tree.blank(0), 0, number, [0], len(features), params)[-1]
        else:
            tree, error = _grow(rows, number, edges, params)
        if before is not rows:  # the jobs above have made the new rows
            before.unpersist()
        if rows.isCheckpointed():
            if kept:
                remove_path(spark, kept)
            kept = rows.getCheckpointFile()
        if error[1]:
            rmse = (error[0] / error[1]) ** 0.5
            model.history.append(rmse)
            if rmse < best[0]:
                best = (rmse, number)
            elif params.patience is not None and number - best[1] >= params.patience:
                break
        if last:
            break
        model.trees.append(tree)
    rows.unpersist()
    for done in (path, kept):
        if done:
            remove_path(spark, done)
    if model.history:
        model.trees = model.trees[:best[1]]
    return model


def _tasks(n: int, cores: int) -> int:
    """Tasks for ``n`` rows: one a core if each has enough to do, more if they would hold too many rows."""
    return max(1, min(-(-n // TASK_ROWS), cores), -(-n // MOST_TASK_ROWS))


def _moved(rows: RDD, tree: Tree, depth: int) -> RDD:
    """The rows with ``tree`` added to their predictions."""
    return rows.map(lambda b: replace(b, p=b.p + tree.value[tree.nodes_of_bins(b.bins, depth)])).persist(StorageLevel.MEMORY_AND_DISK)


# -- K1(c) / K2 -------------------------------------------------------------------------------
def tree_attribution(df: DataFrame, model: BoostedModel, key: str = C.KEY_COL) -> DataFrame:
    """Long table ``key, base_value, feature, phi`` of a boosted model, exact on every row."""
    named = df.select(key, model.attributions().alias("_phi"))
    return named.select(key, F.lit(model.expected_value()).alias("base_value"), F.explode(F.arrays_zip(
        F.array(*[F.lit(f) for f in model.features]).alias("feature"), F.col("_phi").alias("phi"))).alias("_a")).select(key, "base_value", "_a.*")


def additivity(scored: DataFrame, model: BoostedModel, pred: str = "prediction", tolerance: float = C.ADDITIVITY_TOLERANCE) -> DataFrame:
    """K2: rows where base + sum of attributions misses ``prediction`` by ``tolerance`` or more."""
    total = F.aggregate("_phi", F.lit(0.0), lambda s, x: s + x)
    diff = F.abs(F.lit(model.expected_value()) + total - F.col(pred))
    return scored.withColumn("_phi", model.attributions()).agg(
        F.count(F.lit(1)).alias("rows_checked"),
        F.count_if(F.coalesce(diff >= F.lit(float(tolerance)), F.lit(True))).alias("violations"), rnd(F.max(diff), 6).alias("max_abs_diff"))
