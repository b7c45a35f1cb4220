"""Distributed total order: global positions, exact quantiles, prefix sums.

Spark has no partition-free window that scales: ``Window.orderBy`` without
``partitionBy`` moves every row into one task.  These helpers give the same
answers with a *range-partitioned* sort instead:

1. ``repartitionByRange`` on a unique sort key (sampling splits hot key
   ranges; a tiebreak column splits runs of equal values), then sort within
   partitions;
2. reliable ``checkpoint()`` into ``spark.checkpoint.dir`` - it pins the
   partition contents, so partition ids are stable between the two passes
   below and the lineage is cut (survives executor loss);
3. per-partition row counts -> running offsets over a table with one row per
   partition (size bounded by the partition count, so it is broadcast);
4. position = partition offset + local row number
   (``monotonically_increasing_id`` encodes partition id and local number).

The same pattern with weights (``prefix_sum``) uses ``mapInPandas`` for the
local running sum, which is vectorised numpy over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

_LOCAL_MASK = (1 << 33) - 1


def range_sorted_checkpoint(df: DataFrame, order: Sequence[Column | str],
                            num_partitions: int | None = None) -> DataFrame:
    """Range-partition + sort + reliable checkpoint (see module docstring)."""
    checkpoint_dir(df.sparkSession)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    # Without an explicit count, AQE may coalesce the range partitions to its
    # advisory size; it only merges *adjacent* ranges, so partition index order
    # is still the global order, and the checkpoint pins the final layout.
    part = (df.repartitionByRange(num_partitions, *cols) if num_partitions
            else df.repartitionByRange(*cols))
    return part.sortWithinPartitions(*cols).checkpoint(eager=True)


def _partition_offsets(local: DataFrame, weight: Column | None = None) -> DataFrame:
    w = F.lit(1).cast("long") if weight is None else weight
    counts = local.groupBy("_pid").agg(F.sum(w).alias("_cnt"))
    # one row per partition: a single-task window is fine here
    run = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_pid", F.coalesce(F.sum("_cnt").over(run), F.lit(0)).cast("long")
                         .alias("_off"))


def with_global_position(df: DataFrame, order: Sequence[Column | str], pos_col: str = "pos",
                         num_partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``.

    ``order`` must be a unique key (append a tiebreak such as the row id);
    equal keys get distinct, arbitrary-but-stable positions otherwise.
    """
    ck = range_sorted_checkpoint(df, order, num_partitions)
    local = ck.withColumns({"_pid": F.spark_partition_id(),
                            "_mid": F.monotonically_increasing_id()})
    offsets = _partition_offsets(local)
    out = local.join(F.broadcast(offsets), "_pid").withColumn(
        pos_col, (F.col("_off") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK))).cast("long"))
    return out.drop("_pid", "_mid", "_off")


#: Accuracy of the sketch that brackets a quantile, and how many of its errors each side allows.
_SKETCH, _ERRORS = 50_000, 8
#: Groups (one small row each) that a broadcast may hold.
_MAX_BROADCAST_GROUPS = 100_000


#: Distinct values of a group that may be counted one by one (and ranked in one task); wider brackets are narrowed.
MAX_COUNTED = 100_000
#: Steps a narrowing pass cuts a bracket into.
_STEPS = 500


def bracket(value: str, q: float) -> list[Column]:
    """Aggregates ``_lo`` and ``_hi``, a mergeable sketch's bounds around the quantile ``q``, and ``_n``, the values."""
    margin = _ERRORS / _SKETCH
    both = F.percentile_approx(F.col(value).cast("double"), [max(q - margin, 0.0), min(q + margin, 1.0)], _SKETCH)
    return [both[0].alias("_lo"), both[1].alias("_hi"), F.count(value).alias("_n")]  # one sketch


def _wide(n: int | None) -> bool:
    """Whether a first bracket over ``n`` values may hold more distinct values than may be counted."""
    return n is not None and n * 2 * (_ERRORS + 1) / _SKETCH > MAX_COUNTED


def _tighter(lo, hi, grid: list, inside: int, first: int, last: int) -> tuple:
    """Bounds of the positions ``first`` to ``last`` among ``inside`` values, from their quantiles in steps.

    A step is 100 times the sketch's error, so one more step on each side is safe.
    """
    a, b = first * _STEPS // inside - 1, -(-(last + 1) * _STEPS // inside) + 1
    return (grid[a] if a > 0 else lo), (grid[b] if b < _STEPS else hi)


_GRID = [k / _STEPS for k in range(_STEPS + 1)]


def narrowed(base: DataFrame, brackets: DataFrame, q: float, by: Sequence[str]) -> DataFrame:
    """Brackets (``by``, ``_lo``, ``_hi``, ``_n``) that hold at most ``MAX_COUNTED`` distinct values of ``base`` (``by``, ``_v``).

    Each pass is one map-side aggregation over the rows: it counts below each bracket, cuts the
    values inside into ``_STEPS`` quantiles and keeps the few steps around the wanted ranks.  A
    bracket of one (hot) value is narrow however many rows hold it.  Small inputs need no pass.
    """
    if not _wide(brackets.agg(F.max("_n")).first()[0]):
        return brackets
    while True:
        v = F.col("_v")
        inside = v.between(F.col("_lo"), F.col("_hi"))
        seen = per_group(base, brackets.select(*by, "_lo", "_hi"), by).groupBy(*by).agg(
            F.count_if(v < F.col("_lo")).alias("_below"), F.count_if(inside).alias("_in"),
            F.approx_count_distinct(F.when(inside, v)).alias("_kinds"), F.percentile_approx(F.when(inside, v), _GRID, _SKETCH).alias("_g"))
        joined = brackets.join(seen, list(by), "left") if by else brackets.crossJoin(seen)
        h = F.lit(float(q)) * (F.col("_n") - 1)
        step = F.lit(_STEPS) / F.col("_in")
        a = (F.floor((F.floor(h) - F.col("_below")) * step) - 1).cast("int")
        b = (F.ceil((F.ceil(h) - F.col("_below") + 1) * step) + 1).cast("int")
        open_ = (F.col("_kinds") > MAX_COUNTED) & (F.col("_lo") < F.col("_hi"))
        lo = F.when(open_ & (a > 0), F.get("_g", a)).otherwise(F.col("_lo"))
        hi = F.when(open_ & (b < _STEPS), F.get("_g", b)).otherwise(F.col("_hi"))
        after = joined.select(*by, lo.alias("_lo"), hi.alias("_hi"), "_n", ((lo > F.col("_lo")) | (hi < F.col("_hi"))).alias("_moved")).checkpoint()
        brackets = after.drop("_moved")
        if not after.where("_moved").limit(1).count():
            return brackets


def per_group(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join a materialised table of one row per group to all rows without moving the rows.

    Groups are few (models, slices, splits, folds); their number is checked.
    """
    if not by:
        return rows.crossJoin(F.broadcast(groups))  # one row
    few = groups.count() <= _MAX_BROADCAST_GROUPS
    return rows.join(F.broadcast(groups) if few else groups, list(by))


def exact_percentile(df: DataFrame, value: str, q: float, by: Sequence[str] = (),
                     alias: str | None = None, brackets: DataFrame | None = None) -> DataFrame:
    """Exact linearly-interpolated quantile per group (numpy default / ``percentile`` /
    DuckDB ``quantile_cont``) from map-side aggregations; rows are never moved or sorted.

    1. A sketch per group brackets the quantile (``brackets``: computed by the caller together
       with other aggregates, columns ``by``, ``_lo``, ``_hi``, ``_n``).
    2. Brackets that may hold more than ``MAX_COUNTED`` distinct values are narrowed (``narrowed``).
    3. Rows below and above the bracket are counted, values inside are counted by value.  A
       running count over the distinct values inside, of a bounded number whatever the rows,
       finds the two ranks around ``q * (n - 1)``.

    One value or group may hold most rows: equal values collapse before the shuffle.  NULLs are
    left out; a group without values has no row.  Output: ``by`` columns + ``alias``.
    """
    alias = alias or f"{value}_q"
    by = list(by)
    base = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    if brackets is None:
        agg = base.groupBy(*by).agg(*bracket("_v", q))
        checkpoint_dir(df.sparkSession)
        brackets = agg.checkpoint()
    brackets = narrowed(base, brackets.select(*by, "_lo", "_hi", "_n"), q, by)
    bounded = per_group(base, brackets.select(*by, "_lo", "_hi"), by)
    side = F.when(F.col("_v") < F.col("_lo"), -1).when(F.col("_v") > F.col("_hi"), 1).otherwise(0)
    counted = bounded.select(*by, side.alias("_s"), F.when(side == 0, F.col("_v")).alias("_v"), F.col("_v").alias("_w")) \
        .groupBy(*by, "_s", "_v").agg(F.count(F.lit(1)).alias("_c"), F.min("_w").alias("_mn"), F.max("_w").alias("_mx"))
    keys = by or [F.lit(0)]
    run = Window.partitionBy(*keys).orderBy("_s", "_v")
    ranked = counted.withColumns({
        "_end": F.sum("_c").over(run.rowsBetween(Window.unboundedPreceding, 0)),
        "_h": F.lit(float(q)) * (F.sum("_c").over(Window.partitionBy(*keys)) - 1)})

    def at(rank: Column) -> Column:
        # a bracket of few rows may end one row short: the values next to it are known too
        return F.max(F.when(rank == F.col("_end") - F.col("_c"), F.col("_mn")).when(rank == F.col("_end") - 1, F.col("_mx"))
                     .when((F.col("_end") - F.col("_c") <= rank) & (rank < F.col("_end")), F.col("_v")))

    res = ranked.groupBy(*by).agg(at(F.floor("_h")).alias("_vlo"), at(F.ceil("_h")).alias("_vhi"),
                                  F.first("_h").alias("_h"))
    frac = F.col("_h") - F.floor("_h")
    out = res.select(*by, (F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))).alias(alias))
    return out.where(F.col(alias).isNotNull()) if not by else out


def rows_at(df: DataFrame, value: str, key: str, fractions: Sequence[float]) -> list[tuple | None]:
    """(value, key) of the rows at positions ``floor(n * fraction)`` in (value, key) order, the value
    as a long; None beyond the last row.  Rows are neither moved nor sorted.

    As in ``exact_percentile``: sketches bracket the positions, wide brackets are narrowed, and values
    inside them are counted.  Only where several rows share the value at a position are their keys ordered.
    """
    margin = _ERRORS / _SKETCH
    v = F.col(value).cast("long")
    around = [min(max(f + side * margin, 0.0), 1.0) for f in fractions for side in (-1, 1)]
    n, bounds = df.agg(F.count(v), F.percentile_approx(v, around, _SKETCH)).first()
    ranks = [int(n * f) for f in fractions]
    if not n:
        return [None for _ in ranks]
    bounds = _narrowed_cuts(df, v, n, ranks, list(bounds))
    step, inside = F.lit(0), F.lit(False)
    for i in range(len(fractions)):  # segments in ascending order of the value
        step = step + (v >= bounds[2 * i]).cast("int") + (v > bounds[2 * i + 1]).cast("int")
        inside = inside | v.between(bounds[2 * i], bounds[2 * i + 1])
    counted = df.where(v.isNotNull()).select(step.alias("_s"), F.when(inside, v).alias("_v"), v.alias("_w"), F.col(key).alias("_key")) \
        .groupBy("_s", "_v").agg(F.count(F.lit(1)).alias("_c"), F.min("_w").alias("_mn"), F.max("_w").alias("_mx"),
                                 F.min("_key").alias("_k"))
    run = Window.orderBy("_s", "_v").rowsBetween(Window.unboundedPreceding, -1)  # few distinct values
    before = counted.withColumn("_b", F.coalesce(F.sum("_c").over(run), F.lit(0)))
    holds = F.lit(False)
    for rank in ranks:
        holds = holds | ((F.col("_b") <= rank) & (rank < F.col("_b") + F.col("_c")))
    hits = before.where(holds).collect()  # a row per position at most
    found = []  # per rank: None, or the value, the rows before it (None: not known) and the key (None: several share the value)
    for rank in ranks:
        hit = next((h for h in hits if h["_b"] <= rank < h["_b"] + h["_c"]), None)
        if hit is None:
            found.append(None)
        elif hit["_v"] is not None:
            found.append((hit["_v"], hit["_b"], hit["_k"] if hit["_c"] == 1 else None))
        else:  # a bracket of few rows may end one row short: the values next to it are known too
            found.append((hit["_mn"] if rank == hit["_b"] else hit["_mx"], None, hit["_k"] if hit["_c"] == 1 else None))
    shared = sorted({f[0] for f in found if f is not None and f[2] is None})
    if not shared:
        return [f and (f[0], f[2]) for f in found]
    checkpoint_dir(df.sparkSession)
    ties = df.where(v.isin(shared)).select(v.alias("_v"), F.col(key).alias("_k")).checkpoint()  # one pass for all positions
    unknown = [f[0] for f in found if f is not None and f[2] is None and f[1] is None]
    below = dict(zip(unknown, df.agg(*[F.count_if(v < at) for at in unknown]).first())) if unknown else {}
    out = []
    for rank, f in zip(ranks, found):
        if f is None or f[2] is not None:
            out.append(f and (f[0], f[2]))
            continue
        at = f[0]
        before = below[at] if f[1] is None else f[1]
        ranked = with_global_position(ties.where(F.col("_v") == at).select("_k"), ["_k"], "_p")
        out.append((at, ranked.where(F.col("_p") == rank - before).first()["_k"]))
    return out


def _narrowed_cuts(df: DataFrame, v: Column, n: int, ranks: list[int], bounds: list) -> list:
    """``bounds`` (low and high of each rank) with at most ``MAX_COUNTED`` distinct values between each pair."""
    while _wide(n):
        pairs = list(zip(bounds[::2], bounds[1::2]))
        row = df.agg(*[x for i, (lo, hi) in enumerate(pairs) for x in (
            F.count_if(v < lo).alias(f"_b{i}"), F.count_if(v.between(lo, hi)).alias(f"_i{i}"),
            F.approx_count_distinct(F.when(v.between(lo, hi), v)).alias(f"_k{i}"),
            F.percentile_approx(F.when(v.between(lo, hi), v), _GRID, _SKETCH).alias(f"_g{i}"))]).first()
        after = list(bounds)
        for i, ((lo, hi), rank) in enumerate(zip(pairs, ranks)):
            if row[f"_k{i}"] > MAX_COUNTED and lo < hi and rank < n:
                at = rank - row[f"_b{i}"]
                after[2 * i:2 * i + 2] = _tighter(lo, hi, row[f"_g{i}"], row[f"_i{i}"], at, at)
        if after == bounds:
            break
        bounds = after
    return bounds


def _local_exclusive_cumsum(key_col: str, weight_col: str):
    def run(batches):
        import pyspark

        pid = pyspark.TaskContext.get().partitionId()
        acc = 0
        for pdf in batches:
            w = pdf[weight_col].to_numpy(dtype=np.int64)
            cs = np.cumsum(w) - w + acc
            acc += int(w.sum())
            out = pdf.copy()
            out["_local"] = cs
            out["_pid"] = np.int32(pid)
            yield out
    return run


def prefix_sum(df: DataFrame, order: Sequence[str], weight_col: str,
               out_col: str = "prefix", num_partitions: int | None = None) -> DataFrame:
    """Exclusive running sum of ``weight_col`` (long) in the total order ``order``:
    for each row, the sum of weights of all rows strictly before it."""
    ck = range_sorted_checkpoint(df, order, num_partitions)
    schema = T.StructType(ck.schema.fields + [T.StructField("_local", T.LongType()),
                                              T.StructField("_pid", T.IntegerType())])
    local = ck.mapInPandas(_local_exclusive_cumsum(order[0], weight_col), schema)
    offsets = _partition_offsets(ck.withColumn("_pid", F.spark_partition_id()),
                                 F.col(weight_col).cast("long"))
    out = local.join(F.broadcast(offsets), "_pid").withColumn(
        out_col, (F.col("_off") + F.col("_local")).cast("long"))
    return out.drop("_pid", "_local", "_off")
