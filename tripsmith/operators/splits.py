"""Time splits, walk-forward folds and leakage checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .ordering import rows_at, with_global_position


@dataclass(frozen=True)
class Fold:
    name: str
    train_end: str
    gap_end: str
    val_end: str


def _ts(s: str):
    return F.to_timestamp(F.lit(s))


def date_split(df: DataFrame, train_end: str, gap_end: str, val_end: str,
               ts: str = C.TIME_COL, split_col: str = "split",
               end_inclusive: bool = False) -> DataFrame:
    """Train ``ts <= train_end``, gap, val ``gap_end < ts <= val_end``, test after.

    Date strings mean midnight (parity: the end day itself is excluded).
    ``end_inclusive=True`` moves every cut to the end of the named day.
    Pure predicates on the time column: no shuffle.
    """
    def cut(s):
        t = _ts(s)
        return t + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND") \
            if end_inclusive else t
    t = F.col(ts)
    label = (F.when(t <= cut(train_end), "train").when(t <= cut(gap_end), "gap")
             .when(t <= cut(val_end), "val").when(t > cut(val_end), "test"))
    return df.withColumn(split_col, label)


def time_rank(df: DataFrame, ts: str = C.TIME_COL, key: str = C.KEY_COL,
              rank_col: str = "time_rank") -> DataFrame:
    """key, time and 0-based position in (time, key) order, computed with a range-partitioned
    sort of these two columns and per-partition offsets (no single-task global window)."""
    return with_global_position(df.select(key, ts), [ts, key], pos_col=rank_col)


def temporal_split(df: DataFrame, train_frac: float = C.TRAIN_FRAC,
                   gap_frac: float = C.GAP_FRAC, ts: str = C.TIME_COL, key: str = C.KEY_COL,
                   split_col: str = "split") -> DataFrame:
    """Positional split - the first ``int(n*train_frac)`` rows in (time, key) order are
    train, those up to ``int(n*(train_frac+gap_frac))`` the gap, the rest is val.  Rows are labelled
    by comparison with the two rows at the cuts: no rank, no shuffle of the table."""
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    cuts = rows_at(df.select(t.alias("_t"), key), "_t", key, [train_frac, train_frac + gap_frac])

    def before(cut):
        if cut is None:
            return F.lit(True)
        return (t < cut[0]) | ((t == cut[0]) & (F.col(key) < cut[1]))
    return df.withColumn(split_col, F.when(before(cuts[0]), "train").when(before(cuts[1]), "gap").otherwise("val"))


def assign_folds(df: DataFrame, folds: Sequence[Fold], ts: str = C.TIME_COL) -> DataFrame:
    """One output row per (row, fold) the row takes part in, with its
    role (``train`` / ``val``).  The fold list is a literal array, so this is a
    generator inside the scan stage - no join, no shuffle."""
    arr = F.array(*[F.struct(F.lit(f.name).alias("fold"), _ts(f.train_end).alias("train_end"),
                             _ts(f.gap_end).alias("gap_end"), _ts(f.val_end).alias("val_end"))
                    for f in folds])
    t = F.col(ts)
    member = F.filter(arr, lambda f: (t <= f["train_end"])
                      | ((t > f["gap_end"]) & (t <= f["val_end"])))
    out = df.withColumn("_f", F.explode(member))
    return out.withColumns({
        "fold": F.col("_f.fold"),
        "role": F.when(t <= F.col("_f.train_end"), "train").otherwise("val"),
    }).drop("_f")


def leakage_check(df: DataFrame, group: str | None = None, split_col: str = "split",
                  ts: str = C.TIME_COL, order: Sequence[str] = ("train", "val", "test")
                  ) -> DataFrame:
    """For each consecutive pair of splits, ``min(later) > max(earlier)``.
    An empty side counts as a violation (as the reference's NaT assertion)."""
    keys = [group] if group else []
    agg = df.groupBy(*keys, split_col).agg(F.min(ts).alias("_mn"), F.max(ts).alias("_mx"))
    rows = []
    for a, b in zip(order, order[1:]):
        ea = agg.where(F.col(split_col) == a).select(*keys, F.col("_mx").alias("earlier_max"))
        lb = agg.where(F.col(split_col) == b).select(*keys, F.col("_mn").alias("later_min"))
        j = ea.join(lb, keys, "full") if keys else ea.crossJoin(lb)
        rows.append(j.select(*keys, F.lit(f"{a}<{b}").alias("check"),
                             F.date_format("earlier_max", "yyyy-MM-dd HH:mm:ss").alias("earlier_max"),
                             F.date_format("later_min", "yyyy-MM-dd HH:mm:ss").alias("later_min"),
                             F.coalesce(~(F.col("later_min") > F.col("earlier_max")), F.lit(True))
                             .alias("violated")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
