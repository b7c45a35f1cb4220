"""Point-in-time demand features.

F1 ``trip_count_last_1h``: for a row at time T, the number of rows with a
non-null target and ``T - lookback <= ts < T`` (ties at T excluded, 0 when the
window is empty).  With ``E(x)`` = weight of rows with ``ts < x``, the count is
``E(T) - E(T - lookback)``.  ``method="scan"`` (default) evaluates E with one
distributed prefix sum over the *distinct* timestamps plus the query points
``T - lookback``; the heaviest task is bounded whatever the time skew (a hot
instant collapses to one row in the map-side aggregate; a hot hour is split by
the range partitioner).  ``method="halo"`` is the classic bucketed window
(rows copied into their own and the next lookback-wide bucket); it is cheaper
on even data but a hot bucket lands in one task, so it serves as the
independent check (D6) and the benchmark comparator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import rnd
from ..functions.time import epoch_micros
from ..session import checkpoint_dir
from .ordering import prefix_sum

HOUR_US = 3_600_000_000


def rolling_count(df: DataFrame, ts: str = C.TIME_COL, value: str = C.TARGET,
                  lookback_us: int = HOUR_US, out: str = "trip_count_last_1h",
                  method: str = "scan") -> DataFrame:
    if method == "halo":
        return _rolling_count_halo(df, ts, value, lookback_us, out)
    if method != "scan":
        raise ValueError(method)
    with_t = df.withColumn("_t", epoch_micros(ts))
    data = (with_t.groupBy("_t")
            .agg(F.count(value).alias("_w"), F.count(F.lit(1)).alias("_rows")))  # hot instants collapse
    points = data.select(F.col("_t").alias("_k"), F.lit(1).alias("_role"), "_w", "_rows",
                         F.col("_t").alias("_origin")).unionByName(
        data.select((F.col("_t") - F.lit(lookback_us)).alias("_k"), F.lit(0).alias("_role"),
                    F.lit(0).cast("long").alias("_w"), F.lit(0).cast("long").alias("_rows"), F.col("_t").alias("_origin")))
    pre = prefix_sum(points, ["_k", "_role"], "_w", "_pre")
    counts = pre.groupBy(F.col("_origin").alias("_t")).agg(
        (F.sum(F.when(F.col("_role") == 1, F.col("_pre")).otherwise(-F.col("_pre"))))
        .cast("long").alias(out), F.max("_rows").alias("_rows"))
    return _by_instant(with_t, counts, out).drop("_t")


#: Rows at one instant from which its count travels to the rows instead of the rows to it.
HOT_ROWS = 50_000
_MAX_BROADCAST = 100_000


def _by_instant(with_t: DataFrame, counts: DataFrame, out: str) -> DataFrame:
    """Attach each instant's count.  Counts of hot instants (few: at most rows / HOT_ROWS) are
    broadcast, so their rows stay where they are; all other rows are joined by instant."""
    hot = counts.where(F.col("_rows") >= HOT_ROWS).select("_t", F.col(out).alias("_hot")).checkpoint()
    counts = counts.drop("_rows")
    if not 0 < hot.count() <= _MAX_BROADCAST:
        return with_t.join(counts, "_t", "left")
    marked = with_t.join(F.broadcast(hot), "_t", "left")
    rest = marked.where("_hot is null").drop("_hot").join(counts, "_t", "left")
    return rest.unionByName(marked.where("_hot is not null").withColumnRenamed("_hot", out))


def _rolling_count_halo(df, ts, value, lookback_us, out):
    with_t = df.withColumn("_t", epoch_micros(ts))
    b = F.floor(F.col("_t") / F.lit(lookback_us)).cast("long")
    copies = with_t.withColumn("_c", F.explode(F.array(
        F.struct(b.alias("b"), F.lit(True).alias("home")),
        F.struct((b + 1).alias("b"), F.lit(False).alias("home")))))
    copies = copies.withColumns({"_b": F.col("_c.b"), "_home": F.col("_c.home")}).drop("_c")
    return (copies.withColumn(out, _in_lookback(F.col(value).isNotNull().cast("long"), lookback_us))
            .where("_home").drop("_b", "_home", "_t"))


def _in_lookback(weight: Column, lookback_us: int) -> Column:
    """Sum of ``weight`` over ``[_t - lookback, _t)`` for the home rows (``_home``) of a bucket (``_b``)
    that also holds the rows of the bucket before.

    A window with two moving ends is summed anew for every row.  Here the earlier bucket's rows count
    from the start and leave a lookback after their time, the bucket's own enter at theirs, so one
    running sum does.  Rows without time are one instant of a bucket of their own.
    """
    bucket = Window.partitionBy("_b")
    changes = F.when(F.col("_home"), F.col("_t")).otherwise(F.col("_t") + F.lit(lookback_us))
    sofar = bucket.orderBy(changes).rangeBetween(Window.unboundedPreceding, -1)
    held = F.sum(F.when(~F.col("_home"), weight).otherwise(F.lit(0))).over(bucket)
    moved = F.sum(F.when(F.col("_home"), weight).otherwise(-weight)).over(sofar)
    return F.when(F.col("_t").isNotNull(), held + F.coalesce(moved, F.lit(0))).otherwise(F.sum(weight).over(bucket)).cast("long")


def daily_hour_mean(df: DataFrame, ts: str = C.TIME_COL, value: str = C.TARGET) -> DataFrame:
    """Mean target per (date, hour); size bounded by days x 24."""
    return df.groupBy(F.to_date(ts).alias("date"), F.hour(ts).cast("int").alias("hour")).agg(
        F.avg(F.col(value).cast("double")).alias("daily_hour_mean"),
        F.count(F.lit(1)).alias("rows"))


def avg_same_hour(df: DataFrame, ts: str = C.TIME_COL, value: str = C.TARGET,
                  days: int = 7, frame: str = "rows", fallback: str = "global",
                  out: str = "avg_duration_same_hour_last7days", history: DataFrame | None = None) -> DataFrame:
    """mean of the previous ``days`` daily means of the same hour.

    ``frame="rows"`` (parity) uses the previous 7 *observed* days of that hour;
    ``frame="days"`` uses calendar days ``[d-7, d-1]``.  Missing history falls
    back to the whole-table mean (``fallback="global"``, parity: it looks ahead), to the
    mean of all earlier days (``fallback="past"``, NULL on the first day) or stays NULL
    (``fallback="none"``).  The (date, hour) table grows with the calendar only (days x
    24); it is counted, then broadcast.  Means come from ``history`` (default: ``df``), so a frame
    that other features were joined to is not computed again for them.
    """
    history = df if history is None else history
    daily = daily_hour_mean(history, ts, value)
    if frame == "rows":
        w = Window.partitionBy("hour").orderBy("date").rowsBetween(-days, -1)
    elif frame == "days":
        daily = daily.withColumn("_dn", F.unix_date("date"))
        w = Window.partitionBy("hour").orderBy("_dn").rangeBetween(-days, -1)
    else:
        raise ValueError(frame)
    lag = daily.select(F.col("date").alias("_date"), F.col("hour").alias("_hour"),
                       F.avg("daily_hour_mean").over(w).alias("_avg"))
    keyed = df.withColumns({"_date": F.to_date(ts), "_hour": F.hour(ts).cast("int")})
    if fallback == "past":
        by_day = daily.groupBy("date").agg(F.sum(F.col("daily_hour_mean") * F.col("rows")).alias("_s"), F.sum("rows").alias("_n"))
        before = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, -1)  # a row per day
        past = by_day.select(F.col("date").alias("_date"), F.try_divide(F.sum("_s").over(before), F.sum("_n").over(before)).alias("_p"))
        lag = lag.join(past, "_date").withColumn("_avg", F.coalesce("_avg", "_p")).drop("_p")
    checkpoint_dir(df.sparkSession)
    lag = lag.checkpoint()
    j = keyed.join(F.broadcast(lag) if lag.count() <= _MAX_BROADCAST else lag, ["_date", "_hour"], "left")
    if fallback == "global":
        g = history.agg(F.avg(F.col(value).cast("double")).alias("_g"))  # one row
        j = j.crossJoin(F.broadcast(g)).withColumn(out, F.coalesce("_avg", "_g")).drop("_g")
    elif fallback in ("none", "past"):
        j = j.withColumn(out, F.col("_avg"))
    else:
        raise ValueError(fallback)
    return j.drop("_avg", "_date", "_hour")


def point_in_time_features(df: DataFrame, method: str = "scan") -> DataFrame:
    """both demand features attached to every row.  The daily means come from ``df`` itself, so
    the counts are joined once."""
    return avg_same_hour(rolling_count(df, method=method), history=df)


def feature_profile(df: DataFrame) -> DataFrame:
    """Mean / max of the demand features."""
    return df.agg(
        rnd(F.avg("trip_count_last_1h"), 4).alias("mean_trip_count_last_1h"),
        F.max("trip_count_last_1h").cast("long").alias("max_trip_count_last_1h"),
        rnd(F.avg("avg_duration_same_hour_last7days"), 4).alias("mean_avg_duration_7d"),
        rnd(F.max("avg_duration_same_hour_last7days"), 4).alias("max_avg_duration_7d"))


def pit_violations(df: DataFrame, attached: str = "trip_count_last_1h", ts: str = C.TIME_COL,
                   value: str = C.TARGET, lookback_us: int = HOUR_US) -> DataFrame:
    """Recount the attached ``trip_count_last_1h`` of *every* row by another method and
    report the rows where the two disagree.

    The recount merges arrivals and departures: each timed row adds one to the running count at
    its time and takes it away a lookback later.  Times are dealt into pieces of a lookback and
    summed per instant first, so a hot instant is one row; the count carried into a piece is
    the sum of the piece before it.
    """
    t = epoch_micros(ts)
    instants = df.groupBy(t.alias("_t")).agg(F.count(value).alias("_w"), F.count(F.lit(1)).alias("_rows"))
    b = F.floor(F.col("_t") / F.lit(lookback_us)).cast("long")
    copies = instants.select("_t", "_w", F.explode(F.array(
        F.struct(b.alias("_b"), F.lit(True).alias("_home")), F.struct((b + 1).alias("_b"), F.lit(False).alias("_home")))).alias("_c")).select("_t", "_w", "_c.*")
    recount = copies.withColumn("_again", _in_lookback(F.col("_w"), lookback_us)).where("_home").select("_t", "_again")
    kept = df.select(t.alias("_t"), F.col(attached).alias("_have")).groupBy("_t", "_have").agg(F.count(F.lit(1)).alias("_rows"))
    j = kept.join(recount, "_t", "left")
    return j.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_checked"), F.coalesce(F.sum(F.when(
        ~F.equal_null(F.col("_have"), F.col("_again")), F.col("_rows"))), F.lit(0)).alias("violations"))
