"""Feature-store API over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..functions.geo import haversine_km
from ..functions.time import time_feature_columns
from ..sources.registry import validate_feature_request
from .pit import point_in_time_features
from .splits import temporal_split


def get_historical_features(processed: DataFrame, feature_list: Sequence[str] | None = None,
                            include_point_in_time: bool = True, validate_pit: bool = False,
                            train_frac: float = C.TRAIN_FRAC, gap_frac: float = C.GAP_FRAC,
                            as_of: str | None = None, ttl_days: int | None = None):
    """L3: (labelled frame, available feature names, missing names).

    Demand features are computed before the split (as the reference).  The
    result is ONE frame with a ``split`` column (train / gap / val) instead of
    two positional copies; ``validate_pit=True`` runs the full D6 recount and
    raises on any mismatch.

    ``as_of`` (a time) retrieves what was known then: later rows, and with ``ttl_days`` rows older
    than the view's time to live, take no part - neither as rows nor in the demand features.
    For features of other entities at each row's own time see ``as_of_features``.
    """
    spark = processed.sparkSession
    if feature_list:
        validate_feature_request(spark, feature_list)
    if as_of is not None:
        t = F.to_timestamp(F.lit(as_of))
        processed = processed.where(F.col(C.TIME_COL) <= t) if ttl_days is None else ttl_filter(processed, as_of, ttl_days)
    elif ttl_days is not None:
        raise ValueError("ttl_days needs as_of")
    feats = list(feature_list or C.FEATURES)
    # the cuts depend on times and keys alone: found here, no pass for them joins the features
    df = processed = temporal_split(processed, train_frac, gap_frac)
    if include_point_in_time:
        df = point_in_time_features(df)
        feats += [f for f in C.PIT_FEATURES if f not in feats]
        if validate_pit:
            from .pit import pit_violations
            v = pit_violations(df).first()
            if v.violations:
                raise ValueError(f"point-in-time violation in {v.violations} rows")
    available = [f for f in feats if f in df.columns]          # H4
    missing = [f for f in feats if f not in df.columns]
    keep = [c for c in [C.KEY_COL, C.TIME_COL, C.TARGET, "split"] if c in df.columns]
    return df.select(*keep, *[f for f in available if f not in keep]), available, missing


def online_features(requests: DataFrame, ts: str = C.TIME_COL) -> DataFrame:
    """L4: the same column expressions applied to request rows (batch or stream).
    Requests carry the time, four coordinates, passenger count and vendor."""
    out = requests.withColumns(time_feature_columns(ts)).withColumn(
        "distance_km", haversine_km("pickup_latitude", "pickup_longitude",
                                    "dropoff_latitude", "dropoff_longitude"))
    keep = [c for c in requests.columns if c not in C.FEATURES]
    return out.select(*keep, *[F.col(f) for f in C.FEATURES])


def ttl_filter(df: DataFrame, as_of: str, ttl_days: int = 365, ts: str = C.TIME_COL) -> DataFrame:
    """Rows no older than ``ttl_days`` before ``as_of`` and not after it."""
    t = F.to_timestamp(F.lit(as_of))
    return df.where((F.col(ts) >= t - F.make_dt_interval(F.lit(ttl_days))) & (F.col(ts) <= t))


def as_of_features(requests: DataFrame, view: DataFrame, key: str, features: Sequence[str], request_ts: str, view_ts: str,
                   ttl_seconds: int, bucket_seconds: int = 86_400, tie: str | None = None) -> DataFrame:
    """For each request, the features of its entity as the view knew them at that time.

    A request gets the latest view row of its key with ``view_ts <= request_ts``, unless it is older
    than the time to live; then, and without such a row, the features are NULL.  Of view rows of one
    key and time the one with the largest ``tie`` (else the largest features) counts.  Requests with
    a NULL key or time, and view rows with one, match nothing; every request comes back once.

    No range join: requests and view rows are merged by (key, time bucket) and the last view row is
    carried forward inside a bucket.  What a bucket begins with comes from a table of each bucket's
    last row, carried from bucket to bucket: a row per key and bucket, not per event.  A key with
    most of the rows is thus dealt over its buckets.
    """
    def bucket(ts: Column) -> Column:
        return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(bucket_seconds * 1_000_000)).cast("long")

    feats = list(features)
    held = F.struct(F.col(view_ts).cast("timestamp").alias("_ts"), F.col(tie if tie else feats[0]).alias("_tie"), *feats)
    rows = view.where(F.col(key).isNotNull() & F.col(view_ts).isNotNull()).select(F.col(key).alias("_k"), bucket(F.col(view_ts)).alias("_b"), held.alias("_v"))
    rest = [c for c in requests.columns if c not in feats]
    asked = requests.select(F.col(key).alias("_k"), bucket(F.col(request_ts)).alias("_b"), F.col(request_ts).cast("timestamp").alias("_t"),
                            F.struct(*rest).alias("_r"))
    # within a bucket: at equal times view rows come first, the one that counts last
    merged = rows.select("_k", "_b", F.col("_v._ts").alias("_t"), "_v", F.lit(None).cast(asked.schema["_r"].dataType).alias("_r")).unionByName(
        asked.select("_k", "_b", "_t", F.lit(None).cast(rows.schema["_v"].dataType).alias("_v"), "_r"))
    inside = Window.partitionBy("_k", "_b").orderBy(F.col("_t").asc(), F.col("_r").isNotNull(), F.col("_v").asc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    found = merged.withColumn("_in", F.last("_v", ignorenulls=True).over(inside)).where("_r is not null")
    # a row per (key, bucket): its last view row, and what the buckets before it leave
    ends = rows.groupBy("_k", "_b").agg(F.max("_v").alias("_e")).unionByName(
        asked.where("_k is not null").select("_k", "_b").distinct().withColumn("_e", F.lit(None).cast(rows.schema["_v"].dataType)))
    ends = ends.groupBy("_k", "_b").agg(F.max("_e").alias("_e"))
    before = Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("_k", "_b", F.last("_e", ignorenulls=True).over(before).alias("_before"))
    best = F.coalesce("_in", "_before")
    old = F.unix_micros("_t") - F.unix_micros(best["_ts"]) > F.lit(ttl_seconds * 1_000_000)
    joined = found.join(carried, ["_k", "_b"], "left").withColumn("_x", F.when(F.col("_k").isNotNull() & ~old, best))
    return joined.select("_r.*", F.col("_x._ts").alias("feature_ts"), *[F.col(f"_x.{f}").alias(f) for f in feats])
