"""Cleaning rules and feature engineering.

All rules are plain column predicates so Catalyst can push the ones on raw
columns down to the Parquet scan, and the funnel is one aggregation pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (FEATURES, KEY_COL, LAT_BOUNDS, LON_BOUNDS, MAX_DURATION_S,
                      MIN_DISTANCE_KM, MIN_DURATION_S, MIN_PASSENGERS, PROCESSED_COLUMNS,
                      TARGET, TIME_COL)
from ..functions.geo import haversine_km, in_box
from ..functions.numeric import rnd
from ..functions.time import time_feature_columns


def with_distance(df: DataFrame) -> DataFrame:
    return df.withColumn("distance_km", haversine_km(
        "pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude"))


def _not_nan(c: str) -> Column:
    # Spark NaN compares greater than every number; treat NaN like pandas (fails filters)
    return ~F.isnan(F.col(c))


def duration_ok(target: str = TARGET) -> Column:
    return (F.col(target) > MIN_DURATION_S) & (F.col(target) < MAX_DURATION_S)


def distance_ok() -> Column:
    return (F.col("distance_km") > MIN_DISTANCE_KM) & _not_nan("distance_km")


def passengers_ok() -> Column:
    return F.col("passenger_count") > MIN_PASSENGERS


def box_ok() -> Column:
    return (in_box("pickup_latitude", "pickup_longitude", LAT_BOUNDS, LON_BOUNDS)
            & in_box("dropoff_latitude", "dropoff_longitude", LAT_BOUNDS, LON_BOUNDS))


def features_not_null() -> Column:
    cond = F.lit(True)
    for c in FEATURES + [TARGET]:
        cond = cond & F.col(c).isNotNull()
    return cond


def _computed(df: DataFrame) -> DataFrame:
    """The same rows, through one struct each, so that filters read columns instead of repeating their expressions.

    A predicate pushed below a projection carries a copy of the whole expression (coordinates, distance)
    for every mention of a column.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.explode(F.array(row)).alias("_row")).select("_row.*")


def clean(df: DataFrame, profile: str = "full") -> DataFrame:
    """``full`` = duration, distance, passengers, box (the ETL profile);
    ``model`` = duration, distance, passengers, then drop rows with a null
    feature or target (the training profile, no box)."""
    out = _computed(with_distance(df)).where(duration_ok() & distance_ok() & passengers_ok())
    if profile == "full":
        return out.where(box_ok())
    if profile == "model":
        return with_time_columns(out).where(features_not_null())
    raise ValueError(f"unknown profile {profile!r}")


def with_time_columns(df: DataFrame, ts: str = TIME_COL) -> DataFrame:
    return df.withColumns(time_feature_columns(ts))


def engineer_features(df: DataFrame, keep_key: bool = True) -> DataFrame:
    """Calendar features + contract column order (C14).  ``id`` is kept as
    a non-feature column so later steps can join and break ties by key."""
    if "distance_km" not in df.columns:
        df = with_distance(df)
    df = with_time_columns(df)
    cols = ([KEY_COL] if keep_key and KEY_COL in df.columns else []) + PROCESSED_COLUMNS
    return df.select(*cols)


def processed(df_raw: DataFrame, profile: str = "full") -> DataFrame:
    """Raw trips -> processed table (clean + engineer)."""
    return engineer_features(clean(df_raw, profile))


def load_and_engineer(df_raw: DataFrame) -> DataFrame:
    """The model-profile table in contract order."""
    return engineer_features(clean(df_raw, "model"))


def clean_funnel(df_raw: DataFrame) -> DataFrame:
    """Rows left after each rule, in one aggregation pass (no repeated counts)."""
    d = with_distance(df_raw)
    s1 = duration_ok()
    s2 = s1 & distance_ok()
    s3 = s2 & passengers_ok()
    s4 = s3 & box_ok()
    agg = d.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(s1).alias("after_duration"),
        F.count_if(s2).alias("after_distance"),
        F.count_if(s3).alias("after_passengers"),
        F.count_if(s4).alias("after_box"),
        rnd(F.sum(F.when(s4, F.col("distance_km"))), 4).alias("sum_km"),
    )
    return agg.select(
        "raw_rows", "after_duration", "after_distance", "after_passengers", "after_box",
        (F.col("raw_rows") - F.col("after_duration")).alias("removed_duration"),
        (F.col("after_duration") - F.col("after_distance")).alias("removed_distance"),
        (F.col("after_distance") - F.col("after_passengers")).alias("removed_passengers"),
        (F.col("after_passengers") - F.col("after_box")).alias("removed_box"),
        (F.col("raw_rows") - F.col("after_box")).alias("removed_total"),
        rnd(F.try_divide((F.col("raw_rows") - F.col("after_box")) * 100.0,
                         F.col("raw_rows")), 4).alias("removed_pct"),
        "sum_km",
    )
