"""Feature registry as DataFrames."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTRY_PATH = os.path.join(os.path.dirname(os.path.abspath(__file__)), "registry.json")


def load_registry(spark: SparkSession, path: str = REGISTRY_PATH) -> DataFrame:
    """The registry document as one row (nested structs / arrays)."""
    return spark.read.option("multiLine", True).json(path)


def registry_features(spark: SparkSession, path: str = REGISTRY_PATH) -> DataFrame:
    """L1 / K4: one row per feature: view, feature, dtype, availability, risk, ttl."""
    reg = load_registry(spark, path)
    v = reg.select(F.explode("feature_views").alias("v"))
    f = v.select(F.col("v.name").alias("view"), F.col("v.ttl_days").alias("ttl_days"),
                 F.col("v.timestamp_column").alias("timestamp_column"),
                 F.explode("v.features").alias("f"))
    return f.select("view", F.col("f.name").alias("feature"), F.col("f.dtype").alias("dtype"),
                    F.col("f.available_at_inference").alias("available_at_inference"),
                    F.col("f.leakage_risk").alias("leakage_risk"), "ttl_days", "timestamp_column")


def service_features(spark: SparkSession, service: str, path: str = REGISTRY_PATH) -> DataFrame:
    """Features served by a feature service (service -> views -> features)."""
    reg = load_registry(spark, path)
    views = reg.select(F.explode("feature_services").alias("s")).where(
        F.col("s.name") == service).select(F.explode("s.feature_views").alias("view"))
    return registry_features(spark, path).join(views, "view", "left_semi")


def unknown_features(spark: SparkSession, requested: Sequence[str] | DataFrame,
                     path: str = REGISTRY_PATH) -> DataFrame:
    """D3 / L2: requested names (a list, or rows with a ``feature`` column) absent from the registry (anti join)."""
    req = requested if isinstance(requested, DataFrame) else spark.createDataFrame([(r,) for r in requested], "feature string")
    known = registry_features(spark, path).select("feature").distinct()
    return req.join(F.broadcast(known), "feature", "left_anti")  # the registry is a document, its features few


def validate_feature_request(spark: SparkSession, requested: Sequence[str],
                             path: str = REGISTRY_PATH) -> None:
    bad = [r.feature for r in unknown_features(spark, requested, path).collect()]
    if bad:
        raise ValueError(f"unknown features: {sorted(bad)}")
