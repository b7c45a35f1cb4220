"""Spatial column expressions (JVM-side, codegen-friendly; no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EARTH_RADIUS_KM


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2, clamp: bool = False) -> Column:
    """Great-circle distance in km between two points given in degrees.

    ``clamp=True`` bounds the inner term at 1 so rounding can never push
    ``asin`` outside its domain; the default keeps the unclamped formula.
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    if clamp:
        a = F.least(a, F.lit(1.0))
    return F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(a))


def in_box(lat, lon, lat_bounds, lon_bounds) -> Column:
    """Inclusive bounding-box predicate (plain comparisons so Parquet can push them)."""
    return (_c(lat).between(*lat_bounds)) & (_c(lon).between(*lon_bounds))
