"""Calendar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import RUSH_HOURS, WEEKEND_FIRST_DAY


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_instant(ts) -> Column:
    """Timestamp (session zone) from either TIMESTAMP or TIMESTAMP_NTZ input."""
    return _c(ts).cast("timestamp")


def epoch_micros(ts) -> Column:
    return F.unix_micros(as_instant(ts))


def hour(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def day_of_week(ts) -> Column:
    """0 = Monday ... 6 = Sunday (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(ts)).cast("int")


def month(ts) -> Column:
    return F.month(_c(ts)).cast("int")


def is_weekend(dow) -> Column:
    return (_c(dow) >= WEEKEND_FIRST_DAY).cast("int")


def is_rush_hour(hr) -> Column:
    return _c(hr).isin(RUSH_HOURS).cast("int")


def time_feature_columns(ts) -> dict[str, Column]:
    """The five calendar features, each computed straight from the timestamp."""
    hr = hour(ts)
    dow = day_of_week(ts)
    return {
        "hour": hr,
        "day_of_week": dow,
        "month": month(ts),
        "is_weekend": is_weekend(dow),
        "is_rush_hour": is_rush_hour(hr),
    }
