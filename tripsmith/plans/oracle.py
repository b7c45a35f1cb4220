"""Shared SQL text for the DuckDB oracles (independent re-statements of each
operator's semantics over the same driver tables)."""

from __future__ import annotations

from ..functions.numeric import rnd_sql

TRIP_VIEW_SQL = """
select cast(event_id as string) as id,
  cast(1 + user_id % 2 as int) as vendor_id,
  date_trunc('second', ts) as pickup_datetime,
  cast(user_id % 7 as int) as passenger_count,
  case when event_id % 997 = 5 then 0e0 else -74.02e0 + (event_id * 53 % 1000) / 1e4 end as pickup_longitude,
  case when event_id % 997 = 5 then 0e0 when event_id % 331 = 7 then 39e0
       else 40.6e0 + (event_id * 37 % 1000) * 3 / 1e4 end as pickup_latitude,
  -74.02e0 + (event_id * 53 % 1000) / 1e4
    + case when event_id % 101 = 3 then 0e0 else (event_id * 17 % 100) / 1e4 end as dropoff_longitude,
  40.6e0 + (event_id * 37 % 1000) * 3 / 1e4
    + case when event_id % 101 = 3 then 0e0 else (1 - 2 * (event_id % 2)) * value / 3e3 * (0.6e0 + (event_id * 104729 % 1000) / 1250e0) end as dropoff_latitude,
  case when event_id % 50 = 0 then 'Y' else 'N' end as store_and_fwd_flag,
  cast(floor(value * 20 * (0.75e0 + (event_id * 7919 % 1000) / 2e3)
    + case when hour(ts) in (7, 8, 9, 17, 18, 19) then 90 else 0 end
    + (user_id % 2) * 12 + (user_id % 7) * 3) as int) as trip_duration
from events
"""

HAVERSINE_SQL = (
    "6371e0*2*asin(sqrt(pow(sin((radians(dropoff_latitude)-radians(pickup_latitude))/2),2)"
    "+cos(radians(pickup_latitude))*cos(radians(dropoff_latitude))"
    "*pow(sin((radians(dropoff_longitude)-radians(pickup_longitude))/2),2)))")

DURATION_OK = "trip_duration > 60 and trip_duration < 7200"
DISTANCE_OK = "distance_km > 0.1e0"
PASSENGERS_OK = "passenger_count > 0"
BOX_OK = ("pickup_latitude between 40.4e0 and 41.0e0 and pickup_longitude between -74.5e0 and -73.5e0"
          " and dropoff_latitude between 40.4e0 and 41.0e0 and dropoff_longitude between -74.5e0 and -73.5e0")

TIME_FEATURES_SQL = """cast(hour(pickup_datetime) as int) as hour,
  cast(isodow(pickup_datetime) - 1 as int) as day_of_week,
  cast(month(pickup_datetime) as int) as month,
  cast(isodow(pickup_datetime) - 1 >= 5 as int) as is_weekend,
  cast(hour(pickup_datetime) in (7, 8, 9, 17, 18, 19) as int) as is_rush_hour"""

PROCESSED_COLS = ("id, hour, day_of_week, month, is_weekend, is_rush_hour, distance_km, passenger_count,"
                  " pickup_latitude, pickup_longitude, dropoff_latitude, dropoff_longitude, vendor_id,"
                  " trip_duration, pickup_datetime")


def ctes(*extra: str, profile: str = "full") -> str:
    """``with`` clause: trips (raw), trips_d (+distance), clean (processed), then extras."""
    where = f"{DURATION_OK} and {DISTANCE_OK} and {PASSENGERS_OK}"
    if profile == "full":
        where += f" and {BOX_OK}"
    parts = [
        f"trips0 as ({TRIP_VIEW_SQL})",
        "trips as (select *, pickup_datetime + to_seconds(trip_duration) as dropoff_datetime from trips0)",
        f"trips_d as (select *, {HAVERSINE_SQL} as distance_km from trips)",
        f"clean as (select {PROCESSED_COLS} from (select *, {TIME_FEATURES_SQL} from trips_d) t"
        f" where {where})",
    ]
    parts.extend(extra)
    return "with " + ",\n".join(parts) + "\n"


def date_split_sql(src: str, train_end: str, gap_end: str, val_end: str, name: str = "split") -> str:
    return (f"{name} as (select *, case when pickup_datetime <= timestamp '{train_end}' then 'train'"
            f" when pickup_datetime <= timestamp '{gap_end}' then 'gap'"
            f" when pickup_datetime <= timestamp '{val_end}' then 'val' else 'test' end as split"
            f" from {src})")


def five_metrics_sql(src: str, actual: str = "trip_duration", pred: str = "prediction",
                     by: str = "", digits: int = 2) -> str:
    """Select list + from + group by for the five metrics over ``src``."""
    e = f"(cast({actual} as double) - {pred})"
    sel = [
        f"count(*) as rows",
        f"count(*) filter (where {actual} = 0) as zero_actuals",
        f"{rnd_sql(f'sqrt(avg({e}*{e}))', digits)} as rmse_seconds",
        f"{rnd_sql(f'avg(abs({e}) / nullif(cast({actual} as double), 0)) * 100', digits)} as mape_pct",
        f"{rnd_sql(f'avg({e})', digits)} as mean_error_seconds",
        f"{rnd_sql(f'quantile_cont(abs({e}), 0.95)', digits)} as p95_error_seconds",
        f"{rnd_sql(f'1 - sum({e}*{e}) / nullif(var_pop(cast({actual} as double)) * count(*), 0)', 4)} as r2",
    ]
    head = f"{by}, " if by else ""
    tail = f" group by {by}" if by else ""
    return f"select {head}{', '.join(sel)} from {src}{tail}"
