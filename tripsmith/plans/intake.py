"""Registered queries of malformed input, contract checks, as-of retrieval and the exact demand stream."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean as CL
from ..operators import gates as G
from ..operators import store as ST
from ..sources import sinks as SK
from ..sources import tables as TB
from ..sources.registry import unknown_features
from ..streaming import demand as D
from ..streaming import trips as STR
from . import oracle as O
from .catalog import _ARRIVAL, query, scratch

# -- A1, A2: lines that do not fit -----------------------------------------------------------------
#: Faults planted by id: fields cut off, one too many, a quote that is never closed; and a quoted comma, which fits.
_PLANTED = {1: "too few fields", 2: "too many fields", 3: "unclosed quote"}
_COMMA_IN_QUOTES = 4
_LINE = ("concat_ws(',', id, vendor_id, date_format(pickup_datetime, 'yyyy-MM-dd HH:mm:ss'), date_format(dropoff_datetime, 'yyyy-MM-dd HH:mm:ss'),"
         " passenger_count, pickup_longitude, pickup_latitude, dropoff_longitude, dropoff_latitude, store_and_fwd_flag, trip_duration)")


def _write_lines(spark, sf, path):
    """Raw trips as CSV files with planted faults, a header in each file."""
    line, kind = F.expr(_LINE), F.col("id").cast("long") % 97
    lines = TB.trips(spark, sf).select(
        F.when(kind == 1, F.substring_index(line, ",", 9)).when(kind == 2, F.concat(line, F.lit(",more")))
        .when(kind == 3, F.regexp_replace(line, ",([YN]),", ',"$1,')).when(kind == _COMMA_IN_QUOTES, F.regexp_replace(line, ",([YN]),", ',"$1, it is",'))
        .otherwise(line).alias("value"))
    header = ",".join(C.RAW_COLUMNS)

    def with_header(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch({"value": pa.array([header])})
        for batch in batches:
            yield pa.record_batch({"value": batch.column("value")})
    lines.mapInArrow(with_header, "value string").write.text(path)


@query("csv_corrupt_lines", O.ctes() + "select " + "case " + " ".join(f"when cast(id as bigint) % 97 = {k} then '{v}'" for k, v in _PLANTED.items()) +
       " else 'fits' end as fault, count(*) as lines, cast(sum(cast(id as bigint)) as bigint) as id_sum,"
       " cast(sum(case when cast(id as bigint) % 97 not in (1, 2, 3) then trip_duration end) as bigint) as duration_sum from trips group by 1")
def q_csv_corrupt_lines(spark, sf):
    """A1, A2: every line is either typed or kept apart with its fault; none is lost."""
    path, apart = SK.scratch_path(spark, "lines"), SK.scratch_path(spark, "quarantine")
    _write_lines(spark, sf, path)
    good, bad = TB.split_corrupt(TB.read_csv_lines(spark, path))
    SK.quarantine(bad, apart)
    kept = spark.read.schema(bad.schema).parquet(apart)
    ident = F.regexp_extract("_line", "^[0-9]+", 0).cast("long")
    rows = TB.typed_rows(good).select(F.lit("fits").alias("fault"), F.col("id").cast("long").alias("id"), "trip_duration")
    return rows.unionByName(kept.select(F.col("_fault").alias("fault"), ident.alias("id"), F.lit(None).cast("int").alias("trip_duration"))) \
        .groupBy("fault").agg(F.count(F.lit(1)).alias("lines"), F.sum("id").alias("id_sum"), F.sum("trip_duration").alias("duration_sum"))


# -- B1, H1, D3, L2: contract checks -----------------------------------------------------------------
@query("required_columns", O.ctes() + "select 'events' as source, unnest(['dropoff_datetime', 'dropoff_latitude', 'dropoff_longitude', 'id',"
       " 'passenger_count', 'pickup_datetime', 'pickup_latitude', 'pickup_longitude', 'store_and_fwd_flag', 'trip_duration', 'vendor_id']) as missing,"
       " (select count(*) from events) as rows union all select 'trips', unnest(['store_and_fwd_flag', 'vendor_id']), (select count(*) from trips)")
def q_required_columns(spark, sf):
    """B1, H1: what the raw contract asks for and a source lacks, with the rows that the gate would stop."""
    sources = {"events": TB.table(spark, sf, "events"), "trips": TB.trips(spark, sf).drop("vendor_id", "store_and_fwd_flag"), "whole": TB.trips(spark, sf)}
    out = None
    for name, df in sources.items():
        gone = F.array(*[F.lit(c) for c in G.missing_columns(df)]).cast("array<string>")
        part = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("source"), F.explode(gone).alias("missing"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


_ASKED = [*C.FEATURES, "weather", "driver_id", "surge"]


@query("unknown_requests", "with r as (select case event_id % 15 " + " ".join(f"when {i} then '{f}'" for i, f in enumerate(_ASKED)) +
       " end as feature from events) select feature, count(*) as requests from r where feature in ('weather', 'driver_id', 'surge') group by 1")
def q_unknown_requests(spark, sf):
    """D3, L2: requests for features that the registry does not know, counted over a log of requests."""
    asked = F.get(F.array(*[F.lit(f) for f in _ASKED]), (F.col("event_id") % len(_ASKED)).cast("int"))
    log = TB.table(spark, sf, "events").select(asked.alias("feature"))
    unknown = unknown_features(spark, log)
    return unknown.groupBy("feature").agg(F.count(F.lit(1)).alias("requests"))


# -- L3, L6: as-of retrieval ---------------------------------------------------------------------------
_TTL_HOURS = 6


@query("as_of_features", f"""
with v as (select user_id, ts, max(value) as value from events where event_id % 4 <> 0 group by user_id, ts),
r as (select event_id, user_id, ts from events where event_id % 4 = 0)
select event_id, case when r.ts - v.ts <= interval {_TTL_HOURS} hour then epoch_us(v.ts) end as feature_us,
  case when r.ts - v.ts <= interval {_TTL_HOURS} hour then value end as value
from r asof left join v on r.user_id = v.user_id and r.ts >= v.ts""")
def q_as_of_features(spark, sf):
    """Each request gets its user's latest value, unless it is older than the time to live."""
    events = TB.table(spark, sf, "events")
    view = events.where("event_id % 4 <> 0").select("user_id", "ts", "value")
    requests = events.where("event_id % 4 = 0").select("event_id", "user_id", "ts")
    found = ST.as_of_features(requests, view, "user_id", ["value"], "ts", "ts", _TTL_HOURS * 3600)
    return found.select("event_id", F.unix_micros(F.col("feature_ts").cast("timestamp")).alias("feature_us"), "value")


@query("historical_as_of", O.ctes(
    "known as (select * from clean where pickup_datetime <= timestamp '2024-01-22' and pickup_datetime >= timestamp '2024-01-22' - interval 14 day)",
    "pit as (select *, cast(count(trip_duration) over (order by epoch_us(pickup_datetime) range between 3600000000 preceding and 1 preceding)"
    " as bigint) as n1, row_number() over (order by pickup_datetime, id) - 1 as rk, count(*) over () as n from known)") +
       "select case when rk < floor(n * 0.75e0) then 'train' when rk < floor(n * 0.8e0) then 'gap' else 'val' end as split,"
       " count(*) as rows, cast(sum(n1) as bigint) as sum_trip_count from pit group by 1")
def q_historical_as_of(spark, sf):
    """The training frame as it was known at a time, without rows beyond the time to live."""
    df, _, _ = ST.get_historical_features(CL.processed(TB.trips(spark, sf), "full"), as_of="2024-01-22", ttl_days=14)
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.sum("trip_count_last_1h").alias("sum_trip_count"))


# -- N3: exact per-row demand on a stream ---------------------------------------------------------------
_ON_TIME = "not (part = 5 and pickup_datetime < timestamp '2024-01-08')"


@query("stream_demand_exact", O.ctes(
    f"arr as (select *, {_ARRIVAL} as part from clean)", f"live as (select * from arr where {_ON_TIME})",
    "f1 as (select id, pickup_datetime, cast(count(trip_duration) over (order by epoch_us(pickup_datetime)"
    " range between 3600000000 preceding and 1 preceding) as bigint) as trip_count_last_1h from live)") +
       "select id, trip_count_last_1h from f1 where (epoch_us(pickup_datetime) // 3600000000 + 1) * 3600000000"
       " <= (select max(epoch_us(pickup_datetime)) from live) - 7200000000")
def q_stream_demand_exact(spark, sf):
    """The exact hourly count of every row that is not late, in goes from one checkpoint; equals F1
    row for row.  Rows of hours that the watermark has not passed when the feed ends are still open."""
    path = STR.replay(TB.table(spark, sf, "events"), scratch(spark, "stream_demand_exact"),
                      lambda s: D.exact_demand(STR.stream_features(STR.trip_stream(s()))), D.run_exact)
    return spark.read.parquet(path).select(C.KEY_COL, "trip_count_last_1h")
