"""Registered queries: one Spark plan per operator of SURVEY section 2 and,
where the operator is SQL-expressible, an independent DuckDB oracle.

Every query reads the driver tables under ``sf_dir`` (mostly the trip view
over ``events``) and runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import rnd, rnd_sql
from ..operators import clean as CL
from ..operators import metrics as M
from ..operators import models as MD
from ..operators.splits import Fold, date_split
from ..session import checkpoint_dir
from ..sources.tables import trips
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed split dates for the trip view (events cover 2024-01-01 .. 2024-01-30)
TRAIN_END, GAP_END, VAL_END = "2024-01-20", "2024-01-22", "2024-01-27"
FOLDS = [Fold("fold_1", "2024-01-08", "2024-01-09", "2024-01-15"),
         Fold("fold_2", "2024-01-15", "2024-01-16", "2024-01-22"),
         Fold("fold_3", "2024-01-22", "2024-01-23", "2024-01-29")]


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# -- shared plan fragments ------------------------------------------------------------
def processed_full(spark, sf):
    return CL.processed(trips(spark, sf), "full")


def split_full(spark, sf):
    return date_split(processed_full(spark, sf), TRAIN_END, GAP_END, VAL_END)


def lookup_scored(spark, sf, part="val"):
    s = split_full(spark, sf)
    return MD.lookup_baseline(s.where(F.col("split") == "train"), s.where(F.col("split") == part))


SPLIT_CTE = O.date_split_sql("clean", TRAIN_END, GAP_END, VAL_END)
LOOKUP_CTES = [
    SPLIT_CTE,
    "lookup as (select hour, day_of_week, "
    f"{rnd_sql('avg(cast(trip_duration as double))', 2)} as predicted_duration, count(*) as train_rows"
    " from split where split = 'train' group by hour, day_of_week)",
    "gm as (select avg(cast(trip_duration as double)) as global_mean from split where split = 'train')",
    "scored as (select s.*, coalesce(l.predicted_duration, gm.global_mean) as prediction,"
    " l.predicted_duration is null as is_fallback"
    " from split s left join lookup l on s.hour = l.hour and s.day_of_week = l.day_of_week"
    " cross join gm where s.split = 'val')",
]


# -- C: scalar features, cleaning -----------------------------------------------------
@query("haversine_km", O.ctes() + f"select id, {rnd_sql('distance_km', 6)} as distance_km from trips_d")
def q_haversine(spark, sf):
    return CL.with_distance(trips(spark, sf)).select("id", rnd("distance_km", 6).alias("distance_km"))


@query("time_features", O.ctes() + "select id, hour, day_of_week, month, is_weekend, is_rush_hour"
       " from (select id, " + O.TIME_FEATURES_SQL + " from trips) t")
def q_time_features(spark, sf):
    return CL.with_time_columns(trips(spark, sf)).select(
        "id", "hour", "day_of_week", "month", "is_weekend", "is_rush_hour")


@query("clean_funnel", O.ctes() + f"""
select count(*) as raw_rows,
  count(*) filter (where {O.DURATION_OK}) as after_duration,
  count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK}) as after_distance,
  count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK}) as after_passengers,
  count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK} and {O.BOX_OK}) as after_box,
  count(*) - count(*) filter (where {O.DURATION_OK}) as removed_duration,
  count(*) filter (where {O.DURATION_OK}) - count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK}) as removed_distance,
  count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK}) - count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK}) as removed_passengers,
  count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK}) - count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK} and {O.BOX_OK}) as removed_box,
  count(*) - count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK} and {O.BOX_OK}) as removed_total,
  {rnd_sql(f"(count(*) - count(*) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK} and {O.BOX_OK})) * 100.0e0 / count(*)", 4)} as removed_pct,
  {rnd_sql(f"sum(distance_km) filter (where {O.DURATION_OK} and {O.DISTANCE_OK} and {O.PASSENGERS_OK} and {O.BOX_OK})", 4)} as sum_km
from trips_d""")
def q_clean_funnel(spark, sf):
    return CL.clean_funnel(trips(spark, sf))


_PROCESSED_OUT = ("id, hour, day_of_week, month, is_weekend, is_rush_hour, "
                  f"{rnd_sql('distance_km', 6)} as distance_km, passenger_count, vendor_id, trip_duration,"
                  " strftime(pickup_datetime, '%Y-%m-%d %H:%M:%S') as pickup_ts")


def _processed_out(df):
    return df.select("id", "hour", "day_of_week", "month", "is_weekend", "is_rush_hour",
                     rnd("distance_km", 6).alias("distance_km"), "passenger_count", "vendor_id",
                     "trip_duration",
                     F.date_format("pickup_datetime", "yyyy-MM-dd HH:mm:ss").alias("pickup_ts"))


@query("clean_full", O.ctes() + f"select {_PROCESSED_OUT} from clean")
def q_clean_full(spark, sf):
    return _processed_out(processed_full(spark, sf))


@query("clean_model", O.ctes(profile="model") + f"select {_PROCESSED_OUT} from clean")
def q_clean_model(spark, sf):
    return _processed_out(CL.load_and_engineer(trips(spark, sf)))


# -- E2 / D1 / E4: lookup baseline scored with five metrics (flagship) ------------------
@query("baseline_lookup", O.ctes(*LOOKUP_CTES[:2]) + "select * from lookup")
def q_baseline_lookup(spark, sf):
    s = split_full(spark, sf)
    return MD.fit_lookup(s.where(F.col("split") == "train"))


@query("baseline_predict", O.ctes(*LOOKUP_CTES) +
       f"select id, {rnd_sql('prediction', 4)} as prediction, is_fallback from scored")
def q_baseline_predict(spark, sf):
    return lookup_scored(spark, sf).select("id", rnd("prediction", 4).alias("prediction"),
                                           "is_fallback")


@query("baseline_fallback_rate", O.ctes(
    SPLIT_CTE, "early as (select hour, day_of_week, count(*) as n from split where split = 'train' and hour < 20"
    " and not (day_of_week = 6 and hour < 4) group by 1, 2)",
    "fb as (select e.n is null as is_fallback from split s left join early e using (hour, day_of_week) where split = 'val')") +
       "select count(*) as rows, count(*) filter (where is_fallback) as fallback_rows,"
       f" {rnd_sql('(count(*) filter (where is_fallback)) / count(*)', 6)} as fallback_rate from fb")
def q_fallback(spark, sf):
    """D1's fallback: cells that training never saw (late hours, the small hours of Sunday)."""
    s = split_full(spark, sf)
    seen = (F.col("hour") < 20) & ~((F.col("day_of_week") == 6) & (F.col("hour") < 4))
    return MD.fallback_rate(MD.lookup_baseline(s.where((F.col("split") == "train") & seen), s.where(F.col("split") == "val")))


@query("five_metrics", O.ctes(*LOOKUP_CTES) + O.five_metrics_sql("scored").replace(
    "select ", "select 'lookup_baseline' as model, ", 1))
def q_five_metrics(spark, sf):
    m = M.five_metrics(lookup_scored(spark, sf), C.TARGET, "prediction")
    return m.select(F.lit("lookup_baseline").alias("model"), *m.columns)


# -- F: point-in-time features -------------------------------------------------------------
from ..operators import pit as PIT  # noqa: E402
from ..operators import splits as SP  # noqa: E402
from ..operators.ordering import exact_percentile  # noqa: E402

_F1_SQL = ("cast(count(trip_duration) over (order by epoch_us(pickup_datetime)"
           " range between 3600000000 preceding and 1 preceding) as bigint)")
_F2_CTES = [
    "daily as (select cast(pickup_datetime as date) as d, cast(hour(pickup_datetime) as int) as h,"
    " avg(cast(trip_duration as double)) as m, count(*) as n from clean group by 1, 2)",
    "lagged as (select d, h, avg(m) over (partition by h order by d rows between 7 preceding"
    " and 1 preceding) as a from daily)",
    "g as (select avg(cast(trip_duration as double)) as gm from clean)",
    "f2 as (select c.*, coalesce(l.a, g.gm) as avg_duration_same_hour_last7days from clean c"
    " left join lagged l on cast(c.pickup_datetime as date) = l.d and hour(c.pickup_datetime) = l.h"
    " cross join g)",
]


@query("rolling_count_1h", O.ctes() + f"select id, {_F1_SQL} as trip_count_last_1h from clean")
def q_rolling_count(spark, sf):
    return PIT.rolling_count(processed_full(spark, sf)).select("id", "trip_count_last_1h")


@query("rolling_count_1h_halo", O.ctes() + f"select id, {_F1_SQL} as trip_count_last_1h from clean")
def q_rolling_count_halo(spark, sf):
    return PIT.rolling_count(processed_full(spark, sf), method="halo").select(
        "id", "trip_count_last_1h")


@query("daily_hour_mean", O.ctes(_F2_CTES[0]) +
       f"select strftime(d, '%Y-%m-%d') as date, h as hour, {rnd_sql('m', 6)} as daily_hour_mean,"
       " n as rows from daily")
def q_daily_hour_mean(spark, sf):
    d = PIT.daily_hour_mean(processed_full(spark, sf))
    return d.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "hour",
                    rnd("daily_hour_mean", 6).alias("daily_hour_mean"), "rows")


@query("avg_same_hour_7d", O.ctes(*_F2_CTES) +
       f"select id, {rnd_sql('avg_duration_same_hour_last7days', 6)} as avg_duration_same_hour_last7days"
       " from f2")
def q_avg_same_hour(spark, sf):
    return PIT.avg_same_hour(processed_full(spark, sf)).select(
        "id", rnd("avg_duration_same_hour_last7days", 6).alias("avg_duration_same_hour_last7days"))


@query("pit_features", O.ctes(*_F2_CTES, f"pit as (select *, {_F1_SQL} as trip_count_last_1h from f2)") +
       f"select {rnd_sql('avg(trip_count_last_1h)', 4)} as mean_trip_count_last_1h,"
       " max(trip_count_last_1h) as max_trip_count_last_1h,"
       f" {rnd_sql('avg(avg_duration_same_hour_last7days)', 4)} as mean_avg_duration_7d,"
       f" {rnd_sql('max(avg_duration_same_hour_last7days)', 4)} as max_avg_duration_7d from pit")
def q_pit_features(spark, sf):
    return PIT.feature_profile(PIT.point_in_time_features(processed_full(spark, sf)))


@query("pit_violations", O.ctes() + "select count(*) as rows_checked,"
       " count(*) filter (where cast(id as bigint) % 97 = 3) as violations from clean")
def q_pit_violations(spark, sf):
    """D6 over every row, with an error planted in some of them: all are found, nothing else."""
    df = PIT.rolling_count(processed_full(spark, sf))
    wrong = F.when(F.col("id").cast("long") % 97 == 3, 1).otherwise(0)
    return PIT.pit_violations(df.withColumn("trip_count_last_1h", F.col("trip_count_last_1h") + wrong))


# -- F4 / I: ordering and splits -------------------------------------------------------------
@query("time_rank", O.ctes(profile="model") +
       "select id, row_number() over (order by pickup_datetime, id) - 1 as time_rank from clean")
def q_time_rank(spark, sf):
    m = CL.load_and_engineer(trips(spark, sf))
    return SP.time_rank(m).select("id", "time_rank")


@query("temporal_split", O.ctes(
    "r as (select id, row_number() over (order by pickup_datetime, id) - 1 as rk,"
    " count(*) over () as n from clean)", profile="model") +
    "select id, case when rk < floor(n * 0.75e0) then 'train' when rk < floor(n * 0.8e0) then 'gap'"
    " else 'val' end as split from r")
def q_temporal_split(spark, sf):
    m = CL.load_and_engineer(trips(spark, sf))
    return SP.temporal_split(m).select("id", "split")


@query("date_split", O.ctes(SPLIT_CTE) + "select id, split from split")
def q_date_split(spark, sf):
    return split_full(spark, sf).select("id", "split")


@query("split_profile", O.ctes(SPLIT_CTE) +
       "select split, count(*) as rows, strftime(min(pickup_datetime), '%Y-%m-%d %H:%M:%S') as min_ts,"
       " strftime(max(pickup_datetime), '%Y-%m-%d %H:%M:%S') as max_ts from split group by split")
def q_split_profile(spark, sf):
    return M.split_profile(split_full(spark, sf))


_FOLDS_SQL = "folds(fold, train_end, gap_end, val_end) as (values " + ", ".join(
    f"('{f.name}', timestamp '{f.train_end}', timestamp '{f.gap_end}', timestamp '{f.val_end}')"
    for f in FOLDS) + ")"
_ASSIGN_SQL = ("assigned as (select c.*, f.fold, case when c.pickup_datetime <= f.train_end then 'train'"
               " else 'val' end as role from clean c join folds f on c.pickup_datetime <= f.train_end"
               " or (c.pickup_datetime > f.gap_end and c.pickup_datetime <= f.val_end))")


@query("fold_assignment", O.ctes(_FOLDS_SQL, _ASSIGN_SQL) +
       "select fold, role, count(*) as rows, strftime(min(pickup_datetime), '%Y-%m-%d %H:%M:%S') as min_ts,"
       " strftime(max(pickup_datetime), '%Y-%m-%d %H:%M:%S') as max_ts from assigned group by fold, role")
def q_fold_assignment(spark, sf):
    a = SP.assign_folds(processed_full(spark, sf), FOLDS)
    return a.groupBy("fold", "role").agg(
        F.count(F.lit(1)).alias("rows"),
        F.date_format(F.min("pickup_datetime"), "yyyy-MM-dd HH:mm:ss").alias("min_ts"),
        F.date_format(F.max("pickup_datetime"), "yyyy-MM-dd HH:mm:ss").alias("max_ts"))


def _leak_sql(src: str, pairs, group: str | None) -> str:
    g = f"{group}, " if group else ""
    parts = []
    for a, b in pairs:
        on = f" using ({group})" if group else " on true"
        parts.append(
            f"select {('x.' + group + ', ') if group else ''}'{a}<{b}' as \"check\","
            " strftime(x.mx, '%Y-%m-%d %H:%M:%S') as earlier_max,"
            " strftime(y.mn, '%Y-%m-%d %H:%M:%S') as later_min,"
            " coalesce(not (y.mn > x.mx), true) as violated"
            f" from (select {g}max(pickup_datetime) as mx from {src} where split = '{a}'"
            f"{' group by ' + group if group else ''}) x"
            f" full join (select {g}min(pickup_datetime) as mn from {src} where split = '{b}'"
            f"{' group by ' + group if group else ''}) y{on}")
    return " union all ".join(parts)


@query("leakage_check", O.ctes(SPLIT_CTE) + _leak_sql("split", [("train", "val"), ("val", "test")], None))
def q_leakage_check(spark, sf):
    return SP.leakage_check(split_full(spark, sf))


@query("fold_leakage", O.ctes(_FOLDS_SQL, _ASSIGN_SQL,
                              "fa as (select *, role as split from assigned)") +
       _leak_sql("fa", [("train", "val")], "fold"))
def q_fold_leakage(spark, sf):
    a = SP.assign_folds(processed_full(spark, sf), FOLDS)
    return SP.leakage_check(a, group="fold", split_col="role", order=("train", "val"))


# -- J10 / E8: walk-forward with the lookup model (one job for all folds) ----------------------
_WF_CTES = [
    _FOLDS_SQL, _ASSIGN_SQL,
    "wl as (select fold, hour, day_of_week,"
    f" {rnd_sql('avg(cast(trip_duration as double))', 2)} as predicted_duration"
    " from assigned where role = 'train' group by fold, hour, day_of_week)",
    "wg as (select fold, avg(cast(trip_duration as double)) as global_mean from assigned"
    " where role = 'train' group by fold)",
    "wscored as (select a.*, coalesce(l.predicted_duration, g.global_mean) as prediction"
    " from assigned a left join wl l on a.fold = l.fold and a.hour = l.hour"
    " and a.day_of_week = l.day_of_week join wg g on a.fold = g.fold where a.role = 'val')",
    "wcounts as (select fold, count(*) filter (where role = 'train') as train_rows,"
    " count(*) filter (where role = 'val') as val_rows from assigned group by fold)",
]
_WF_SQL = ("wm as (" + O.five_metrics_sql("wscored", by="fold") + ")")


@query("walk_forward_baseline", O.ctes(*_WF_CTES, _WF_SQL) +
       "select wm.fold, zero_actuals, rmse_seconds, mape_pct, mean_error_seconds, p95_error_seconds, r2,"
       " train_rows, val_rows from wm join wcounts using (fold)")
def q_walk_forward(spark, sf):
    return MD.walk_forward_lookup(processed_full(spark, sf), FOLDS)


@query("fold_summary", O.ctes(*_WF_CTES, _WF_SQL) +
       f"select count(*) as folds, {rnd_sql('avg(rmse_seconds)', 2)} as mean_rmse,"
       f" {rnd_sql('stddev_samp(rmse_seconds)', 2)} as std_rmse, {rnd_sql('min(rmse_seconds)', 2)} as min_rmse,"
       f" {rnd_sql('max(rmse_seconds)', 2)} as max_rmse,"
       f" {rnd_sql('stddev_samp(rmse_seconds) / avg(rmse_seconds)', 4)} as cv,"
       " case when stddev_samp(rmse_seconds) / avg(rmse_seconds) < 0.05e0 then 'STABLE'"
       " when stddev_samp(rmse_seconds) / avg(rmse_seconds) < 0.15e0 then 'MODERATE' else 'VOLATILE' end"
       " as stability from wm")
def q_fold_summary(spark, sf):
    return M.fold_summary(MD.walk_forward_lookup(processed_full(spark, sf), FOLDS))


# -- E5-E10, E21, E22, J6: metric family ----------------------------------------------------
from ..operators import calibration as CA  # noqa: E402


def train_val(spark, sf):
    s = split_full(spark, sf)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "val")


def spike_thr(train):
    return M.spike_threshold(train)


THR_CTE = "thr as (select quantile_cont(trip_duration, 0.95) as spike_threshold from split where split = 'train')"
TSCORED_CTE = ("tscored as (select s.*, coalesce(l.predicted_duration, gm.global_mean) as prediction"
               " from split s left join lookup l on s.hour = l.hour and s.day_of_week = l.day_of_week"
               " cross join gm where s.split = 'train')")
LIN_CTES = [
    "coef as (select regr_slope(cast(trip_duration as double), distance_km) as slope,"
    " regr_intercept(cast(trip_duration as double), distance_km) as intercept from split where split = 'train')",
    "lscored as (select s.*, greatest(intercept + slope * distance_km, 60e0) as prediction"
    " from split s cross join coef where s.split = 'val')",
]


@query("spike_threshold", O.ctes(SPLIT_CTE, THR_CTE) +
       f"select {rnd_sql('spike_threshold', 6)} as spike_threshold from thr")
def q_spike_threshold(spark, sf):
    tr, _ = train_val(spark, sf)
    return spike_thr(tr).select(rnd("spike_threshold", 6).alias("spike_threshold"))


@query("weight_share", O.ctes(SPLIT_CTE, THR_CTE) +
       "select count(*) filter (where trip_duration > spike_threshold) as spike_rows,"
       " count(*) filter (where trip_duration <= spike_threshold) as normal_rows,"
       " sum(case when trip_duration > spike_threshold then 5.0e0 else 1.0e0 end) as total_weight,"
       f" {rnd_sql('(count(*) filter (where trip_duration > spike_threshold)) * 5.0e0 / ((count(*) filter (where trip_duration <= spike_threshold)) + (count(*) filter (where trip_duration > spike_threshold)) * 5.0e0)', 4)}"
       " as spike_weight_share from split cross join thr where split = 'train'")
def q_weight_share(spark, sf):
    tr, _ = train_val(spark, sf)
    return M.weight_share(M.sample_weights(tr, spike_thr(tr)))


def _slice_sql(src):
    e = "(cast(trip_duration as double) - prediction)"
    sl = "case when trip_duration > spike_threshold then 'spike' else 'normal' end"
    return (
        f"sl as (select {sl} as slice, count(*) as rows, {rnd_sql(f'sqrt(avg({e}*{e}))', 1)} as rmse_seconds,"
        f" {rnd_sql(f'avg({e})', 1)} as bias_seconds, {rnd_sql(f'quantile_cont(abs({e}), 0.95)', 1)} as p95_seconds"
        f" from {src} cross join thr group by 1)",
        "rt as (select max(rmse_seconds) filter (where slice = 'spike')"
        " / max(rmse_seconds) filter (where slice = 'normal') as x from sl)")


@query("slice_metrics", O.ctes(*LOOKUP_CTES, THR_CTE, *_slice_sql("scored")) +
       f"select slice, rows, rmse_seconds, bias_seconds, p95_seconds, {rnd_sql('x', 2)} as ratio,"
       " case when x < 2e0 then 'excellent' when x < 3e0 then 'good' when x < 4e0 then 'moderate'"
       " else 'poor' end as verdict from sl cross join rt")
def q_slice_metrics(spark, sf):
    tr, va = train_val(spark, sf)
    return M.slice_metrics(MD.lookup_baseline(tr, va), C.TARGET, "prediction", spike_thr(tr))


@query("overfit_gap", O.ctes(*LOOKUP_CTES, TSCORED_CTE,
                             "bothm as (select 'train' as split, * from (" + O.five_metrics_sql("tscored") +
                             ") union all select 'val', * from (" + O.five_metrics_sql("scored") + "))") +
       "select max(rmse_seconds) filter (where split = 'train') as train_rmse_seconds,"
       " max(rmse_seconds) filter (where split = 'val') as val_rmse_seconds,"
       f" {rnd_sql(chr(40) + 'max(rmse_seconds) filter (where split = ' + chr(39) + 'val' + chr(39) + ') - max(rmse_seconds) filter (where split = ' + chr(39) + 'train' + chr(39) + ')) * 100.0e0 / max(rmse_seconds) filter (where split = ' + chr(39) + 'train' + chr(39) + ')', 1)} as overfit_gap_pct,"
       " case when (max(rmse_seconds) filter (where split = 'val') / max(rmse_seconds) filter (where split = 'train')"
       " - 1) * 100e0 > 30e0 then 'severe overfit' when (max(rmse_seconds) filter (where split = 'val')"
       " / max(rmse_seconds) filter (where split = 'train') - 1) * 100e0 > 15e0 then 'mild overfit' else 'healthy' end"
       " as verdict from bothm")
def q_overfit_gap(spark, sf):
    tr, va = train_val(spark, sf)
    both = (MD.lookup_baseline(tr, tr).withColumn("split", F.lit("train"))
            .unionByName(MD.lookup_baseline(tr, va).withColumn("split", F.lit("val"))))
    return M.overfit_gap(M.five_metrics(both, C.TARGET, "prediction", by=["split"]))


def _two_models(spark, sf):
    """Lookup baseline and one-feature OLS, scored on the same validation rows
    and evaluated in one grouped pass."""
    tr, va = train_val(spark, sf)
    look = MD.lookup_baseline(tr, va).select("id", C.TARGET, "prediction")
    lin = MD.predict_linear_1d(va, MD.fit_linear_1d(tr)).select("id", C.TARGET, "prediction")
    both = (look.withColumn("model", F.lit("lookup_baseline"))
            .unionByName(lin.withColumn("model", F.lit("linear_1d"))))
    return M.five_metrics(both, C.TARGET, "prediction", by=["model"])


_TWO_MODELS_CTES = [*LOOKUP_CTES, *LIN_CTES,
                    "allm as (select 'lookup_baseline' as model, trip_duration, prediction from scored"
                    " union all select 'linear_1d', trip_duration, prediction from lscored)",
                    "mm as (" + O.five_metrics_sql("allm", by="model") + ")"]


@query("linear_1d", O.ctes(*LOOKUP_CTES, *LIN_CTES, "mm as (" + O.five_metrics_sql("lscored") + ")") +
       f"select {rnd_sql('slope', 6)} as slope, {rnd_sql('intercept', 4)} as intercept, mm.* from coef cross join mm")
def q_linear_1d(spark, sf):
    tr, va = train_val(spark, sf)
    coef = MD.fit_linear_1d(tr)
    m = M.five_metrics(MD.predict_linear_1d(va, coef), C.TARGET, "prediction")
    return coef.select(rnd("slope", 6).alias("slope"), rnd("intercept", 4).alias("intercept")) \
        .crossJoin(m)


_IMPROVED = "(b.rmse_seconds - m.rmse_seconds) * 100.0e0 / b.rmse_seconds"
_VS_LINEAR = "(l.rmse_seconds - m.rmse_seconds) * 100.0e0 / l.rmse_seconds"


@query("model_comparison", O.ctes(*_TWO_MODELS_CTES) +
       "select m.*, " + rnd_sql(_IMPROVED, 2) + " as improvement_vs_baseline_pct, "
       + rnd_sql(_VS_LINEAR, 2) + " as improvement_vs_reference_pct,"
       " case when abs(m.mean_error_seconds) < 10.0e0 then 'well-calibrated'"
       " when m.mean_error_seconds > 0 then 'under-predicts' else 'over-predicts' end as bias_reading, "
       + rnd_sql("m.p95_error_seconds / 60.0e0", 1) + " as p95_minutes,"
       f" case when {_IMPROVED} < 0e0 then 'worse' when {_IMPROVED} < 10e0 then 'weak'"
       f" when {_IMPROVED} < 25e0 then 'moderate' else 'strong' end as verdict_vs_baseline,"
       f" case when {_VS_LINEAR} < 5e0 then 'barely beats linear' when {_VS_LINEAR} < 20e0"
       " then 'moderate non-linearity' else 'strong non-linearity' end as verdict_vs_reference"
       " from mm m cross join (select rmse_seconds from mm where model = 'lookup_baseline') b"
       " cross join (select rmse_seconds from mm where model = 'linear_1d') l")
def q_model_comparison(spark, sf):
    return M.model_comparison(_two_models(spark, sf), "lookup_baseline", "linear_1d")


_METRIC_LIST = ["rmse_seconds", "mape_pct", "mean_error_seconds", "p95_error_seconds", "r2"]


@query("metric_deltas", O.ctes(*_TWO_MODELS_CTES,
                               "lng as (" + " union all ".join(
                                   f"select model, '{m}' as metric, cast({m} as double) as value from mm"
                                   for m in _METRIC_LIST) + ")") +
       "select a.metric, a.value as value_a, b.value as value_b, " + rnd_sql("b.value - a.value", 4) +
       " as delta, case when (case when a.metric = 'r2' then b.value > a.value"
       " when a.metric = 'mean_error_seconds' then abs(b.value) < abs(a.value) else b.value < a.value end)"
       " then 'better' when a.value = b.value then 'same' else 'worse' end as direction"
       " from lng a join lng b on a.metric = b.metric and a.model = 'lookup_baseline' and b.model = 'linear_1d'")
def q_metric_deltas(spark, sf):
    return M.metric_deltas(_two_models(spark, sf), "lookup_baseline", "linear_1d")


@query("promotion_check", O.ctes(*_TWO_MODELS_CTES) +
       "select a.rmse_seconds as current_rmse, b.rmse_seconds as candidate_rmse,"
       " b.rmse_seconds <= a.rmse_seconds * 1.0e0 as promote from mm a, mm b"
       " where a.model = 'lookup_baseline' and b.model = 'linear_1d'")
def q_promotion_check(spark, sf):
    m = _two_models(spark, sf)
    return M.promotion_check(m.where(F.col("model") == "lookup_baseline"),
                             m.where(F.col("model") == "linear_1d"))


# -- E11-E15, D5, J9, J12, J13: calibration -----------------------------------------------------
def calib_frames(spark, sf):
    """Scored train and validation rows (narrow, written once: the lookup is fitted once) and the threshold."""
    s = split_full(spark, sf).where(F.col("split").isin("train", "val"))
    scored = MD.lookup_baseline(s.where(F.col("split") == "train"), s).select("id", "split", C.TARGET, "prediction")
    checkpoint_dir(spark)
    scored = scored.checkpoint()
    tr, va = scored.where(F.col("split") == "train"), scored.where(F.col("split") == "val")
    thr = spike_thr(tr).checkpoint()  # one row
    return CA.with_spike_label(tr, thr), CA.with_spike_label(va, thr), thr


_REL_IDX = " + ".join(f"cast({repr(i * 0.1)}e0 < {{p}} as int)".replace("e0e0", "e0")
                      for i in range(1, 10))
_CAL_CTES = [
    *LOOKUP_CTES, THR_CTE, TSCORED_CTE,
    "tl as (select t.*, cast(trip_duration > spike_threshold as int) as spike from tscored t cross join thr)",
    "vl as (select v.*, cast(trip_duration > spike_threshold as int) as spike from scored v cross join thr)",
    "mnmx as (select min(prediction) as mn, max(prediction) as mx from tl)",
    "bins as (select cast(b as int) as bin, b * ((mx - mn) / 20e0) + mn as low,"
    " case when b = 19 then mx else (b + 1) * ((mx - mn) / 20e0) + mn end as high"
    " from mnmx cross join range(0, 20) r(b))",
    "bstats as (select bin, count(*) as n, avg(cast(spike as double)) as p from tl join bins"
    " on prediction >= low and prediction < high group by bin)",
    "sb as (select b.bin, low, high, coalesce(n, 0) as train_rows, coalesce(p, 0e0) as spike_probability"
    " from bins b left join bstats s on b.bin = s.bin)",
    "vprob as (select v.*, coalesce(w.spike_probability, 0e0) as spike_prob from vl v left join"
    " (select bin, low, case when bin = 19 then high + 1 else high end as high, spike_probability from sb) w"
    " on v.prediction >= w.low and v.prediction < w.high)",
]


def _iso_ctes(src: str, prob: str) -> list[str]:
    """Isotonic fit as SQL: on distinct x, fitted(i) = max_{j<=i} min_{k>=i} mean(y[j..k])."""
    return [
        f"pts as (select {prob} as x, sum(cast(spike as double)) as sy, count(*) as w from {src} group by 1)",
        "cum as (select x, sy, w, row_number() over (order by x) as i,"
        " sum(sy) over (order by x) as cs, sum(w) over (order by x) as cw from pts)",
        "avgs as (select a.i as j, b.i as k, (b.cs - a.cs + a.sy) / (b.cw - a.cw + a.w) as v"
        " from cum a join cum b on a.i <= b.i)",
        "inner_min as (select c.i, a.j, min(a.v) as mn from cum c join avgs a on a.j <= c.i and a.k >= c.i"
        " group by c.i, a.j)",
        "iso as (select c.x, max(m.mn) as fitted from cum c join inner_min m on c.i = m.i group by c.x)",
    ]


def _iso_apply_sql(src: str, prob: str, out: str = "calibrated_prob") -> str:
    return (f"cal as (select v.*, case when lo.x is null then hi.fitted when hi.x is null then lo.fitted"
            f" when hi.x = lo.x then lo.fitted else lo.fitted + ({prob} - lo.x) * (hi.fitted - lo.fitted)"
            f" / (hi.x - lo.x) end as {out} from {src} v asof left join iso lo on v.{prob} >= lo.x"
            f" asof left join iso hi on v.{prob} <= hi.x)")


@query("spike_bins", O.ctes(*_CAL_CTES) +
       f"select bin, {rnd_sql('low', 6)} as low, {rnd_sql('high', 6)} as high, train_rows,"
       f" {rnd_sql('spike_probability', 6)} as spike_probability from sb")
def q_spike_bins(spark, sf):
    tr, _, _ = calib_frames(spark, sf)
    b = CA.spike_bins(tr)
    return b.select("bin", rnd("low", 6).alias("low"), rnd("high", 6).alias("high"), "train_rows",
                    rnd("spike_probability", 6).alias("spike_probability"))


@query("spike_probability", O.ctes(*_CAL_CTES) +
       f"select id, spike, {rnd_sql('spike_prob', 6)} as spike_prob from vprob")
def q_spike_probability(spark, sf):
    tr, va, _ = calib_frames(spark, sf)
    vp = CA.spike_probability(va, CA.spike_bins(tr))
    return vp.select("id", "spike", rnd("spike_prob", 6).alias("spike_prob"))


@query("reliability_curve", O.ctes(*_CAL_CTES) +
       f"select {_REL_IDX.format(p='spike_prob')} as bin, count(*) as rows,"
       f" {rnd_sql('avg(spike_prob)', 4)} as mean_predicted_prob,"
       f" {rnd_sql('avg(cast(spike as double))', 4)} as fraction_positive,"
       " case when avg(cast(spike as double)) - avg(spike_prob) > 0.05e0 then 'under-confident'"
       " when avg(cast(spike as double)) - avg(spike_prob) < -0.05e0 then 'over-confident' else 'calibrated' end as direction"
       " from vprob group by 1")
def q_reliability(spark, sf):
    tr, va, _ = calib_frames(spark, sf)
    c = CA.reliability_curve(CA.spike_probability(va, CA.spike_bins(tr)))
    return c.select("bin", "rows", rnd("mean_predicted_prob", 4).alias("mean_predicted_prob"),
                    rnd("fraction_positive", 4).alias("fraction_positive"), "direction")


def _stats_sql(src: str, prob: str) -> str:
    idx = _REL_IDX.format(p=prob)
    return (f"select {rnd_sql('avg(abs(mp - fp))', 4)} as ece,"
            f" {rnd_sql('sum(abs(mp - fp) * n) / sum(n)', 4)} as ece_weighted, count(*) as non_empty_bins,"
            f" (select {rnd_sql(f'avg(({prob} - spike) * ({prob} - spike))', 4)} from {src}) as brier_score,"
            f" (select {rnd_sql('avg(cast(spike as double))', 4)} from {src}) as actual_spike_rate,"
            f" (select {rnd_sql(f'avg({prob})', 4)} from {src}) as predicted_spike_rate"
            f" from (select {idx} as b, count(*) as n, avg({prob}) as mp, avg(cast(spike as double)) as fp"
            f" from {src} group by 1) r")


def _stats_out(df):
    return df.select(*[rnd(c, 4).alias(c) if c != "non_empty_bins" else F.col(c)
                       for c in df.columns])


@query("ece_brier", O.ctes(*_CAL_CTES) + _stats_sql("vprob", "spike_prob"))
def q_ece_brier(spark, sf):
    tr, va, _ = calib_frames(spark, sf)
    return _stats_out(CA.calibration_stats(CA.spike_probability(va, CA.spike_bins(tr))))


@query("isotonic", O.ctes(*_CAL_CTES, *_iso_ctes("vprob", "spike_prob"),
                          _iso_apply_sql("vprob", "spike_prob")) +
       f"select id, {rnd_sql('calibrated_prob', 4)} as calibrated_prob from cal")
def q_isotonic(spark, sf):
    tr, va, _ = calib_frames(spark, sf)
    vp = CA.spike_probability(va, CA.spike_bins(tr))
    cal = CA.apply_isotonic(CA.fit_isotonic(vp), vp)
    return cal.select("id", rnd("calibrated_prob", 4).alias("calibrated_prob"))


def _override_sql(t: str) -> str:
    return _OVERRIDE_SQL.replace("0.4e0", t)


_OVERRIDE_SQL = (
    "select 0.4e0 as override_threshold, count(*) filter (where calibrated_prob > 0.4e0) as override_count,"
    f" {rnd_sql('(count(*) filter (where calibrated_prob > 0.4e0)) * 100.0e0 / count(*)', 2)} as override_pct,"
    f" {rnd_sql('cast(sum(spike) filter (where calibrated_prob > 0.4e0) as double) / nullif(count(*) filter (where calibrated_prob > 0.4e0), 0)', 4)} as precision,"
    f" {rnd_sql('case when sum(spike) > 0 then coalesce(sum(spike) filter (where calibrated_prob > 0.4e0), 0) / sum(spike) else 0e0 end', 4)} as recall,"
    " cast(coalesce(sum(spike) filter (where calibrated_prob > 0.4e0), 0) as bigint) as spikes_caught,"
    " cast(sum(spike) as bigint) as total_spikes,"
    " case when count(*) filter (where calibrated_prob > 0.4e0) = 0 then null"
    " when cast(sum(spike) filter (where calibrated_prob > 0.4e0) as double) / count(*) filter (where calibrated_prob > 0.4e0) > 0.3e0"
    " then 'override useful' else 'override too noisy' end as verdict from cal")


#: Below the largest calibrated probability of the given tables, so that some rows are overridden.
_OVERRIDE_AT = 0.052


@query("override_analysis", O.ctes(*_CAL_CTES, *_iso_ctes("vprob", "spike_prob"),
                                   _iso_apply_sql("vprob", "spike_prob")) + _override_sql(f"{_OVERRIDE_AT}e0"))
def q_override(spark, sf):
    tr, va, _ = calib_frames(spark, sf)
    vp = CA.spike_probability(va, CA.spike_bins(tr))
    return CA.override_analysis(CA.apply_isotonic(CA.fit_isotonic(vp), vp), threshold=_OVERRIDE_AT)


@query("calibration_report", O.ctes(
    *_CAL_CTES, *_iso_ctes("vprob", "spike_prob"), _iso_apply_sql("vprob", "spike_prob"),
    "ub as (" + _stats_sql("vprob", "spike_prob") + ")",
    "cb as (" + _stats_sql("cal", "calibrated_prob") + ")",
    f"cr as (select avg(abs(mp - fp)) as raw_ece from (select {_REL_IDX.format(p='calibrated_prob')} as b,"
    " avg(calibrated_prob) as mp, avg(cast(spike as double)) as fp from cal group by 1) r)",
    "ov as (" + _OVERRIDE_SQL + ")") +
    f"select {rnd_sql('(select spike_threshold from thr)', 1)} as spike_threshold,"
    f" {rnd_sql('(select avg(cast(trip_duration as double)) from tl)', 1)} as historical_mean,"
    " ub.ece as uncal_ece, ub.ece_weighted as uncal_ece_weighted, ub.non_empty_bins as uncal_non_empty_bins,"
    " ub.brier_score as uncal_brier_score, ub.actual_spike_rate as uncal_actual_spike_rate,"
    " ub.predicted_spike_rate as uncal_predicted_spike_rate,"
    " cb.ece as cal_ece, cb.ece_weighted as cal_ece_weighted, cb.non_empty_bins as cal_non_empty_bins,"
    " cb.brier_score as cal_brier_score, cb.actual_spike_rate as cal_actual_spike_rate,"
    " cb.predicted_spike_rate as cal_predicted_spike_rate, ov.*, 0.95e0 as spike_percentile,"
    f" {rnd_sql('ub.ece - cb.ece', 4)} as ece_improvement,"
    f" {rnd_sql('ub.brier_score - cb.brier_score', 4)} as brier_improvement, "
    " case when cr.raw_ece < 0.05e0 then 'good' when cr.raw_ece < 0.1e0 then 'moderate' else 'poor' end"
    " as calibration_verdict from ub, cb, ov, cr")
def q_calibration_report(spark, sf):
    tr, va, thr = calib_frames(spark, sf)
    return CA.calibration_report(tr.drop("spike"), va.drop("spike"), thr, fit_on="val")


# -- B / A: gates, verification, sinks ------------------------------------------------------------
from ..operators import audit as AU  # noqa: E402
from ..operators import gates as G  # noqa: E402
from ..operators import store as ST  # noqa: E402
from .etl import training_frame  # noqa: E402
from ..sources import sinks as SK  # noqa: E402
from ..sources.registry import registry_features  # noqa: E402
from ..streaming.trips import scratch_path as scratch  # noqa: E402


def _gate_sql(rows_sql: list[tuple[str, str, float, str]], src: str) -> str:
    parts = []
    for gate, obs, limit, cmp in rows_sql:
        op = ">" if cmp == "gt" else "<"
        parts.append(f"select '{gate}' as gate, cast({obs} as double) as observed, {float(limit)!r}e0 as \"limit\","
                     f" coalesce(cast({obs} as double) {op} {float(limit)!r}e0, false) as violated from {src}")
    return " union all ".join(parts).replace("e0e0", "e0")


_NULL_COLS = C.NULL_GATE_COLUMNS
_QG = ([("row_count", "count(*)", C.MIN_ROW_COUNT, "lt"), ("non_empty", "count(*)", 1, "lt")]
       + [(f"null_rate:{c}", f"count(*) filter (where {c} is null) / count(*)", C.MAX_NULL_RATE, "gt")
          for c in _NULL_COLS]
       + [(f"zero_rate:{c}", f"count(*) filter (where {c} = 0) / count(*)", C.MAX_ZERO_COORD_RATE, "gt")
          for c in C.ZERO_GATE_COLUMNS]
       + [("negative_target", "count(*) filter (where trip_duration < 0)", 0, "gt"),
          ("future_timestamps", "count(*) filter (where pickup_datetime > now())", 0, "gt"),
          ("bad_gps_rate", "count(*) filter (where pickup_latitude < 40.4e0 or pickup_latitude > 41.0e0)"
           " / count(*)", C.MAX_BAD_GPS_RATE, "gt")])


def _gates_out(df):
    return df.select("gate", rnd("observed", 8).alias("observed"), "limit", "violated")


@query("quality_gates", "select gate, " + rnd_sql("observed", 8) + " as observed, \"limit\", violated from ("
       + O.ctes().replace("with ", "with ", 1) + _gate_sql(_QG, "trips") + ") q")
def q_quality_gates(spark, sf):
    return _gates_out(G.quality_gates(trips(spark, sf)))


@query("null_rates", O.ctes() + " union all ".join(
    f"select '{c}' as \"column\", count(*) filter (where {c} is null) / count(*) as null_rate from trips"
    for c in C.RAW_COLUMNS))
def q_null_rates(spark, sf):
    return G.null_rates(trips(spark, sf), C.RAW_COLUMNS)


_VERIFY = ([("row_count", "count(*)", C.VERIFY_MIN_ROWS, "lt"), ("missing_columns", "max(0)", 0, "gt")]
           + [(f"nulls:{c}", f"count(*) filter (where {c} is null)", 0, "gt") for c in C.VERIFY_NOT_NULL]
           + [("min_target", "min(trip_duration)", C.MIN_DURATION_S, "lt"),
              ("max_target", "max(trip_duration)", C.MAX_DURATION_S, "gt"),
              ("min_distance_km", "min(distance_km)", C.MIN_DISTANCE_KM, "lt")])


@query("verify_output", "select gate, " + rnd_sql("observed", 8) + " as observed, \"limit\", violated from ("
       + O.ctes() + _gate_sql(_VERIFY, "clean") + ") q")
def q_verify_output(spark, sf):
    return _gates_out(G.verify_output(processed_full(spark, sf)))


@query("sample_gate", "select gate, " + rnd_sql("observed", 8) + " as observed, \"limit\", violated from ("
       + O.ctes("smp as (select * from trips where (cast(id as bigint) * 2654435761 + 42) % 4294967296 < 429496729)")
       + _gate_sql([("sample_rows", "count(*)", 1, "lt"),
                    ("sample_bad_gps_rate", "count(*) filter (where pickup_latitude < 40.4e0 or"
                     " pickup_latitude > 41.0e0) / count(*)", C.MAX_BAD_GPS_RATE, "gt")], "smp") + ") q")
def q_sample_gate(spark, sf):
    return _gates_out(G.sample_gate(trips(spark, sf)))


_CORRUPT = {"vendor_id": 11, "passenger_count": 13, "pickup_datetime": 17, "pickup_longitude": 19, "trip_duration": 23}
_TYPED = ["vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "pickup_longitude",
          "pickup_latitude", "dropoff_longitude", "dropoff_latitude", "trip_duration"]


@query("type_violations", O.ctes() + " union all ".join(
    f"select '{c}' as \"column\", count(*) filter (where "
    + (f"cast(id as bigint) % {_CORRUPT[c]} = 5" if c in _CORRUPT else "false") + ") as bad_values from trips"
    for c in _TYPED))
def q_type_violations(spark, sf):
    """Every raw column as text (as a CSV export has it), some values of some columns spoilt."""
    t = trips(spark, sf)
    text = t.select(*[F.when(F.col("id").cast("long") % _CORRUPT[c] == 5, F.concat(F.lit("?"), F.col(c).cast("string")))
                      .otherwise(F.col(c).cast("string")).alias(c) if c in _CORRUPT else F.col(c).cast("string").alias(c)
                      for c in t.columns])
    return G.type_violations(text)


_FP_ROW = " || '|' || ".join(
    f"coalesce({t}, 'N')" for t in (
        ["length(id) || ':' || id"] + [f"cast({c} as varchar)" for c in ("hour", "day_of_week", "month", "is_weekend", "is_rush_hour")]
        + ["cast(cast(floor(distance_km * 1e6 + 0.5) as bigint) as varchar)", "cast(passenger_count as varchar)"]
        + [f"cast(cast(floor({c} * 1e6 + 0.5) as bigint) as varchar)"
           for c in ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")]
        + ["cast(vendor_id as varchar)", "cast(trip_duration as varchar)", "cast(epoch_us(pickup_datetime) as varchar)"]))
_FP_CTE = ("fp as (select count(*) as rows, cast(coalesce(sum(cast('0x' || substr(md5(" + _FP_ROW +
           "), 1, 15) as bigint)), 0) as varchar) as fingerprint from clean)")


def _fingerprinted(spark, sf):
    return processed_full(spark, sf).select(
        "id", "hour", "day_of_week", "month", "is_weekend", "is_rush_hour", "distance_km", "passenger_count", "pickup_latitude",
        "pickup_longitude", "dropoff_latitude", "dropoff_longitude", "vendor_id", "trip_duration", "pickup_datetime")


@query("table_fingerprint", O.ctes(_FP_CTE) + "select * from fp")
def q_fingerprint(spark, sf):
    return SK.table_fingerprint(_fingerprinted(spark, sf))


@query("manifest", O.ctes(_FP_CTE) + "select 'events' as raw_source, 'processed' as processed_output, rows as rows_after_cleaning,"
       " fingerprint as processed_hash, 60 as min_duration_seconds, 7200 as max_duration_seconds, 0.1e0 as min_distance_km,"
       " 'catalog' as run_id, '2024-01-31' as execution_date from fp")
def q_manifest(spark, sf):
    m = SK.manifest(_fingerprinted(spark, sf), "events", "processed", run_id="catalog", execution_date="2024-01-31")
    return m.select("raw_source", "processed_output", "rows_after_cleaning", "processed_hash",
                    "cleaning_rules.min_duration_seconds", "cleaning_rules.max_duration_seconds",
                    "cleaning_rules.min_distance_km", "run_id", "execution_date")


@query("row_handshake", O.ctes() + "select count(*) as rows_written, count(*) as rows_read, true as matches from clean")
def q_handshake(spark, sf):
    """Rows counted inside the write job against rows read back."""
    path = scratch(spark, "handshake")
    written, _ = SK.write_counted(processed_full(spark, sf), path)
    return SK.handshake(spark, path, written)


@query("lineage_trace", O.ctes(*_TWO_MODELS_CTES, _FP_CTE) +
       "select m.model, m.rmse_seconds, r.run_id, r.n as rows_after_cleaning, r.n as current_rows, r.run_id = 'run_2' as hash_matches"
       " from mm m cross join (select 'run_1' as run_id, rows - (select count(*) from clean where vendor_id = 2) as n0, rows as n from fp"
       " union all select 'run_2', rows, rows from fp) r where r.run_id = 'run_2' union all"
       " select m.model, m.rmse_seconds, 'run_1', (select count(*) from clean where vendor_id = 1), fp.rows, false from mm m cross join fp")
def q_lineage_trace(spark, sf):
    """Two runs append their metrics; the first was made before the table changed."""
    data = _fingerprinted(spark, sf)
    metrics = _two_models(spark, sf).select("model", "rmse_seconds")
    table = scratch(spark, "metrics")
    for run, frame in (("run_1", data.where("vendor_id = 1")), ("run_2", data)):
        SK.append_metrics(metrics, table, run)
    SK.append_metrics(metrics, table, "run_2")  # a repeated run replaces its rows
    manifests = SK.manifest(data.where("vendor_id = 1"), "events", "processed", run_id="run_1").unionByName(
        SK.manifest(data, "events", "processed", run_id="run_2"))
    now = SK.table_fingerprint(data).withColumn("processed_output", F.lit("processed"))
    return SK.lineage_trace(spark.read.parquet(table), manifests, now).select(
        "model", "rmse_seconds", "run_id", "rows_after_cleaning", "current_rows", "hash_matches")


# -- K / E16 / D4: attribution and audit -------------------------------------------------------
_EMB_LONG = ("emb as (select vec_id, 'dim_' || lpad(cast(i - 1 as varchar), 2, '0') as feature,"
             " cast(embedding[i] as double) as phi from embeddings, range(1, 65) r(i))")


def _emb_long(spark, sf):
    from ..sources.tables import table
    e = table(spark, sf, "embeddings")
    x = e.select("vec_id", F.posexplode("embedding").alias("i", "phi"))
    return x.select("vec_id", F.concat(F.lit("dim_"), F.lpad(F.col("i").cast("string"), 2, "0"))
                    .alias("feature"), F.col("phi").cast("double").alias("phi"))


@query("attribution_power", "with " + _EMB_LONG + ", per as (select feature, avg(abs(phi)) as mabs from emb"
       " group by feature), tot as (select sum(mabs) as t from per)"
       f" select feature, {rnd_sql('mabs', 2)} as mean_abs_attribution, {rnd_sql('mabs / t', 4)} as fraction,"
       " row_number() over (order by mabs desc, feature) as rank, mabs / t > 0.7e0 as dominant"
       " from per cross join tot")
def q_attribution_power(spark, sf):
    return AU.attribution_power(_emb_long(spark, sf))


# Ordinary least squares on two features in SQL: the normal equations of centred columns.
_OLS_FEATURES = ["distance_km", "trip_count_last_1h"]
_PIT_CTE = f"pit as (select *, {_F1_SQL} as trip_count_last_1h from clean)"
_OLS_CTES = [
    _PIT_CTE, O.date_split_sql("pit", TRAIN_END, GAP_END, VAL_END, "psplit"),
    "otr as (select *, cast(trip_duration as double) as y, distance_km as x1,"
    " cast(trip_count_last_1h as double) as x2 from psplit where split = 'train')",
    "om as (select covar_pop(x1, x1) as s11, covar_pop(x2, x2) as s22, covar_pop(x1, x2) as s12,"
    " covar_pop(x1, y) as s1y, covar_pop(x2, y) as s2y, avg(x1) as m1, avg(x2) as m2, avg(y) as my from otr)",
    "ols as (select (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1,"
    " (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2, sqrt(s11) as sd1, sqrt(s22) as sd2, m1, m2, my from om)",
]
_OLS_PHI = ("phis as (select id, 'distance_km' as feature, b1 * (distance_km - m1) as phi from psplit cross join ols"
            " where split = 'val' union all select id, 'trip_count_last_1h', b2 * (trip_count_last_1h - m2)"
            " from psplit cross join ols where split = 'val')")
_OLS_POWER = ("per as (select feature, avg(abs(phi)) as mabs from phis group by feature),"
              " tot as (select sum(mabs) as t from per),"
              f" pw as (select feature, {rnd_sql('mabs', 2)} as mean_abs_attribution, {rnd_sql('mabs / t', 4)} as fraction,"
              " row_number() over (order by mabs desc, feature) as rank, mabs / t > 0.7e0 as dominant from per cross join tot)")


def ols_frames(spark, sf):
    """Train and validation rows with the demand count attached."""
    s = date_split(PIT.rolling_count(processed_full(spark, sf)), TRAIN_END, GAP_END, VAL_END)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "val")


def _ols_power(spark, sf):
    tr, va = ols_frames(spark, sf)
    coefs, intercept, _ = MD.fit_ols(tr, _OLS_FEATURES)
    return AU.attribution_power(AU.linear_attribution(va, coefs, intercept, tr))


@query("attribution_power_linear", O.ctes(*_OLS_CTES, _OLS_PHI, _OLS_POWER) + "select * from pw")
def q_attribution_power_linear(spark, sf):
    return _ols_power(spark, sf)


@query("top_feature", O.ctes(*_OLS_CTES, _OLS_PHI, _OLS_POWER) + "select * from pw where rank = 1")
def q_top_feature(spark, sf):
    return AU.top_feature(_ols_power(spark, sf))


# the registry says: the count is not available at inference, the distance is without risk
_AUDIT_CTE = ("au as (select *, case when feature = 'distance_km' then 'true' else 'false' end as available_at_inference,"
              " case when feature = 'distance_km' then 'none' else 'HIGH if computed globally - must use point-in-time join' end as leakage_risk,"
              " case when feature <> 'distance_km' and fraction > 0.05e0 then 'LEAKAGE' else 'OK' end as status from pw)")


@query("registry_audit", O.ctes(*_OLS_CTES, _OLS_PHI, _OLS_POWER, _AUDIT_CTE) + "select * from au")
def q_registry_audit(spark, sf):
    return AU.registry_audit(_ols_power(spark, sf), registry_features(spark))


@query("leakage_audit", O.ctes(*_OLS_CTES, _OLS_PHI, _OLS_POWER, _AUDIT_CTE) +
       "select count(*) filter (where status = 'LEAKAGE') as leakage_violations,"
       " count(*) filter (where status = 'WARNING') as warnings, count(*) filter (where dominant) as dominant_features,"
       " case when count(*) filter (where status = 'LEAKAGE') = 0 then 'CLEAN' else 'LEAKAGE_DETECTED' end as verdict from au")
def q_leakage_audit(spark, sf):
    return AU.leakage_verdict(AU.registry_audit(_ols_power(spark, sf), registry_features(spark)))


# -- J2-J8, J10: fitted models ------------------------------------------------------------------
def _wols(w: str) -> str:
    """Weighted one-feature least squares: slope and intercept."""
    return (f"select sum({w}) as sw, sum({w} * distance_km) / sum({w}) as mx,"
            f" sum({w} * trip_duration) / sum({w}) as my from split cross join thr where split = 'train'")


def _wfit(name: str, w: str) -> list[str]:
    return [f"{name}m as ({_wols(w)})",
            f"{name} as (select sum({w} * (distance_km - mx) * (trip_duration - my)) / sum({w} * (distance_km - mx) * (distance_km - mx)) as b,"
            f" any_value(mx) as mx, any_value(my) as my from split cross join thr cross join {name}m where split = 'train')"]


_W5 = "case when trip_duration > spike_threshold then 5e0 else 1e0 end"


@query("weighted_linear", O.ctes(SPLIT_CTE, THR_CTE, *_wfit("pf", "1e0"), *_wfit("wf", _W5)) + " union all ".join(
    f"select '{label}' as model, " + ", ".join(
        rnd_sql(f"sqrt(avg((trip_duration - (my + b * (distance_km - mx))) * (trip_duration - (my + b * (distance_km - mx)))) filter (where trip_duration {op} spike_threshold))", 3)
        + f" as {col}" for op, col in ((">", "spike_rmse"), ("<=", "normal_rmse")))
    + f" from split cross join thr cross join {name} where split = 'train'" for label, name in (("plain", "pf"), ("weighted", "wf"))))
def q_weighted_linear(spark, sf):
    """Weighting spikes lowers their error on the training rows and raises that of the others."""
    tr, _ = train_val(spark, sf)
    thr = spike_thr(tr)
    w = M.sample_weights(tr, thr)
    e2 = lambda c: F.pow(F.col(C.TARGET) - c, 2)
    out = []
    for label, weight in (("plain", None), ("weighted", "weight")):
        coefs, intercept, _ = MD.fit_ols(w, ["distance_km"], weight=weight)
        err = e2(MD.linear_expression(coefs, intercept))
        out.append(w.agg(F.sqrt(F.avg(F.when(F.col("weight") > 1, err))).alias("s"), F.sqrt(F.avg(F.when(F.col("weight") <= 1, err))).alias("n"))
                   .select(F.lit(label).alias("model"), rnd("s", 3).alias("spike_rmse"), rnd("n", 3).alias("normal_rmse")))
    return out[0].unionByName(out[1])


@query("walk_forward_linear", O.ctes(
    _FOLDS_SQL, _ASSIGN_SQL,
    "lf as (select fold, regr_slope(cast(trip_duration as double), distance_km) as b,"
    " regr_intercept(cast(trip_duration as double), distance_km) as a from assigned where role = 'train' group by fold)",
    "ls as (select s.*, greatest(a + b * distance_km, 60e0) as prediction from assigned s join lf using (fold) where role = 'val')") +
    O.five_metrics_sql("ls", by="fold"))
def q_walk_forward_linear(spark, sf):
    """J10 for a fitted model: all folds are fitted in one aggregation and scored in one pass."""
    return MD.walk_forward_linear(processed_full(spark, sf), FOLDS)


_GRID = {"overfit": ("x", C.OVERFIT_BANDS), "slice": ("x / 10", C.SLICE_RATIO_BANDS), "stability": ("x / 100", C.STABILITY_BANDS),
         "calibration": ("x / 100", C.CALIBRATION_BANDS), "vs_baseline": ("x", C.IMPROVEMENT_VS_BASELINE_BANDS),
         "vs_linear": ("x", C.IMPROVEMENT_VS_LINEAR_BANDS), "test_gap": ("x", C.TEST_GAP_BANDS)}
_GRID_SQL = {
    "overfit": "case when x > 30 then 'severe overfit' when x > 15 then 'mild overfit' else 'healthy' end",
    "slice": "case when x / 10 < 2 then 'excellent' when x / 10 < 3 then 'good' when x / 10 < 4 then 'moderate' else 'poor' end",
    "stability": "case when x / 100 < 0.05e0 then 'STABLE' when x / 100 < 0.15e0 then 'MODERATE' else 'VOLATILE' end",
    "calibration": "case when x / 100 < 0.05e0 then 'good' when x / 100 < 0.1e0 then 'moderate' else 'poor' end",
    "vs_baseline": "case when x < 0 then 'worse' when x < 10 then 'weak' when x < 25 then 'moderate' else 'strong' end",
    "vs_linear": "case when x < 5 then 'barely beats linear' when x < 20 then 'moderate non-linearity' else 'strong non-linearity' end",
    "test_gap": "case when x > 50 then 'significant degradation' when x > 0 then 'slight degradation' else 'matches or beats validation' end",
}


@query("verdicts", "with g as (select cast(event_id % 1400 - 100 as double) / 20e0 as x from events) " + " union all ".join(
    f"select '{k}' as verdict, {case} as label, count(*) as rows from g group by 2" for k, case in _GRID_SQL.items()))
def q_verdicts(spark, sf):
    """Every verdict over a grid of values that holds each cut and its neighbours."""
    from ..functions.bands import band
    from ..sources.tables import table
    g = table(spark, sf, "events").select(((F.col("event_id") % 1400 - 100).cast("double") / 20.0).alias("x"))
    labels = F.array(*[F.struct(F.lit(k).alias("verdict"), band(F.expr(x), *bands).alias("label")) for k, (x, bands) in _GRID.items()])
    return g.select(F.explode(labels).alias("v")).groupBy("v.verdict", "v.label").agg(F.count(F.lit(1)).alias("rows"))


# -- L1, L5, K4: the registry against the table -----------------------------------------------------
def _feature_rates(df, names):
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in names])
    return row.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in names]), F.array(*names))).alias("feature", "null_rate"))


_RATE_SQL = " union all ".join(
    f"select '{c}' as feature, avg(cast({c} is null as double)) as null_rate, {'false' if c in C.PIT_FEATURES else 'true'} as available_at_inference from pit"
    for c in [*C.FEATURES, *C.PIT_FEATURES])


@query("registry_coverage", O.ctes(*_F2_CTES, f"pit as (select *, {_F1_SQL} as trip_count_last_1h from f2)") + _RATE_SQL)
def q_registry_coverage(spark, sf):
    """L1, K4: each registered feature with its availability and its null rate in the computed table."""
    reg = registry_features(spark).select("feature", "available_at_inference")
    names = [*C.FEATURES, *C.PIT_FEATURES]
    rates = _feature_rates(PIT.point_in_time_features(processed_full(spark, sf)), names)
    return reg.join(rates, "feature", "left").select("feature", "null_rate", "available_at_inference")


@query("service_coverage", O.ctes() + " union all ".join(
    f"select '{c}' as feature, avg(cast({c} is null as double)) as null_rate from clean" for c in C.FEATURES))
def q_service_coverage(spark, sf):
    """The features of the inference service, all of them computable from a request."""
    from ..sources.registry import service_features
    names = service_features(spark, "inference_features").select("feature")
    return names.join(_feature_rates(processed_full(spark, sf), C.FEATURES), "feature", "left")


# -- A1, A2: CSV contract round trip ------------------------------------------------------------------
_RAW_ROW = " || '|' || ".join(f"coalesce({t}, 'N')" for t in (
    ["length(id) || ':' || id", "cast(vendor_id as varchar)", "cast(epoch_us(pickup_datetime) as varchar)",
     "cast(epoch_us(dropoff_datetime) as varchar)", "cast(passenger_count as varchar)"]
    + [f"cast(cast(floor({c} * 1e6 + 0.5) as bigint) as varchar)"
       for c in ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")]
    + ["length(store_and_fwd_flag) || ':' || store_and_fwd_flag", "cast(trip_duration as varchar)"]))


@query("csv_round_trip", O.ctes() + "select count(*) as rows, cast(sum(cast('0x' || substr(md5(" + _RAW_ROW +
       "), 1, 15) as bigint)) as varchar) as fingerprint from trips")
def q_csv_round_trip(spark, sf):
    """A1, A2: the raw table written as CSV and read under the raw schema is the same table."""
    from ..sources.tables import read_raw_csv
    path = scratch(spark, "csv")
    trips(spark, sf).write.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    return SK.table_fingerprint(read_raw_csv(spark, path))


# -- F1, F2 on another event table, and without looking ahead ---------------------------------------------
@query("rolling_count_shipdate", "with d as (select l_shipdate, count(*) as rows from lineitem group by 1)"
       " select strftime(l_shipdate, '%Y-%m-%d') as ship_date, rows, cast(coalesce(sum(rows) over (order by l_shipdate"
       " range between interval 7 day preceding and interval 1 day preceding), 0) as bigint) as rows_last_week from d")
def q_rolling_count_shipdate(spark, sf):
    """F1 on lineitem: many rows share each instant (a day)."""
    from ..sources.tables import table
    li = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("timestamp").alias("t"), F.lit(1).alias("v"))
    c = PIT.rolling_count(li, ts="t", value="v", lookback_us=7 * 24 * PIT.HOUR_US, out="n")
    return c.groupBy(F.date_format("t", "yyyy-MM-dd").alias("ship_date")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("n").alias("rows_last_week"))


@query("avg_same_hour_past", O.ctes(
    *_F2_CTES[:2], "days as (select d, sum(m * n) as s, sum(n) as n from daily group by d)",
    "past as (select d, sum(s) over w / sum(n) over w as p from days window w as (order by d rows between unbounded preceding and 1 preceding))",
    "f3 as (select c.id, coalesce(l.a, past.p) as v from clean c left join lagged l on cast(c.pickup_datetime as date) = l.d"
    " and hour(c.pickup_datetime) = l.h left join past on cast(c.pickup_datetime as date) = past.d)") +
    f"select id, {rnd_sql('v', 6)} as avg_duration_same_hour_last7days from f3")
def q_avg_same_hour_past(spark, sf):
    """F2 with the fallback that does not look ahead."""
    return PIT.avg_same_hour(processed_full(spark, sf), fallback="past").select(
        "id", rnd("avg_duration_same_hour_last7days", 6).alias("avg_duration_same_hour_last7days"))


# -- G4 / D8 / M ------------------------------------------------------------------------------
@query("seeded_sample", O.ctes(SPLIT_CTE) + "select id, trip_duration from split where split = 'val'"
       " and (cast(id as bigint) * 2654435761 + 42) % 4294967296 < 1288490188")
def q_seeded_sample(spark, sf):
    _, va = train_val(spark, sf)
    return AU.seeded_sample(va, 0.3).select("id", "trip_duration")


_SCENARIO_FIELDS = ["vendor_id", "distance_km", "passenger_count", "pickup_latitude", "dropoff_longitude", "hour",
                    "day_of_week", "month", "is_weekend", "is_rush_hour"]
#: The probes' scenarios and two that override other features of the contract.
_SCENARIOS = [*AU.SCENARIOS, {"scenario": "june", "month": 6}, {"scenario": "evening", "hour": 22, "pickup_latitude": 40.7}]


def _scenario_values() -> str:
    def v(s, f):
        x = s.get(f)
        return "null" if x is None else (f"{x!r}e0" if isinstance(x, float) else str(x))
    fields = [*_SCENARIO_FIELDS, "distance_delta"]
    rows = ", ".join("('" + s["scenario"] + "', " + ", ".join(v(s, f) for f in fields) + ")" for s in _SCENARIOS)
    return f"scen(scenario, {', '.join('o_' + f for f in fields)}) as (values {rows})"


@query("scenario_rows", O.ctes(SPLIT_CTE, _scenario_values()) +
       "select scenario, count(*) as rows, " + ", ".join(
           rnd_sql(f"avg(coalesce(o_{f}, {f})" + (" + coalesce(o_distance_delta, 0)" if f == "distance_km" else "") + ")", 4)
           + f" as {f}" for f in _SCENARIO_FIELDS) + " from split cross join scen where split = 'val' group by 1")
def q_scenario_rows(spark, sf):
    _, va = train_val(spark, sf)
    return AU.scenario_rows(va, _SCENARIOS).groupBy("scenario").agg(
        F.count(F.lit(1)).alias("rows"), *[rnd(F.avg(f), 4).alias(f) for f in _SCENARIO_FIELDS])


# -- L: feature store ---------------------------------------------------------------------------
@query("historical_features", O.ctes(*_F2_CTES, f"pit as (select *, {_F1_SQL} as trip_count_last_1h from f2)",
                                     "r as (select *, row_number() over (order by pickup_datetime, id) - 1 as rk,"
                                     " count(*) over () as n from pit)") +
       "select case when rk < floor(n * 0.75e0) then 'train' when rk < floor(n * 0.8e0) then 'gap'"
       " else 'val' end as split, count(*) as rows, sum(trip_count_last_1h) as sum_trip_count,"
       f" {rnd_sql('avg(avg_duration_same_hour_last7days)', 4)} as mean_avg_7d from r group by 1")
def q_historical_features(spark, sf):
    df, _, _ = training_frame(processed_full(spark, sf))
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"),
                                   F.sum("trip_count_last_1h").alias("sum_trip_count"),
                                   rnd(F.avg("avg_duration_same_hour_last7days"), 4).alias("mean_avg_7d"))


@query("online_features", O.ctes() + "select id, hour, day_of_week, month, is_weekend, is_rush_hour,"
       f" {rnd_sql('distance_km', 6)} as distance_km, passenger_count, vendor_id from"
       " (select *, " + O.TIME_FEATURES_SQL + " from trips_d) t")
def q_online_features(spark, sf):
    req = trips(spark, sf).select("id", "pickup_datetime", "pickup_latitude", "pickup_longitude",
                                  "dropoff_latitude", "dropoff_longitude", "passenger_count", "vendor_id")
    o = ST.online_features(req)
    return o.select("id", "hour", "day_of_week", "month", "is_weekend", "is_rush_hour",
                    rnd("distance_km", 6).alias("distance_km"), "passenger_count", "vendor_id")


@query("ttl_filter", O.ctes() + "select count(*) as rows from clean where pickup_datetime >="
       " timestamp '2024-01-27' - interval 7 day and pickup_datetime <= timestamp '2024-01-27'")
def q_ttl_filter(spark, sf):
    return ST.ttl_filter(processed_full(spark, sf), "2024-01-27", 7).agg(
        F.count(F.lit(1)).alias("rows"))


# -- N: streaming ------------------------------------------------------------------------------
from ..streaming import trips as STR  # noqa: E402


def _replay(spark, sf, base, query, **kw):
    """The sink of a query over a feed of six arrivals with late rows, a micro-batch each."""
    from ..sources.tables import table
    return STR.replay(table(spark, sf, "events"), base, query, **kw)


_ARRIVAL = ("case when cast(id as bigint) % 50 = 7 and pickup_datetime < timestamp '2024-01-08' then 5 else "
            + " + ".join(f"cast(pickup_datetime >= timestamp '{c}' as int)" for c in STR.FEED_CUTS) + " end")


@query("stream_features", O.ctes() + f"select {_PROCESSED_OUT} from clean")
def q_stream_features(spark, sf):
    """N1, replayed in goes: an arrival of the feed, a stop, then the next from the same checkpoint."""
    path = _replay(spark, sf, scratch(spark, "stream_features"), lambda s: STR.stream_features(STR.trip_stream(s())))
    return _processed_out(spark.read.parquet(path))


#: Spoils rows of the third file, whose batch is to be quarantined.
_SPOIL = "ts >= timestamp '2024-01-15' and ts < timestamp '2024-01-22' and event_id % 1000 = 11"


@query("stream_gates", O.ctes(f"arr as (select *, {_ARRIVAL} as part from trips)") +
       "select case when part = 2 then 'quarantine' else 'accepted' end as outcome, count(*) as rows,"
       " count(distinct part) as batches from arr group by 1")
def q_stream_gates(spark, sf):
    path = _replay(spark, sf, scratch(spark, "stream_gates"), lambda s: STR.trip_stream(s()), spoil=_SPOIL,
                   run=partial(STR.run_to_table, foreach_batch=STR.gate_batches(min_rows=1)))
    return spark.read.parquet(f"{path}/batches").groupBy("outcome").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("batch_id").alias("batches"))


@query("stream_demand_windows", O.ctes(f"arr as (select *, {_ARRIVAL} as part from clean)") +
       "select strftime(ws, '%Y-%m-%d %H:%M:%S') as window_start, count(*) as trips from"
       " (select time_bucket(interval 5 minute, pickup_datetime) - interval (5 * k) minute as ws"
       " from arr, range(0, 12) r(k) where not (part = 5 and pickup_datetime < timestamp '2024-01-08')) t group by ws")
def q_stream_demand(spark, sf):
    """Rows three weeks late come after the watermark and are left out; windows that are
    updated by several batches keep their last count."""
    base = scratch(spark, "stream_demand")
    path = _replay(spark, sf, base, lambda s: STR.demand_windows(STR.stream_features(STR.trip_stream(s()))),
                   run=partial(STR.run_to_table, output_mode="update", foreach_batch=STR.upsert_latest()))
    STR.compact_latest(spark, path, ["window_start"], f"{base}/latest")
    return spark.read.parquet(f"{base}/latest").select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), F.col("trips").cast("long").alias("trips"))


def _saved_model(spark, sf, base):
    """Lookup, mean and spike bins of the training window, written once: a micro-batch reads these files."""
    tr, _, _ = calib_frames(spark, sf)
    full, _ = train_val(spark, sf)
    saved = {"lookup": MD.fit_lookup(full), "mean": full.agg(F.avg(F.col(C.TARGET).cast("double")).alias("global_mean")),
             "bins": CA.spike_bins(tr)}
    for name, df in saved.items():
        df.write.mode("overwrite").parquet(f"{base}/model/{name}")
    return [spark.read.parquet(f"{base}/model/{name}") for name in saved]


def _val_stream(events):
    s = STR.stream_features(STR.trip_stream(events))
    return date_split(s, TRAIN_END, GAP_END, VAL_END).where(F.col("split") == "val")


@query("stream_scoring", O.ctes(*_CAL_CTES) +
       f"select id, {rnd_sql('prediction', 4)} as prediction, {rnd_sql('spike_prob', 6)} as spike_prob,"
       f" spike_prob > {_OVERRIDE_AT}e0 as overridden, {rnd_sql(f'case when spike_prob > {_OVERRIDE_AT}e0 then global_mean else prediction end', 4)}"
       " as served_prediction from vprob cross join gm")
def q_stream_scoring(spark, sf):
    """Validation-window trips arrive as a stream and are scored against the saved model
    (stream-static join); rows that are likely spikes get the historical mean instead."""
    base = scratch(spark, "stream_scoring")
    lookup, mean, bins = _saved_model(spark, sf, base)
    path = _replay(spark, sf, base, lambda s: STR.score_stream(_val_stream(s()), lookup, mean, bins, threshold=_OVERRIDE_AT)
                   .select("id", "prediction", "spike_prob", "served_prediction"))
    return spark.read.parquet(path).select(
        "id", rnd("prediction", 4).alias("prediction"), rnd("spike_prob", 6).alias("spike_prob"),
        (F.col("spike_prob") > _OVERRIDE_AT).alias("overridden"), rnd("served_prediction", 4).alias("served_prediction"))


def _delayed(spark, sf, name, then=lambda joined: joined):
    """The sink of the join of predictions and outcomes, and what ``then`` makes of it."""
    base = scratch(spark, name)
    lookup, mean, _ = _saved_model(spark, sf, base)

    def joined(stream):
        preds = STR.score_stream(_val_stream(stream()), lookup, mean).select(
            "id", "prediction", F.col("pickup_datetime").alias("pred_ts"))
        outcomes = _val_stream(stream()).select(
            "id", C.TARGET, (F.col("pickup_datetime") + F.make_dt_interval(
                F.lit(0), F.lit(0), F.lit(0), F.col(C.TARGET).cast("decimal(18,6)"))).alias("outcome_ts"))
        return then(STR.delayed_label_join(preds, outcomes).select(F.col("p.id").alias("id"), "prediction", "pred_ts", C.TARGET))
    return _replay(spark, sf, base, joined)


@query("stream_delayed_labels", O.ctes(*LOOKUP_CTES) +
       "select strftime(date_trunc('day', pickup_datetime), '%Y-%m-%d') as day, count(*) as rows,"
       f" {rnd_sql('sqrt(avg((trip_duration - prediction) * (trip_duration - prediction)))', 2)} as rmse_seconds,"
       f" {rnd_sql('avg(trip_duration - prediction)', 2)} as mean_error_seconds from scored group by 1")
def q_stream_delayed_labels(spark, sf):
    """Predictions are emitted at pickup, outcomes arrive at dropoff; a
    watermarked stream-stream join pairs them, then daily error metrics of what it wrote."""
    j = spark.read.parquet(_delayed(spark, sf, "stream_delayed_labels"))
    e = F.col(C.TARGET).cast("double") - F.col("prediction")
    return j.groupBy(F.date_format(F.date_trunc("day", "pred_ts"), "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), rnd(F.sqrt(F.avg(e * e)), 2).alias("rmse_seconds"),
        rnd(F.avg(e), 2).alias("mean_error_seconds"))


@query("stream_error_windows", O.ctes(*LOOKUP_CTES) +
       "select strftime(date_trunc('day', pickup_datetime), '%Y-%m-%d') as day, count(*) as rows,"
       f" {rnd_sql('sqrt(avg((trip_duration - prediction) * (trip_duration - prediction)))', 2)} as rmse_seconds,"
       f" {rnd_sql('avg(trip_duration - prediction)', 2)} as mean_error_seconds from scored"
       " where pickup_datetime < timestamp '2024-01-26' group by 1")
def q_stream_error_windows(spark, sf):
    """N5 on the stream: day windows behind the join, each written once when the watermark (three
    hours behind the feed) has passed it; the last day is still open when the feed ends."""
    j = spark.read.parquet(_delayed(spark, sf, "stream_error_windows",
                                    lambda joined: STR.windowed_error_metrics(joined, C.TARGET, "prediction", "pred_ts")))
    return j.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "rows",
                    rnd("rmse_seconds", 2).alias("rmse_seconds"), rnd("mean_error_seconds", 2).alias("mean_error_seconds"))


@query("final_test_baseline", O.ctes(*LOOKUP_CTES,
                                     "tscore as (select s.*, coalesce(l.predicted_duration, gm.global_mean)"
                                     " as prediction from split s left join lookup l on s.hour = l.hour and"
                                     " s.day_of_week = l.day_of_week cross join gm where s.split = 'test')",
                                     "tm as (" + O.five_metrics_sql("tscore") + ")",
                                     "vm as (" + O.five_metrics_sql("scored") + ")") +
       "select tm.*, tm.rows as test_rows, " + rnd_sql("tm.rmse_seconds - vm.rmse_seconds", 2) +
       " as rmse_gap_vs_validation, case when tm.rmse_seconds - vm.rmse_seconds > 50e0 then 'significant degradation'"
       " when tm.rmse_seconds - vm.rmse_seconds > 0e0 then 'slight degradation' else 'matches or beats validation' end"
       " as verdict from tm cross join vm")
def q_final_test(spark, sf):
    """The held-out test window scored once; gap to the validation RMSE of
    the same model (computed here instead of a hard-coded number)."""
    s = split_full(spark, sf)
    tr = s.where(F.col("split") == "train")
    return MD.final_test_evaluation(MD.lookup_baseline(tr, s.where(F.col("split").isin("val", "test"))))


@query("metrics_missing", O.ctes(*_TWO_MODELS_CTES) +
       "select e.model, m.model is not null as found, m.rmse_seconds from"
       " (values ('lookup_baseline'), ('linear_1d'), ('boosted')) e(model) left join mm m using (model)")
def q_metrics_missing(spark, sf):
    """A10: expected model list left-joined with the metrics that exist."""
    from ..sources.sinks import load_metrics
    return load_metrics(_two_models(spark, sf).select("model", "rmse_seconds"),
                        ["lookup_baseline", "linear_1d", "boosted"]).select("model", "found", "rmse_seconds")


from . import fitted, intake  # noqa: E402, F401 - register their queries
