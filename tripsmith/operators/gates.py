"""Schema contract and quality gates.

All content gates are evaluated in ONE aggregation pass that yields one row of
counters; it is then unpivoted into ``gate, observed, limit, violated`` rows.
Raising is a separate, explicit step (``raise_on_violation``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C


def missing_columns(df: DataFrame, required: Sequence[str] = tuple(C.RAW_COLUMNS)) -> list[str]:
    """B1: schema-only check on the driver (no data is read)."""
    return sorted(set(required) - set(df.columns))


def type_violations(text_df: DataFrame, schema=None) -> DataFrame:
    """B2: per column, rows whose text value is present but does not cast to the
    declared type (the reference declares types but never checks them)."""
    from ..sources.tables import RAW_SCHEMA
    schema = schema or RAW_SCHEMA
    exprs = []
    for f in schema:
        if f.name not in text_df.columns or f.dataType.simpleString() == "string":
            continue
        raw = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "timestamp":
            parsed = F.try_to_timestamp(raw)
        else:
            parsed = F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})")
        exprs.append(F.count_if(raw.isNotNull() & parsed.isNull()).alias(f.name))
    row = text_df.agg(*exprs)
    names = [e for e in row.columns]
    return row.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("long") for n in names])))
        .alias("column", "bad_values"))


def _gate_rows(row: DataFrame, specs: list[tuple[str, str, float, str]]) -> DataFrame:
    """specs: (gate, observed column, limit, comparison) where comparison is the
    violation rule: 'gt' observed > limit, 'lt' observed < limit."""
    structs = []
    for gate, col, limit, cmp in specs:
        obs = F.col(col).cast("double")
        bad = (obs > F.lit(float(limit))) if cmp == "gt" else (obs < F.lit(float(limit)))
        structs.append(F.struct(F.lit(gate).alias("gate"), obs.alias("observed"),
                                F.lit(float(limit)).alias("limit"),
                                F.coalesce(bad, F.lit(False)).alias("violated")))
    return row.select(F.explode(F.array(*structs)).alias("g")).select("g.*")


def quality_gates(df: DataFrame, min_rows: int = C.MIN_ROW_COUNT,
                  max_null_rate: float = C.MAX_NULL_RATE,
                  max_zero_rate: float = C.MAX_ZERO_COORD_RATE,
                  max_bad_gps_rate: float = C.MAX_BAD_GPS_RATE,
                  null_columns: Sequence[str] = tuple(C.NULL_GATE_COLUMNS),
                  zero_columns: Sequence[str] = tuple(C.ZERO_GATE_COLUMNS),
                  as_of=None, ts: str = C.TIME_COL, target: str = C.TARGET) -> DataFrame:
    """Row floor, non-empty, null rates, zero-coordinate rates, negative
    targets, future timestamps, out-of-box pickup latitude rate - one pass.
    ``as_of`` (timestamp string) defaults to ``current_timestamp()``."""
    now = F.current_timestamp() if as_of is None else F.to_timestamp(F.lit(as_of))
    n = F.count(F.lit(1))
    lat = F.col("pickup_latitude")
    aggs = [n.alias("rows"),
            F.count_if(F.col(target) < 0).alias("negative_target"),
            F.count_if(F.col(ts) > now).alias("future_ts"),
            F.try_divide(F.count_if((lat < C.LAT_BOUNDS[0]) | (lat > C.LAT_BOUNDS[1])), n)
            .alias("bad_gps_rate")]
    aggs += [F.try_divide(F.count_if(F.col(c).isNull()), n).alias(f"null_rate_{c}")
             for c in null_columns]
    aggs += [F.try_divide(F.count_if(F.col(c) == 0.0), n).alias(f"zero_rate_{c}")
             for c in zero_columns]
    row = df.agg(*aggs)
    specs = [("row_count", "rows", min_rows, "lt"), ("non_empty", "rows", 1, "lt")]
    specs += [(f"null_rate:{c}", f"null_rate_{c}", max_null_rate, "gt") for c in null_columns]
    specs += [(f"zero_rate:{c}", f"zero_rate_{c}", max_zero_rate, "gt") for c in zero_columns]
    specs += [("negative_target", "negative_target", 0, "gt"),
              ("future_timestamps", "future_ts", 0, "gt"),
              ("bad_gps_rate", "bad_gps_rate", max_bad_gps_rate, "gt")]
    return _gate_rows(row, specs)


def verify_output(df: DataFrame, min_rows: int = C.VERIFY_MIN_ROWS,
                  required: Sequence[str] = tuple(C.VERIFY_COLUMNS),
                  not_null: Sequence[str] = tuple(C.VERIFY_NOT_NULL)) -> DataFrame:
    """One pass over the written table: row floor, nulls in critical
    columns, target and distance ranges (60 <= duration <= 7200, km >= 0.1, as
    the reference's verify task).  Missing required columns become a gate row."""
    missing = sorted(set(required) - set(df.columns))
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in not_null]
    aggs += [F.min(C.TARGET).alias("min_target"), F.max(C.TARGET).alias("max_target"),
             F.min("distance_km").alias("min_km")]
    row = df.agg(*aggs).withColumn("missing_columns", F.lit(len(missing)))
    specs = [("row_count", "rows", min_rows, "lt"), ("missing_columns", "missing_columns", 0, "gt")]
    specs += [(f"nulls:{c}", f"nulls_{c}", 0, "gt") for c in not_null]
    specs += [("min_target", "min_target", C.MIN_DURATION_S, "lt"),
              ("max_target", "max_target", C.MAX_DURATION_S, "gt"),
              ("min_distance_km", "min_km", C.MIN_DISTANCE_KM, "lt")]
    return _gate_rows(row, specs)


def sample_gate(df: DataFrame, fraction: float = 0.1, max_bad_gps_rate: float = C.MAX_BAD_GPS_RATE
                ) -> DataFrame:
    """A3 + B4 on a sample by key hash: an early look, never in place of ``quality_gates``."""
    from ..sources.tables import sample_scan
    s = sample_scan(df, fraction)
    lat = F.col("pickup_latitude")
    row = s.agg(F.count(F.lit(1)).alias("rows"),
                F.try_divide(F.count_if((lat < C.LAT_BOUNDS[0]) | (lat > C.LAT_BOUNDS[1])),
                             F.count(F.lit(1))).alias("bad_gps_rate"))
    return _gate_rows(row, [("sample_rows", "rows", 1, "lt"),
                            ("sample_bad_gps_rate", "bad_gps_rate", max_bad_gps_rate, "gt")])


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """B7 as a long table ``column, null_rate``."""
    n = F.count(F.lit(1))
    row = df.agg(*[F.try_divide(F.count_if(F.col(c).isNull()), n).alias(c) for c in columns])
    return row.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("double") for c in columns])))
        .alias("column", "null_rate"))


class GateViolation(ValueError):
    pass


def raise_on_violation(gates: DataFrame) -> None:
    """B11 verdict: gather every violated gate (a handful of rows), raise once."""
    bad = gates.where("violated").collect()
    if bad:
        text = "; ".join(f"{r.gate}: observed {r.observed} vs limit {r.limit}" for r in bad)
        raise GateViolation(f"{len(bad)} gate violation(s): {text}")
