"""Scans: driver tables, the trip view over ``events``, raw CSV trip files."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import KEY_COL, TIME_COL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table; column pruning / filter pushdown are Catalyst's."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


# The trip view over ``events`` (shared text with the DuckDB oracle, see
# ``plans.oracle.TRIP_VIEW_SQL``).  Column expressions are plain SQL so they
# stay inside whole-stage codegen.
TRIP_VIEW_EXPRS = [
    "cast(event_id as string) as id",
    "cast(1 + user_id % 2 as int) as vendor_id",
    "cast(date_trunc('second', ts) as timestamp) as pickup_datetime",
    "cast(user_id % 7 as int) as passenger_count",
    "case when event_id % 997 = 5 then 0e0 else -74.02e0 + (event_id * 53 % 1000) / 1e4 end"
    " as pickup_longitude",
    "case when event_id % 997 = 5 then 0e0 when event_id % 331 = 7 then 39e0"
    " else 40.6e0 + (event_id * 37 % 1000) * 3 / 1e4 end as pickup_latitude",
    "-74.02e0 + (event_id * 53 % 1000) / 1e4"
    " + case when event_id % 101 = 3 then 0e0 else (event_id * 17 % 100) / 1e4 end"
    " as dropoff_longitude",
    "40.6e0 + (event_id * 37 % 1000) * 3 / 1e4"
    " + case when event_id % 101 = 3 then 0e0 else (1 - 2 * (event_id % 2)) * value / 3e3 * (0.6e0 + (event_id * 104729 % 1000) / 1250e0) end as dropoff_latitude",
    "case when event_id % 50 = 0 then 'Y' else 'N' end as store_and_fwd_flag",
    "cast(floor(value * 20 * (0.75e0 + (event_id * 7919 % 1000) / 2e3)"
    " + case when hour(ts) in (7, 8, 9, 17, 18, 19) then 90 else 0 end"
    " + (user_id % 2) * 12 + (user_id % 7) * 3) as int) as trip_duration",
]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped trip table derived from ``events`` (11 raw columns)."""
    ev = table(spark, sf_dir, "events")
    df = ev.selectExpr(*TRIP_VIEW_EXPRS)
    return df.withColumn(
        "dropoff_datetime",
        F.col(TIME_COL) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0),
                                             F.col("trip_duration").cast("decimal(18,6)")),
    ).select("id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
             "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
             "store_and_fwd_flag", "trip_duration")


# -- raw CSV contract (A1, A2) ----------------------------------------------------
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("vendor_id", T.IntegerType()),
    T.StructField("pickup_datetime", T.TimestampType()),
    T.StructField("dropoff_datetime", T.TimestampType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("pickup_longitude", T.DoubleType()),
    T.StructField("pickup_latitude", T.DoubleType()),
    T.StructField("dropoff_longitude", T.DoubleType()),
    T.StructField("dropoff_latitude", T.DoubleType()),
    T.StructField("store_and_fwd_flag", T.StringType()),
    T.StructField("trip_duration", T.IntegerType()),
])

RAW_TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA])


def read_raw_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """Every raw column as text, so type failures can be *counted* (B2) rather than
    silently nulled.  Header names are kept as found (B1 checks them)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_raw_csv(spark: SparkSession, path: str, timestamp_format: str | None = None,
                 typed: bool = True) -> DataFrame:
    """A1/A2: CSV scan under the fixed raw schema with timestamp parsing.

    Uses ``try_cast``/``try_to_timestamp`` over a text scan, so a bad value becomes
    NULL instead of failing the job under ANSI mode; B2 counts those.
    """
    text = read_raw_csv_text(spark, path)
    if not typed:
        return text
    return typed_rows(text, timestamp_format)


#: Why a line does not fit the header.
CSV_FAULTS = ("unclosed quote", "too few fields", "too many fields")


def read_csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """A1/A2: a CSV scan that loses no line: the header's columns as text, ``_line``, ``_file`` and ``_fault``.

    ``_fault`` is NULL for a line that fits the header and else one of ``CSV_FAULTS``; the columns of
    a faulty line hold what could be read.  Lines are parsed one by one, so a quote that is never
    closed spoils its own line only.  The header is the first line, and any line equal to it (of
    other files) is left out.  Blank lines are no rows.
    """
    lines = spark.read.text(path).select(F.col("value").alias("_line"), F.col("_metadata.file_path").alias("_file")).where("trim(_line) <> ''")
    first = spark.read.text(path).limit(1).first()
    if first is None:
        return lines.withColumn("_fault", F.lit(None).cast("string"))
    header = first[0]
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, "_corrupt_record"]])
    parsed = F.from_csv("_line", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    commas = F.length(F.regexp_replace(F.regexp_replace("_line", '"[^"]*"', ""), "[^,]", ""))
    fault = (F.when(F.length(F.regexp_replace("_line", '[^"]', "")) % 2 == 1, CSV_FAULTS[0]).when(commas < len(names) - 1, CSV_FAULTS[1])
             .when(commas > len(names) - 1, CSV_FAULTS[2]).when(F.col("_p._corrupt_record").isNotNull(), CSV_FAULTS[1]))
    read = lines.where(F.col("_line") != F.lit(header)).withColumn("_p", parsed)
    return read.select(*[F.col(f"_p.`{n}`").alias(n) for n in names], "_line", "_file", fault.alias("_fault"))


def split_corrupt(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of lines that fit the header, as text columns; _file, _line, _fault of the others)."""
    good = lines.where("_fault is null").drop("_line", "_file", "_fault")
    return good, lines.where("_fault is not null").select("_file", "_line", "_fault")


def typed_rows(text: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """Raw text columns under the fixed raw schema; a bad value becomes NULL."""
    cols = []
    for f in RAW_SCHEMA:
        if f.name not in text.columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = (F.try_to_timestamp(c, F.lit(timestamp_format)) if timestamp_format
                 else F.try_to_timestamp(c))
        elif not isinstance(f.dataType, T.StringType):
            c = F.expr(f"try_cast(`{f.name}` as {f.dataType.simpleString()})")
        cols.append(c.alias(f.name))
    return text.select(*cols)


def key_hash(key: str = KEY_COL, seed: int = 42) -> Column:
    """A multiplicative hash of an integer key in [0, 2**32), the same in any SQL engine."""
    return (F.col(key).cast("long") * F.lit(2654435761) + F.lit(seed)) % F.lit(4294967296)


def sample_scan(df: DataFrame, fraction: float = 0.1, key: str = KEY_COL) -> DataFrame:
    """Deterministic sample - a fraction of all rows by key hash; a filter, no sort."""
    return df.where(key_hash(key) < F.lit(int(fraction * 4294967296)))
