"""Sinks and lineage records.

Writes are idempotent overwrites of directory datasets.  The table fingerprint
replaces a file md5 (meaningless for many part files) with an order-insensitive
hash computed in one aggregation pass.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads again."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_size_bytes(spark: SparkSession, path: str) -> int:
    """Total bytes under ``path`` via the Hadoop FileSystem of that path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                  compression: str = "snappy") -> int:
    """A5: overwrite a Parquet dataset; returns its size in whole MB."""
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path_size_bytes(df.sparkSession, path) // (1024 * 1024)


def write_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> tuple[int, int]:
    """A5 + B13: write a Parquet dataset to a new folder; (rows that went into the write, size in MB).

    The rows are counted by the write job itself, so they can be compared with what is read back.
    """
    seen = Observation("written")
    size = write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by)
    return int(seen.get["rows"]), size


def quarantine(bad: DataFrame, path: str) -> DataFrame:
    """Keep lines that did not fit apart, dealt by fault; (fault, lines) of what is now stored."""
    bad.write.mode("overwrite").partitionBy("_fault").parquet(path)
    return bad.sparkSession.read.schema(bad.schema).parquet(path).groupBy(F.col("_fault").alias("fault")).agg(F.count(F.lit(1)).alias("lines"))


def handshake(spark: SparkSession, path: str, written: int) -> DataFrame:
    """rows_written, rows_read, matches - the count taken while writing against the files."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows_read")).select(
        F.lit(written).cast("long").alias("rows_written"), "rows_read",
        (F.col("rows_read") == F.lit(written)).alias("matches"))


def _canonical(name: str, kind: str) -> Column:
    """A value as text that any SQL engine writes alike; NULL is ``N``, text carries its length."""
    c = F.col(f"`{name}`")
    if kind in ("double", "float"):
        text = F.floor(c.cast("double") * 1e6 + 0.5).cast("long").cast("string")
    elif kind == "timestamp":
        text = F.unix_micros(c).cast("string")
    elif kind == "string":
        text = F.concat(F.length(c).cast("string"), F.lit(":"), c)
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit("N"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """``rows`` and an order-insensitive ``fingerprint``: the exact sum of a 60-bit hash of each
    row's canonical text (doubles to 6 decimals).  NULLs and the place of values count.  Same
    content -> same value, whatever the partitioning or file layout."""
    row = F.concat_ws("|", *[_canonical(n, k) for n, k in df.dtypes])
    h = F.conv(F.substring(F.md5(row.cast("binary")), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(h), F.lit(0).cast("decimal(38,0)")).cast("string")
                  .alias("fingerprint"))


MANIFEST_SCHEMA = T.StructType([
    T.StructField("processed_at", T.StringType()),
    T.StructField("raw_source", T.StringType()),
    T.StructField("processed_output", T.StringType()),
    T.StructField("rows_after_cleaning", T.LongType()),
    T.StructField("processed_hash", T.StringType()),
    T.StructField("cleaning_rules", T.StructType([
        T.StructField("min_duration_seconds", T.IntegerType()),
        T.StructField("max_duration_seconds", T.IntegerType()),
        T.StructField("min_distance_km", T.DoubleType()),
        T.StructField("min_passenger_count", T.IntegerType()),
        T.StructField("lat_bounds", T.ArrayType(T.DoubleType())),
        T.StructField("lon_bounds", T.ArrayType(T.DoubleType())),
    ])),
    T.StructField("output_columns", T.ArrayType(T.StringType())),
    T.StructField("parquet_size_mb", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("execution_date", T.StringType()),
])


def manifest(processed: DataFrame, raw_source: str, processed_output: str,
             size_mb: int | None = None, run_id: str | None = None,
             execution_date: str | None = None) -> DataFrame:
    """A7 + A8: one-row lineage record; rows and hash come from one pass over the
    processed table (no driver-side data)."""
    fp = table_fingerprint(processed)
    rules = F.struct(
        F.lit(C.MIN_DURATION_S).alias("min_duration_seconds"),
        F.lit(C.MAX_DURATION_S).alias("max_duration_seconds"),
        F.lit(C.MIN_DISTANCE_KM).alias("min_distance_km"),
        F.lit(C.MIN_PASSENGERS + 1).alias("min_passenger_count"),
        F.array(*[F.lit(float(x)) for x in C.LAT_BOUNDS]).alias("lat_bounds"),
        F.array(*[F.lit(float(x)) for x in C.LON_BOUNDS]).alias("lon_bounds"))
    now = _dt.datetime.now(_dt.timezone.utc).isoformat()
    return fp.select(
        F.lit(now).alias("processed_at"), F.lit(raw_source).alias("raw_source"),
        F.lit(processed_output).alias("processed_output"),
        F.col("rows").cast("long").alias("rows_after_cleaning"),
        F.col("fingerprint").alias("processed_hash"), rules.alias("cleaning_rules"),
        F.array(*[F.lit(c) for c in C.PROCESSED_COLUMNS]).alias("output_columns"),
        F.lit(size_mb).cast("long").alias("parquet_size_mb"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(execution_date).cast("string").alias("execution_date"))


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """Add a run's metric rows to a metrics table, partitioned by run and model.  Writing a run
    again replaces its rows."""
    (metrics.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "model").parquet(path))


def one_run(metrics: DataFrame, run_id: str) -> DataFrame:
    """The metric rows of one run: comparisons expect one row per model."""
    return metrics.where(F.col("run_id") == run_id)


def load_metrics(metrics: DataFrame, expected: Sequence[str], model_col: str = "model",
                 fail_if_all_missing: bool = True) -> DataFrame:
    """A10: left join from the expected model list; ``found`` marks presence.
    Raises when none of the expected models has metrics (reference exits)."""
    spark = metrics.sparkSession
    exp = spark.createDataFrame([(m,) for m in expected], [model_col])
    out = exp.join(metrics.withColumn("found", F.lit(True)), model_col, "left").withColumn(
        "found", F.coalesce("found", F.lit(False)))
    if fail_if_all_missing and out.where("found").limit(1).count() == 0:
        raise FileNotFoundError("no metrics for any expected model")
    return out


def lineage_trace(metrics: DataFrame, manifests: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Model metrics -> manifest (by run id) -> fingerprint of the table read now (by its path,
    ``processed_output``); ``hash_matches`` shows whether the data changed, NULL if it is gone."""
    m = manifests.select("run_id", "raw_source", "processed_output", "rows_after_cleaning",
                         "processed_hash")
    now = fingerprints.select("processed_output", F.col("rows").alias("current_rows"),
                              F.col("fingerprint").alias("current_hash"))
    j = metrics.join(m, "run_id", "left").join(now, "processed_output", "left")
    return j.withColumn("hash_matches", F.col("processed_hash") == F.col("current_hash"))
