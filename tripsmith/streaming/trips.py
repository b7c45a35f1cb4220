"""Structured Streaming forms of the trip operators.

The batch operators are DataFrame -> DataFrame functions, so the stateless
ones (cleaning, feature engineering, request features) run unchanged on a
streaming DataFrame.  Stateful ones use watermarks so state stays bounded.
Sinks and checkpoints live under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import clean as CL
from ..operators import gates as G
from ..session import checkpoint_dir
from ..sources.tables import TRIP_VIEW_EXPRS


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


#: Cuts of the event feed, a file each, and the rows that arrive with the last file instead of theirs.
FEED_CUTS = ["2024-01-08", "2024-01-15", "2024-01-22", "2024-01-24", "2024-01-26"]
FEED_LATE = "event_id % 50 = 7 and ts < timestamp '2024-01-08'"


def write_feed(events: DataFrame, path: str, spoil: str | None = None, parts: Sequence[int] | None = None) -> None:
    """Write events as a feed of files in arrival order, one folder each, for replay as a stream.

    Some rows arrive late and so out of order (``FEED_LATE``).  Rows that meet the SQL predicate
    ``spoil`` get a negative outcome.  ``parts`` writes only some files, to go on later.
    """
    part = F.lit(0)
    for cut in FEED_CUTS:
        part = part + (F.col("ts") >= F.to_timestamp(F.lit(cut))).cast("int")
    part = F.when(F.expr(FEED_LATE), len(FEED_CUTS)).otherwise(part)
    if spoil:
        events = events.withColumn("value", F.when(F.expr(spoil), F.lit(-1000.0)).otherwise(F.col("value")))
    for k in range(len(FEED_CUTS) + 1) if parts is None else parts:
        events.where(part == k).write.parquet(os.path.join(path, f"arrival={k:03d}"))


def replay(events: DataFrame, base: str, query: Callable[[Callable[[], DataFrame]], DataFrame], run: Callable[..., str] | None = None,
           spoil: str | None = None) -> str:
    """Write the feed under ``base`` arrival by arrival and run ``query`` on each from one checkpoint, by
    ``run`` (default: ``run_to_table``); the sink's path.  ``query`` gets a function that opens the stream.

    An arrival is one micro-batch however many files it has, so the number of batches does not grow
    with the events.  Each run goes on where the one before stopped.
    """
    run, feed, last = run or run_to_table, os.path.join(base, "feed"), len(FEED_CUTS)
    for part in range(last + 1):
        write_feed(events, feed, spoil, [part])
        path = run(query(lambda: events_stream(events.sparkSession, feed, None)), base, more=part < last)
    return path


def events_stream(spark: SparkSession, feed: str, max_files_per_trigger: int | None = 1) -> DataFrame:
    """File-stream source over a feed of event files; by default a micro-batch per file, with None one for all new files."""
    r = spark.readStream.schema(spark.read.option("recursiveFileLookup", True).parquet(feed).schema) \
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(feed)


def trip_stream(events: DataFrame) -> DataFrame:
    """Raw-shaped trips from the events stream (same expressions as batch)."""
    return events.selectExpr(*TRIP_VIEW_EXPRS)


def stream_features(raw_trips: DataFrame, profile: str = "full") -> DataFrame:
    """Stateless clean + engineer on a stream (append)."""
    return CL.processed(raw_trips, profile)


def run_to_table(df: DataFrame, base: str, output_mode: str = "append",
                 foreach_batch: Callable | None = None, more: bool = False) -> str:
    """Run a streaming query to completion over the data available now; the path of its Parquet sink.

    Sink and checkpoint live under ``base``.  Called again with the same ``base`` (after a
    stop or a failure) the query goes on where it was: no file is read twice.  With ``more`` to come
    no batch without data follows the last one; the next run's first batch has its watermark.
    """
    out, ck = os.path.join(base, "out"), os.path.join(base, "checkpoint")
    w = df.writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
    conf, name = df.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    if more:
        conf.set(name, "false")
    try:
        if foreach_batch is not None:
            q = w.foreachBatch(lambda b, epoch: foreach_batch(b, epoch, out)).outputMode(output_mode).start()
        else:
            q = w.format("parquet").outputMode(output_mode).start(out)
    finally:
        conf.set(name, before)
    q.awaitTermination()
    return out


def _batch_path(out: str, kind: str, epoch: int) -> str:
    """A folder per micro-batch: a batch that is tried again overwrites what it wrote."""
    return os.path.join(out, kind, f"batch_id={epoch}")


def gate_batches(min_rows: int = 1, **gate_kwargs) -> Callable:
    """Per micro-batch, run the one-pass gates; write the gate rows to ``<out>/gates`` and
    the batch to ``<out>/batches`` with ``outcome`` = accepted / quarantine (a violated
    gate quarantines the whole batch)."""
    def run(batch: DataFrame, epoch: int, out: str) -> None:
        batch = batch.persist()
        gates = G.quality_gates(batch, min_rows=min_rows, **gate_kwargs).persist()
        gates.write.mode("overwrite").parquet(_batch_path(out, "gates", epoch))
        bad = gates.where("violated").limit(1).count() > 0
        batch.withColumn("outcome", F.lit("quarantine" if bad else "accepted")).write.mode(
            "overwrite").parquet(_batch_path(out, "batches", epoch))
        gates.unpersist()
        batch.unpersist()
    return run


def demand_windows(processed: DataFrame, ts: str = C.TIME_COL, window: str = "60 minutes",
                   slide: str = "5 minutes", watermark: str = "2 hours") -> DataFrame:
    """Trips per sliding window.  Slide-granular (not the exact per-row F1);
    the watermark bounds the state to ``window + watermark`` of event time."""
    return (processed.withWatermark(ts, watermark)
            .groupBy(F.window(ts, window, slide).alias("w"))
            .agg(F.count(F.lit(1)).alias("trips"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "trips"))


def upsert_latest() -> Callable:
    """foreachBatch body for ``update`` mode: the rows a micro-batch updates, a folder per batch;
    ``latest_rows`` keeps the last version per key."""
    def run(batch: DataFrame, epoch: int, out: str) -> None:
        batch.write.mode("overwrite").parquet(_batch_path(out, "versions", epoch))
    return run


def latest_rows(spark: SparkSession, out: str, key_cols: Sequence[str]) -> DataFrame:
    """The last version of each key: a map-side maximum, no window."""
    df = spark.read.parquet(os.path.join(out, "versions"))
    rest = [c for c in df.columns if c not in (*key_cols, "batch_id")]
    return df.groupBy(*key_cols).agg(F.max_by(F.struct(*rest), "batch_id").alias("_v")).select(*key_cols, "_v.*")


def compact_latest(spark: SparkSession, out: str, key_cols: Sequence[str], path: str) -> None:
    """Write only the last versions to a new folder, so that older ones can be dropped."""
    latest_rows(spark, out, key_cols).write.mode("overwrite").parquet(path)


def score_stream(stream: DataFrame, lookup: DataFrame, fallback_mean: DataFrame,
                 bins: DataFrame | None = None, threshold: float = C.OVERRIDE_THRESHOLD) -> DataFrame:
    """Stream-static join with the lookup model (<= 168 rows, broadcast);
    when a spike-bin table is given, rows whose spike probability exceeds
    ``threshold`` fall back to the historical mean (level-2 override)."""
    from ..operators.calibration import spike_probability
    from ..operators.models import predict_lookup
    scored = predict_lookup(stream, lookup, fallback_mean)
    if bins is None:
        return scored
    hm = fallback_mean.select(F.col("global_mean").alias("_hm"))
    p = spike_probability(scored, bins).crossJoin(F.broadcast(hm))
    return p.withColumn("served_prediction", F.when(F.col("spike_prob") > threshold, F.col("_hm"))
                        .otherwise(F.col("prediction"))).drop("_hm")


def delayed_label_join(predictions: DataFrame, outcomes: DataFrame, key: str = C.KEY_COL,
                       pred_ts: str = "pred_ts", outcome_ts: str = "outcome_ts",
                       max_delay: str = "3 hours", watermark: str = "3 hours") -> DataFrame:
    """Stream-stream inner join of predictions with later-arriving outcomes on
    the key, bounded in time so both sides' state is dropped after the watermark."""
    p = predictions.withWatermark(pred_ts, watermark).alias("p")
    o = outcomes.withWatermark(outcome_ts, watermark).alias("o")
    cond = ((F.col(f"p.{key}") == F.col(f"o.{key}"))
            & (F.col(f"o.{outcome_ts}") >= F.col(f"p.{pred_ts}"))
            & (F.col(f"o.{outcome_ts}") <= F.col(f"p.{pred_ts}") + F.expr(f"INTERVAL {max_delay}")))
    return p.join(o, cond, "inner")


def windowed_error_metrics(joined: DataFrame, actual: str, pred: str, ts: str,
                           window: str = "1 day") -> DataFrame:
    """N5 (cont.): tumbling-window error metrics of the joined stream, each window once the
    watermark has passed it.  The p95 uses ``approx_percentile`` (a bounded sketch)."""
    e = F.col(actual).cast("double") - F.col(pred).cast("double")
    return (joined.groupBy(F.window(ts, window).alias("w"))
            .agg(F.count(F.lit(1)).alias("rows"), F.sqrt(F.avg(e * e)).alias("rmse_seconds"),
                 F.avg(e).alias("mean_error_seconds"),
                 F.approx_percentile(F.abs(e), 0.95, 10000).alias("p95_error_seconds"))
            .select(F.col("w.start").alias("window_start"), "rows", "rmse_seconds",
                    "mean_error_seconds", "p95_error_seconds"))
