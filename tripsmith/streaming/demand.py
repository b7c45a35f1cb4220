"""N3 exact: the per-row demand count (F1) of a stream, as keyed state with event-time timers.

A row at time T counts the rows with a value and ``T - lookback <= time < T``.  Rows are keyed by
time buckets of ``lookback / pieces``: a row is kept whole under its own bucket, and its time alone
under the following ``pieces`` buckets, whose rows may count it.  No key therefore sees more than a
bucket's rows and the instants of a lookback; more pieces deal a busy hour over more keys.

State is a list of rows and a list of (instant, count), appended per micro-batch.  A timer at the end
of the bucket fires once the watermark has passed it: by then no row that belongs into it can still
be accepted, its rows are emitted with their counts, and its state is dropped.  Rows that come
behind the watermark are dropped by the engine under all their keys alike, so they are neither
emitted nor counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import config as C
from ..functions.time import epoch_micros
from .trips import run_to_table

HOUR_US = 3_600_000_000
#: The state store that keyed processors need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class DemandCounts(StatefulProcessor):
    """Rows of one bucket, counted when the watermark has passed its end."""

    def __init__(self, lookback_us: int, width_us: int, rows: T.StructType):
        self.lookback_us, self.width_us, self.rows_schema = lookback_us, width_us, rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.rows_schema)
        self.instants = handle.getListState("instants", "t long, n long")
        self.armed = handle.getValueState("armed", "b boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            own = part[part["home"].astype(bool)]
            if len(own):
                own = own[self.rows_schema.names].astype(object)
                self.rows.appendList(list(own.where(own.notna(), None).itertuples(index=False, name=None)))
            valued = part.loc[part["valued"].astype(bool), "at"].value_counts()
            if len(valued):
                self.instants.appendList([(int(t), int(n)) for t, n in valued.items()])
        if not self.armed.exists():
            self.armed.update((True,))
            self.handle.registerTimer((int(key[0]) + 1) * self.width_us // 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = list(self.rows.get())
        instants = sorted(self.instants.get())
        self.rows.clear()
        self.instants.clear()
        self.armed.clear()
        if rows:
            times = np.array([t for t, _ in instants], np.int64)
            before = np.concatenate([[0], np.cumsum([n for _, n in instants], dtype=np.int64)])
            out = pd.DataFrame(rows, columns=self.rows_schema.names)
            t = out["at"].to_numpy(np.int64)
            low, high = np.searchsorted(times, t - self.lookback_us, "left"), np.searchsorted(times, t, "left")
            out["n"] = before[high] - before[low]
            yield out

    def close(self) -> None:
        pass


def exact_demand(processed: DataFrame, keep: Sequence[str] = (C.KEY_COL,), ts: str = C.TIME_COL, value: str = C.TARGET,
                 lookback_us: int = HOUR_US, pieces: int = 1, watermark: str = "2 hours", out: str = "trip_count_last_1h") -> DataFrame:
    """``keep``, ``ts`` and the exact F1 count of every row of a stream that is not late (append).

    Rows without time take no part.  A row is emitted when the watermark passes the end of its
    bucket, so rows of the buckets behind the last watermark stay in the state until more data come.
    Needs the RocksDB state store (``STATE_STORE``).
    """
    if lookback_us % pieces:
        raise ValueError("pieces must divide the lookback")
    width = lookback_us // pieces
    kept = [c for c in keep if c != ts]
    # pandas takes no column names that begin with an underscore here, so the kept columns get plain ones
    plain = {f"c{i}": c for i, c in enumerate(kept)}
    rows = T.StructType([*(T.StructField(p, processed.schema[c].dataType) for p, c in plain.items()), T.StructField("at", T.LongType())])
    bucket = F.floor(F.col("at") / F.lit(width)).cast("long")
    copies = F.array(*[F.struct((bucket + k).alias("bucket"), F.lit(k == 0).alias("home")) for k in range(pieces + 1)])
    timed = processed.where(F.col(ts).isNotNull()).withWatermark(ts, watermark).select(
        F.col(ts).alias("time"), epoch_micros(ts).alias("at"), F.col(value).isNotNull().alias("valued"), *[F.col(c).alias(p) for p, c in plain.items()])
    keyed = timed.withColumn("copy", F.explode(copies)).select(
        F.col("copy.bucket").alias("bucket"), F.col("copy.home").alias("home"), "valued", "at", "time",
        *[F.when(F.col("copy.home"), F.col(p)).alias(p) for p in plain])
    schema = T.StructType([*rows.fields, T.StructField("n", T.LongType())])
    counted = keyed.groupBy("bucket").transformWithStateInPandas(
        DemandCounts(lookback_us, width, rows), outputStructType=schema, outputMode="Append", timeMode="EventTime")
    return counted.select(*[F.col(p).alias(c) for p, c in plain.items()], F.timestamp_micros("at").alias(ts), F.col("n").alias(out))


def run_exact(demand: DataFrame, base: str, more: bool = False) -> str:
    """Run an exact demand query over the data available now; its sink's path.  The state store is set
    for this query only; called again with the same ``base`` it goes on where it was."""
    conf, name = demand.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, STATE_STORE)
    try:
        return run_to_table(demand, base, more=more)
    finally:
        conf.set(name, before)
