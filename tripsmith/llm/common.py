"""Small helpers shared by the text operators: table access, scratch tables, Arrow columns."""

from __future__ import annotations

import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsmith.session import checkpoint_dir

#: A-Z to a-z on UTF-8 bytes; every other byte stays.
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def ship_code(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from any working folder.

    On a cluster the package is installed or given with ``--py-files``, as usual.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().isLocal():
        sc.addFile(str(Path(__file__).resolve().parents[1]), recursive=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, forgets partitioning.

    A join on the result therefore has a plain exchange below it, which adaptive
    execution can split where a key is hot.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*frames: DataFrame) -> None:
    """Delete the files of materialised frames that nothing will read again."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a few numbers that a broadcast may hold: a few ten MB in memory.
BROADCAST_ROWS = 500_000


def sized(df: DataFrame, lists: str | None = None) -> DataFrame:
    """A materialised frame of a few numeric columns, marked for broadcast if its counted rows allow it
    (with ``lists``, a column of short lists: the entries of all lists and the rows).

    Larger frames stay unmarked, so the join shuffles and adaptive execution splits hot keys.
    """
    entries = df.agg(F.coalesce(F.sum(F.size(lists) + 1), F.lit(0))).first()[0] if lists else df.count()
    return F.broadcast(df) if entries <= BROADCAST_ROWS else df


def shuffled(df: DataFrame) -> DataFrame:
    """The frame, marked to be joined by sort and merge, however small Spark takes it to be.

    Spark sizes what a Python function or an explode returns by its input, and written tables by their compressed
    bytes, so a table that grows with the data may look small enough for a broadcast through the driver.
    """
    return df.hint("merge")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(offs):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0]:offs[-1]]
    return raw, offs - offs[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Cut a batch into row ranges of about ``limit`` text bytes (one row at least)."""
    _, offs = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two xor-shift-multiply rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
