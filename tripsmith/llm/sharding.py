"""Operator 3: sharding by vector bin packing.

All rows of equal text form a group, a vector of bytes, tokens and rows.  Groups go into
shards largest first, each to the shard whose residual capacity has the highest dot
product with the group's vector, so that all three measures come out nearly equal
(law ``bytes``: the byte sizes of shards are near equal).

How it scales
  * Groups above ``HEAVY`` of a shard's capacity, a number bounded by the shard count,
    are placed first, on the driver.  All others are dealt into slices of about ``SLICE``
    groups; each task packs its slice into shares of the residual capacities, which
    are in proportion to what the slice weighs.
  * A group above a shard's capacity (a hot text) is cut into pieces by a hash
    of doc_id; smaller groups stay whole.
  * Slots come from counts per (shard, bucket): no task numbers a whole shard.

Results: one row per input row: doc_id, size, text_crc32, shard, slot.  Null texts count
as empty (size ``ROW_BYTES``, checksum 0).  Rows without doc_id are placed like others, and those of
a hot text dealt over its pieces by their place;
equal rows that repeat get different slots.  Fewer groups than shards leave shards empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tripsmith.llm.common import materialise, release

SHARDS = 40
#: Bytes that a row takes besides its text.
ROW_BYTES = 16
SPLIT, HEAVY = 1, 1 / 64
PIECES, SLICE, SLOT_BUCKET = 4096, 20_000, 2_000

_MEASURES = ["_bytes", "_tokens", "_rows"]


def pack(items: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each item (rows: vectors), largest first; ``residual`` (shards x measures) is updated."""
    scale = np.maximum(residual.sum(axis=0), 1e-12)
    scaled, left = items / scale, residual / scale
    out = np.empty(len(items), np.int32)
    for i in np.argsort(-scaled.max(axis=1, initial=0), kind="stable"):
        v = scaled[i]
        out[i] = s = int((left @ v).argmax())
        left[s] -= v
    residual[:] = left * scale
    return out


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # a row without id is dealt by its place, so that many of them do not stay together
    docs = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text"), F.coalesce(
        F.col(id_col).cast("long"), F.monotonically_increasing_id()).alias("_deal"))
    text = F.col("_text")
    return docs.select(
        F.col("_id").alias("doc_id"), "_deal", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("_t"), F.md5(text.cast("binary")).alias("_key"),
        F.pmod(F.xxhash64("_deal"), F.lit(PIECES)).cast("int").alias("_piece"))


def assign_shards(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row."""
    rows = materialise(_groups(docs, id_col, text_col), "rows")
    measures = [F.sum("size").alias("_bytes"), F.sum("_t").alias("_tokens"), F.count("*").alias("_rows")]
    pieces = materialise(rows.groupBy("_key", "_piece").agg(*measures), "pieces")
    groups = pieces.groupBy("_key").agg(*(F.sum(c).alias(c) for c in _MEASURES))
    total = groups.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _MEASURES), F.count("*").alias("n")).first()
    capacity = np.array([total[c] / shards for c in _MEASURES])

    def above(part: float):
        return sum(((F.col(c) > max(float(k * part), 1.0)).cast("int") for c, k in zip(_MEASURES, capacity)), F.lit(0)) > 0

    hot = materialise(groups.select("_key", above(SPLIT).alias("_hot")), "hot")
    unit = F.when(F.col("_hot"), F.col("_piece")).otherwise(F.lit(-1)).alias("_unit")
    parts = materialise(pieces.join(hot, "_key").select("_key", "_piece", unit, *_MEASURES), "parts")
    units = parts.groupBy("_key", "_unit").agg(*(F.sum(c).alias(c) for c in _MEASURES)).withColumn("_heavy", above(HEAVY))
    units = materialise(units, "units")

    # at most 3 x shards / HEAVY rows, and pieces of hot groups beyond it only if above it themselves
    heavy = units.where("_heavy").orderBy("_key", "_unit").toPandas()
    residual = np.repeat(capacity[None, :], shards, axis=0)
    heavy["_shard"] = pack(heavy[_MEASURES].to_numpy(float), residual)
    share = np.maximum(residual, 0)
    share = share / np.maximum(share.sum(axis=0), 1e-12)

    def pack_slice(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_key", "_unit"], ignore_index=True)
        items = part[_MEASURES].to_numpy(float)
        part["_shard"] = pack(items, share * items.sum(axis=0))
        return part[["_key", "_unit", "_shard"]]

    slices = max(1, -(-total["n"] // SLICE))
    schema = "_key string, _unit int, _shard int"
    light = (units.where("not _heavy").withColumn("_slice", F.pmod(F.xxhash64("_key", "_unit"), F.lit(slices)))
             .groupBy("_slice").applyInPandas(lambda part: pack_slice(part.drop(columns="_slice")), schema))
    placed = light.unionAll(docs.sparkSession.createDataFrame(
        [(k, int(u), int(s)) for k, u, s in zip(heavy["_key"], heavy["_unit"], heavy["_shard"])], schema))
    placed = materialise(placed, "placed")
    placed = materialise(parts.select("_key", "_piece", "_unit").join(placed, ["_key", "_unit"])
                         .select("_key", "_piece", F.col("_shard").alias("shard")), "homes")

    release(hot, pieces, units, parts)

    buckets = max(1, -(-total["_rows"] // (shards * SLOT_BUCKET)))
    out = materialise(
        rows.join(placed, ["_key", "_piece"])
        .select("doc_id", "size", "text_crc32", "shard",
                F.pmod(F.xxhash64("_deal", "text_crc32"), F.lit(buckets)).alias("_bucket")), "sharded")
    counts = out.groupBy("shard", "_bucket").count()
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = materialise(counts.select("shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_at")),
                         "starts")
    within = W.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = out.withColumn("_r", F.row_number().over(within)).join(starts, ["shard", "_bucket"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("_at") + F.col("_r") - 1).alias("slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write ``docs`` as one folder per shard (``_shard``), with ``_slot``, by the doc_ids (unique, not
    null) of ``assigned``."""
    homes = assigned.select(F.col("doc_id").alias("_home_of"), F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    (docs.join(homes, docs["doc_id"] == homes["_home_of"]).drop("_home_of")
     .repartition("_shard", F.floor(F.col("_slot") / 100_000)).write.partitionBy("_shard").parquet(path))
