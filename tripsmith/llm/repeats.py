"""Operator 6: removal of repeated byte strings by suffix arrays.

Every byte covered by a ``LENGTH``-byte string that starts at two places or more of the
corpus goes.  Strings lie within one text; starts may overlap and may be in one text.

How it scales
  * Each start belongs to the anchor of its string: the ``GRAM``-byte sequence with the
    smallest hash in it, leftmost if tied.  Equal strings have equal anchors, so starts
    are dealt out by anchor.  Consecutive starts of one anchor form a run; the bytes that
    its strings cover are its context (``LENGTH`` to about 2 x ``LENGTH`` bytes).
  * Only anchors with two runs or more matter.  Equal contexts are aggregated and sent
    once, with their number.  Of a string and its anchor, either the (LENGTH - GRAM) / 2
    bytes before the gram or those after it lie in the string; a context that occurs once and shares
    neither with another context holds no repeated string and is not sent.
  * Contexts are dealt by anchor into shards of about ``SHARD_BYTES``.  A task builds a
    shard's suffix array by induced sorting and its permuted common prefixes; starts
    whose neighbours in the array share ``LENGTH`` bytes form a class, which repeats if its
    contexts number two or more.
  * An anchor with more than ``HOT`` different contexts (a frequent phrase in many
    surroundings) would outgrow a shard: its strings are counted by 128-bit digest instead.

Results: one row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.  A
null or empty text has 0 bytes, as have texts shorter than ``LENGTH`` no removed bytes.
Rows that repeat are copies of each other.  Cuts may fall inside a character.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsmith.llm.common import BROADCAST_ROWS, materialise, mix64, release, sized, slices, utf8
from tripsmith.llm.suffix_array import common_prefixes, suffix_array

LENGTH, GRAM = 400, 32
SHARD_BYTES = 2 << 20
HOT = 1000
PIECE = 4 << 20
CACHED = 1 << 16  # bytes whose hashes stay in a core's cache

_SYMBOL = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_SPANS = pa.list_(pa.struct([("_from", pa.int32()), ("_to", pa.int32())]))
_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position (GRAM is a power of two)."""
    h, width = _SYMBOL[x], 1
    while width < GRAM:
        h = mix64(h[:-width] * _MULTIPLIER + h[width:]) if len(h) > width else h[:0]
        width *= 2
    return h


def anchors(x: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(anchor position by start, gram hash by position) of the starts in a byte array."""
    h = gram_hashes(x)
    width = length - GRAM + 1
    if len(h) < width:
        return np.zeros(0, np.int64), h
    low = (h >> np.uint64(32) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64), h


def runs(x: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """(row, start in its text, number of starts, anchor hash, start in x, anchor in x) of every run."""
    size = np.diff(offsets)
    at, h = anchors(x, length)
    row = np.repeat(np.arange(len(size)), size)[:len(at)]
    valid = np.arange(len(at)) + length <= offsets[row + 1]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(at)])))
    ok = valid[first]
    first, count = first[ok], count[ok]
    return row[first], first - offsets[row[first]], count, h[at[first]].view(np.int64), first, at[first]


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    """_k, _t (row key), _lo, _m (starts), _a (anchor), _c (context digest), _l and _r (digests beside the gram) of every run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", min(CACHED, PIECE)):
                x, offsets = utf8(part.column("_text"))
                for base in range(0, len(x), PIECE):  # more than one piece only of one long text
                    piece = x[base:base + PIECE + length - 1]
                    cut = offsets if len(x) <= PIECE + length - 1 else np.array([0, len(piece)])
                    row, lo, m, a, at, gram = runs(piece, cut, length)
                    raw, half = piece.tobytes(), (length - GRAM) // 2
                    ends = at + m + length - 1
                    c = [xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(at.tolist(), ends.tolist())]
                    left = [xxhash.xxh32_intdigest(raw[p - half:p]) if p - half >= s else None for s, p in zip(at.tolist(), gram.tolist())]
                    right = [xxhash.xxh32_intdigest(raw[p:p + GRAM + half]) if p + GRAM + half <= e else None
                             for p, e in zip(gram.tolist(), ends.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_k").take(pa.array(row)), part.column("_t").take(pa.array(row)), pa.array(lo + base, pa.int64()),
                         pa.array(m, pa.int32()), pa.array(a), pa.array(np.array(c, np.uint64).view(np.int64)),
                         pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["_k", "_t", "_lo", "_m", "_a", "_c", "_l", "_r"])
                    if len(x) <= PIECE + length - 1:
                        break

    return docs.mapInArrow(run, "_k long, _t long, _lo long, _m int, _a long, _c long, _l long, _r long")


def repeated(contexts: list[bytes], numbers: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """Per context, its starts whose string occurs twice or more; numbers: copies of each context."""
    size = np.array([len(c) for c in contexts])
    end = np.cumsum(size + 1) - 1
    begin = end - size
    t = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8) + np.uint8(1)  # no UTF-8 byte is 255: it ends contexts, as 0
    sa = suffix_array(t)
    prefix = common_prefixes(t, sa)
    of = np.repeat(np.arange(len(size)), size + 1)
    whole = (end[of] - np.arange(len(t)) >= length)[sa]
    joined = (prefix[sa] >= length) & whole
    joined[1:] &= whole[:-1]
    joined[0] = False
    group = np.cumsum(~joined)
    copies = np.bincount(group, np.where(whole, np.array(numbers)[of[sa]], 0))
    flag = np.zeros(len(t), bool)
    flag[sa] = whole & (copies[group] >= 2)
    return [np.flatnonzero(flag[b:b + s]) for b, s in zip(begin.tolist(), size.tolist())]


def spans(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Covered [from, to) of sorted starts."""
    if not len(starts):
        return []
    gap = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.concatenate(([0], gap + 1))].tolist(), (starts[np.concatenate((gap, [len(starts) - 1]))] + length).tolist()))


def _send(docs: DataFrame, length: int) -> DataFrame:
    """Contexts (_kind 0: _bytes) and, of hot anchors, digests of their strings (_kind 1: _off, _d1, _d2)."""
    schema = "_kind int, _shard long, _a long, _c long, _n long, _bytes binary, _off int, _d1 long, _d2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_pydict({n: [r[i] for r in rows] for i, n in enumerate(names)}, schema=arrow)

        names = [c.split()[0] for c in schema.split(", ")]
        types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
        arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])
        for batch in batches:
            held: list[tuple] = []
            for text, wanted in zip(batch.column("_text"), batch.column("_wanted")):
                raw = text.as_buffer().to_pybytes()
                for w in wanted.as_py():
                    context = raw[w["_lo"]:w["_lo"] + w["_m"] + length - 1]
                    if not w["_hot"]:
                        held.append((0, w["_shard"], w["_a"], w["_c"], w["_n"], context, None, None, None))
                        continue
                    for off in range(w["_m"]):
                        d = np.frombuffer(xxhash.xxh3_128_digest(context[off:off + length]), np.int64).tolist()
                        held.append((1, None, w["_a"], w["_c"], w["_n"], None, off, *d))
                if len(held) > 2000:
                    yield out(held)
                    held = []
            yield out(held)

    return docs.mapInArrow(run, schema)


def _sorted_shards(contexts: DataFrame, length: int) -> DataFrame:
    """_a, _c, _spans of contexts with repeated strings, by the suffix array of each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            found = []
            if held:
                for row, starts in zip(held, repeated([r[2] for r in held], [r[3] for r in held], length)):
                    if len(starts):
                        found.append((row[0], row[1], [{"_from": a, "_to": b} for a, b in spans(starts, length)]))
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([f[2] for f in found], _SPANS)], ["_a", "_c", "_spans"])

        shard, held = None, []
        for batch in batches:
            for s, a, c, b, n in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if s != shard:
                    yield done()
                    shard, held = s, []
                held.append((a, c, b, n))
        yield done()

    return (contexts.select("_shard", "_a", "_c", "_bytes", "_n").repartition("_shard").sortWithinPartitions("_shard", "_a", "_c")
            .mapInArrow(run, "_a long, _c long, _spans array<struct<_from:int,_to:int>>"))


def _merged(starts: DataFrame, length: int) -> DataFrame:
    """_a, _c, _spans of frames (_a, _c, _offs)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = [[{"_from": a, "_to": b} for a, b in spans(np.sort(np.array(o, np.int64)), length)] for o in batch.column("_offs").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_a"), batch.column("_c"), pa.array(merged, _SPANS)], ["_a", "_c", "_spans"])

    return starts.mapInArrow(run, "_a long, _c long, _spans array<struct<_from:int,_to:int>>")


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_text: bool = False,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("_text")).withColumns(
        {"_k": F.coalesce("_id", F.lit(-(1 << 63))), "_t": F.xxhash64("_text")})
    all_runs = materialise(_occurrences(own.where(F.octet_length("_text") >= length).select("_k", "_t", "_text"), length), "runs")
    shared = materialise(all_runs.groupBy("_a").count().where("count > 1").select("_a"), "anchors")
    occurrences = materialise(all_runs.join(shared, "_a"), "occurrences")
    release(all_runs, shared)
    contexts = materialise(occurrences.groupBy("_a", "_c").agg(
        F.count("*").alias("_n"), F.first("_m").alias("_m"), F.first("_l").alias("_l"), F.first("_r").alias("_r"),
        F.min(F.struct("_k", "_t", "_lo")).alias("_at")), "contexts")
    halves = contexts.select("_a", "_c", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("_l").alias("half")), F.struct(F.lit(1).alias("side"), F.col("_r").alias("half")))).alias("_x"))
    halves = halves.select("_a", "_c", "_x.side", "_x.half").where("half is not null")
    common = materialise(halves.groupBy("_a", "side", "half").count().where("count > 1").drop("count"), "halves")
    alike = materialise(halves.join(common, ["_a", "side", "half"]).select("_a", "_c").distinct(), "alike")
    sortable = materialise(contexts.where("_n > 1").unionByName(
        contexts.where("_n = 1").join(alike, ["_a", "_c"], "left_semi").select(*contexts.columns)), "sortable")
    release(contexts, common, alike)
    volume = sortable.agg(F.coalesce(F.sum(F.col("_m") + length), F.lit(0))).first()[0]
    shards = max(1, -(-volume // SHARD_BYTES))
    hot = materialise(sortable.groupBy("_a").count().where(F.col("count") > HOT).select("_a", F.lit(True).alias("_hot")), "hot")
    wanted = (sortable.join(hot, "_a", "left").select(
        "_at._k", "_at._t", F.struct("_at._lo", "_m", "_a", "_c", "_n", F.coalesce("_hot", F.lit(False)).alias("_hot"),
                                     F.pmod(F.xxhash64("_a"), F.lit(shards)).alias("_shard")).alias("_w"))
              .groupBy("_k", "_t").agg(F.collect_list("_w").alias("_wanted")))  # at most a text's runs
    wanted = materialise(wanted, "wanted")
    # rows that repeat hold the same contexts; any of them serves
    needed, keys = own.select("_k", "_t", "_text"), materialise(wanted.select("_k", "_t"), "keys")
    if keys.count() <= BROADCAST_ROWS:  # so other texts need not move
        needed = needed.join(F.broadcast(keys), ["_k", "_t"], "left_semi")
    sent = _send(needed.join(wanted, ["_k", "_t"]).select("_text", "_wanted"), length)
    sent = materialise(sent, "sent")
    release(sortable, hot, wanted, keys)
    once = sent.dropDuplicates(["_kind", "_a", "_c", "_off"])
    found = _sorted_shards(once.where("_kind = 0"), length)
    strings = materialise(once.where("_kind = 1").select("_a", "_c", "_n", "_off", "_d1", "_d2"), "strings")
    twice = materialise(strings.groupBy("_d1", "_d2").agg(F.sum("_n").alias("_s")).where("_s > 1").select("_d1", "_d2"), "twice")
    frequent = _merged(strings.join(twice, ["_d1", "_d2"]).groupBy("_a", "_c").agg(F.collect_set("_off").alias("_offs")), length)
    found = materialise(found.unionAll(frequent), "found")
    release(sent, strings, twice)
    removed = (occurrences.join(found, ["_a", "_c"]).select("_k", "_t", F.explode(F.transform("_spans", lambda s: F.struct(
        (s["_from"] + F.col("_lo")).alias("_from"), (s["_to"] + F.col("_lo")).alias("_to")))).alias("_s"))
               .groupBy("_k", "_t").agg(F.collect_set("_s").alias("_removed")))
    removed = materialise(removed, "removed")
    release(occurrences, found)

    fields = [("_id", "long", pa.int64()), ("_b", "long", pa.int64()), ("_r", "long", pa.int64()), ("_s", "long", pa.int64()),
              ("_h", "string", pa.string()), *([("_kept", "binary", pa.binary())] if keep_text else [])]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text, ranges in zip(batch.column("_id").to_pylist(), batch.column("_text"), batch.column("_removed").to_pylist()):
                raw = text.as_buffer().to_pybytes()
                kept, at, gone, end, n = [], 0, 0, -1, 0
                for a, b in sorted((r["_from"], r["_to"]) for r in ranges or ()):
                    if a > end:
                        n += 1
                        kept.append(raw[at:a])
                    gone += max(0, b - max(a, end))
                    end = at = max(end, b)
                kept.append(raw[at:])
                left = b"".join(kept)
                rows.append((i, len(raw), gone, n, hashlib.sha256(left).hexdigest(), left)[:len(fields)])
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f[2]) for k, f in enumerate(fields)], [f[0] for f in fields])

    out = own.join(sized(removed, "_removed"), ["_k", "_t"], "left").select("_id", "_text", "_removed").mapInArrow(
        cut, ", ".join(f"{n} {t}" for n, t, _ in fields))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    return out.select(*(F.col(f[0]).alias(n) for f, n in zip(fields, names)))
