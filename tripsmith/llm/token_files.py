"""Operator 13: token ids in Parquet files that can be read in part.

Rows are dealt into files by ranges of the id and encoded in order, so a file holds ascending
ids and the files follow each other.  Columns of the folder ``tokens``:

    doc_id, shard (number of the file), at (ids before the row in its file), n_tokens, ids

``ids`` is a list column of integers with an end id after each document, encoded by dictionary
or as deltas; the other columns are deltas of a few bits a row.  Row groups and pages have set
sizes, and Spark's writer adds a page index, so that a filter on ids, or on a range of tokens,
reads the pages that it needs.  The folder ``offsets`` has a row per file: shard, first_token
(ids of all files before it), n_tokens, n_docs.  It is written last: without it a folder is
not complete.  Metadata are read without the list column.

Results: a document per row.  Null and empty texts hold the end id alone.  Rows without id come
first.  Rows that share an id follow each other by a hash of the text; equal rows are kept as
often as they come.  A hot id is split over files.  Texts are encoded whole.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripsmith.llm.bpe import share_vocabulary
from tripsmith.llm.common import sized, slices, utf8

END_ID = 2
#: Text bytes a file holds on average.
FILE_BYTES = 64 << 20
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 64 << 10, 1_000
#: Text bytes encoded at once.
SLICE_BYTES = 4 << 20
#: Distinct stretches (some tens of bytes each) that a task remembers before it starts anew.
KNOWN = 1_000_000

TOKENS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("shard", T.IntegerType(), False), T.StructField("at", T.LongType(), False),
                       T.StructField("n_tokens", T.LongType(), False), T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)])
OFFSETS = "shard int, first_token long, n_tokens long, n_docs long"

_ENCODERS: dict = {}


class Encoder:
    """The tokenizers library over a vocabulary file, without truncation and padding."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.parted = parts_at_blanks(spec)
        #: Bytes that each id stands for: a byte-level vocabulary writes a letter a byte.
        vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.width = np.zeros(max([*vocab.values(), *special.values()]) + 1, np.int64)
        for word, i in vocab.items():
            self.width[i] = len(word)
        for word, i in special.items():
            self.width[i] = len(word.encode())
        self._forget()

    def _forget(self) -> None:
        self.names = pa.array([], pa.large_string())
        self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def fresh(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all names one after the other, ids per name).

        Names that begin with a single blank and end without white space are encoded in one call, and
        the ids dealt out again by the bytes they stand for; the others are encoded one by one.
        """
        plain = [n for n in names if n[0] == " " and len(n) > 1 and not n[1].isspace() and not n[-1].isspace()]
        if self.parted and len(plain) > 1:
            ids = np.array(self.each(["".join(plain)])[0], np.int32)
            ends = np.cumsum([len(n.encode()) for n in plain])
            reach = np.cumsum(self.width[ids])
            at = np.searchsorted(reach, ends)
            if len(reach) and reach[-1] == ends[-1] and np.array_equal(reach[at], ends):
                cut = [0, *(at + 1).tolist()]
                known = dict(zip(plain, zip(cut, cut[1:])))
                rest = [n for n in names if n not in known]
                known.update(zip(rest, [(len(names), np.array(x, np.int32)) for x in self.each(rest)]) if rest else ())
                parts = [k[1] if isinstance(k[1], np.ndarray) else ids[k[0]:k[1]] for k in map(known.__getitem__, names)]
                return np.concatenate(parts), np.array([len(x) for x in parts])
        parts = self.each(names)
        return np.array([i for x in parts for i in x], np.int32), np.array([len(x) for x in parts], np.int64)

    def encode(self, raw: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows one after the other, each row's ids and the end id; ids per row)."""
        starts, rows = stretches(raw, offsets) if self.parted else (offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(np.diff(offsets)))
        n = len(offsets) - 1
        order = np.full(len(starts) + n, -1)  # the stretches of each row, then the end
        if len(self.names) > KNOWN or len(self.ids) > 8 * KNOWN:
            self._forget()
        if len(starts):
            bounds = pa.py_buffer(np.append(starts, len(raw)))
            held = pa.LargeStringArray.from_buffers(len(starts), bounds, pa.py_buffer(np.ascontiguousarray(raw))).dictionary_encode()
            place = pa.compute.index_in(held.dictionary, value_set=self.names)
            new = held.dictionary.filter(pa.compute.is_null(place))
            if len(new):
                ids, size = self.fresh(new.to_pylist())
                self.names = pa.concat_arrays([self.names, new])
                self.ids, self.size = np.concatenate([self.ids, ids]), np.concatenate([self.size, size])
            where = place.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            where[where < 0] = np.arange(len(self.names) - len(new), len(self.names))
            order[np.arange(len(starts)) + rows] = where[held.indices.to_numpy(zero_copy_only=False)]
        # the end is the last of all stretches
        size, flat = np.append(self.size, 1), np.append(self.ids, np.int32(end_id))
        begin = np.cumsum(size) - size
        length = size[order]
        ends = np.cumsum(length)
        at = np.repeat(begin[order] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
        last = ends[np.cumsum(np.bincount(rows, minlength=n) + 1) - 1]
        return flat[at], np.diff(last, prepend=0)


def parts_at_blanks(spec: dict) -> bool:
    """Whether a vocabulary file cuts text by the byte-level pattern alone, so that a single blank between
    other characters always begins a piece."""
    cut = spec.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not spec.get("normalizer")
    return bool(plain) and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or any(c.isspace() for c in t["content"])
                                   for t in spec.get("added_tokens") or [])


#: Bytes of white space, and the bytes that white space beyond ASCII begins with and goes on with.
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 28, 29, 30, 31, 32])
_LEAD2, _REST2 = np.arange(256) == 0xC2, np.isin(np.arange(256), [0x85, 0xA0])
_LEAD3, _REST3 = np.isin(np.arange(256), [0xE1, 0xE2, 0xE3]), np.isin(np.arange(256), [0x80, 0x81, 0x9A])


def stretches(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, row) of each stretch.  A row begins one, and so does a blank that neither follows nor precedes
    white space; a few characters that only look like white space are left joined, which changes nothing."""
    wide = np.concatenate([np.zeros(3, np.uint8), raw, np.zeros(3, np.uint8)])
    at = np.flatnonzero(raw == 32)
    back = [wide[at + 3 - k] for k in (1, 2, 3)]
    ahead = [wide[at + 3 + k] for k in (1, 2)]
    joined = (_BLANK[back[0]] | (_REST2[back[0]] & _LEAD2[back[1]]) | (_REST3[back[1]] & _LEAD3[back[2]])
              | _BLANK[ahead[0]] | (_LEAD2[ahead[0]] & _REST2[ahead[1]]) | (_LEAD3[ahead[0]] & _REST3[ahead[1]]))
    first = offsets[:-1][np.diff(offsets) > 0]
    mark = np.zeros(len(raw), bool)
    mark[at[~joined]] = True
    mark[first] = True
    begins = np.flatnonzero(mark)
    return begins, np.searchsorted(offsets, begins, side="right") - 1


def _encoder(name: str) -> Encoder:
    """The task's encoder of a file that ``share_vocabulary`` has shipped."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(SparkFiles.get(name))
    return _ENCODERS[name]


def writer_options(encoding: str) -> dict[str, str]:
    """Options of Spark's Parquet writer: ``dictionary`` or ``delta`` for the ids, deltas for the rest."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding: {encoding}")
    return {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": str(encoding == "dictionary").lower(), "parquet.block.size": str(ROW_GROUP_BYTES),
            "parquet.page.size": str(PAGE_BYTES), "parquet.page.row.count.limit": str(PAGE_ROWS), "compression": "zstd"}


def write_tokens(docs: DataFrame, path: str, vocabulary: str, encoding: str = "dictionary", end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text and write ``path``/tokens and ``path``/offsets."""
    spark = docs.sparkSession
    name = share_vocabulary(spark, vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, at = _encoder(name), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, size = encoder.encode(*utf8(part.column("text")), end_id)
                ends = np.cumsum(size)
                yield pa.record_batch([
                    part.column("doc_id"), pa.array(np.full(len(size), shard, np.int32)), pa.array(at + ends - size), pa.array(size),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))], TOKENS.names)
                at += int(ends[-1])

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(spark.sparkContext.defaultParallelism, -(-held // FILE_BYTES))
    order = ["doc_id", "_hash", "_row"]
    own = own.withColumns({"_hash": F.xxhash64("text"), "_row": F.monotonically_increasing_id()})
    rows = own.repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(encode, TOKENS).write.options(**writer_options(encoding)).parquet(f"{path}/tokens")
    totals = _files(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    first = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token")
    totals.select("shard", first, "n_tokens", "n_docs").coalesce(1).write.parquet(f"{path}/offsets")


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOKENS).parquet(f"{path}/tokens")


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OFFSETS).parquet(f"{path}/offsets")


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids: of all documents, or of some by their ids.

    Columns that are not selected, and pages without a wanted id, are not read.
    """
    rows = _files(spark, path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin(list(doc_ids)))
    first = sized(read_offsets(spark, path).select("shard", "first_token"))
    return rows.join(first, "shard").select("doc_id", (F.col("first_token") + F.col("at")).alias("start"), "n_tokens", "ids")


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """doc_id, start, ids: the ids at places ``first`` to ``last`` (exclusive) of the whole sequence, by document."""
    inside = read_offsets(spark, path).where((F.col("first_token") < last) & (F.col("first_token") + F.col("n_tokens") > first))
    ends = inside.agg(F.min(F.struct("shard", "first_token")), F.max(F.struct("shard", "first_token"))).first()
    if ends[0] is None or first >= last:
        return read_tokens(spark, path).where("false").select("doc_id", "start", "ids")
    (low, low_first), (high, high_first) = ends
    rows = _files(spark, path).where(F.col("shard").between(low, high))
    # where the first document begins, from the columns of numbers alone
    begin = rows.where((F.col("shard") == low) & (F.col("at") <= first - low_first)).agg(F.max("at")).first()[0] or 0
    rows = rows.where(((F.col("shard") > low) | (F.col("at") >= begin)) & ((F.col("shard") < high) | (F.col("at") < last - high_first)))
    start = F.col("first_token") + F.col("at")
    cut = F.greatest(F.lit(first) - start, F.lit(0)).cast("int")
    left = (F.least(F.lit(last) - start, F.col("n_tokens")) - cut).cast("int")
    return (rows.join(sized(inside.select("shard", "first_token")), "shard")
            .select("doc_id", (start + cut).alias("start"), F.slice("ids", cut + 1, left).alias("ids")))


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            offs = lists.offsets.to_numpy()
            raw = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(offs.tolist(), offs[1:].tolist())]
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "start": batch.column("start"),
                                   "n_tokens": pa.array(np.diff(offs).astype(np.int64)), "ids_crc32": pa.array(sums, pa.int64())})

    return tokens.select("doc_id", "start", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
