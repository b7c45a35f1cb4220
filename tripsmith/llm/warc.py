"""Operator 2: WARC archives, written as one gzip member a record and read by byte ranges.

Writing.  Records are built in tasks and written by Spark's own text writer, so output
is committed once per task attempt on any file system.  That writer ends each row with
a separator; it is set to a zero byte, which is the last byte of every gzip member below
16 MiB (the top byte of its size field), and left off the row.  A larger record is
followed by an empty member, which also ends so.

Reading.  Files are cut into byte ranges.  A task scans its range for the gzip magic,
decodes the start of each candidate, takes it as a record if that reads as a WARC header
and decodes to the member's end with a right checksum, and goes on after it.  A task
owns the records that start inside its range; the last may end beyond it.

Deduplication.  Of records with equal payloads of at least ``least`` bytes the one
with the smallest page_id is a response and the others revisit it.  Rows that repeat that
page_id and payload are responses too.  A page without page_id revisits a page that has
one; if none has, all are responses.  Null html is an empty payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsmith.llm.common import materialise

RANGE_BYTES = 4 << 20
MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

_READ = 1 << 18
_ID = "urn:x-page:"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The bytes of one record; a revisit's block keeps only the HTTP header."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that ends in a zero byte, followed by an empty one where needed."""
    packed = gzip.compress(data, 6, mtime=0)
    return packed if packed[-1] == 0 else packed + EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) to files below ``path``."""
    own = pages.select(F.col("page_id").cast("long").alias("_id"), F.col("url").cast("string").alias("_url"),
                       F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("_payload"))
    own = own.withColumns({"_sha": F.sha1("_payload"), "_n": F.octet_length("_payload")})
    firsts = materialise(own.where(F.col("_n") >= least).groupBy("_sha")
                         .agg(F.min("_id").alias("_first"), F.count("*").alias("_c")).where("_c > 1")
                         .select("_sha", "_first"), "firsts")
    refers = F.when((F.col("_n") >= least) & ~F.col("_id").eqNullSafe(F.col("_first")), F.col("_first"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            for at in range(0, batch.num_rows, 256):
                part = zip(*(rows[c][at:at + 256] for c in ("_id", "_url", "_payload", "_refers")))
                yield pa.RecordBatch.from_arrays([pa.array([member(record(*r))[:-1] for r in part], pa.binary())], ["r"])

    (own.join(firsts, "_sha", "left").select("_id", "_url", "_payload", refers.alias("_refers"))
     .mapInArrow(build, "r binary").select(F.col("r").cast("string").alias("value"))
     .write.option("lineSep", "\0").text(path))


def _open(path: str):
    """A random-access file of any store that Arrow knows."""
    if path.startswith("file:"):
        return pyarrow.fs.LocalFileSystem().open_input_file("/" + path[5:].lstrip("/"))
    store, at = pyarrow.fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store.open_input_file(at)


def decode_member(file, at: int, size: int) -> tuple[bytes, int] | None:
    """(content, offset behind) of the gzip member at an offset, or None if none decodes there."""
    inflate, out, pos = zlib.decompressobj(31), [], at
    while not inflate.eof:
        data = file.read_at(min(_READ, size - pos), pos) if pos < size else b""
        if not data:
            return None
        pos += len(data)
        try:
            out.append(inflate.decompress(data))
        except zlib.error:
            return None
        if len(out) == 1 and out[0] and not out[0].startswith(b"WARC/"[:len(out[0])]):
            return None
    return b"".join(out), pos - len(inflate.unused_data)


def members(file, size: int, start: int, end: int) -> Iterator[bytes]:
    """Contents of the members that start in [start, end)."""
    pos = start
    while pos < end:
        window = file.read_at(min(_READ + len(MAGIC) - 1, size - pos), pos)
        hit = window.find(MAGIC)
        if hit < 0:
            pos += max(1, len(window) - len(MAGIC) + 1)
            continue
        if pos + hit >= end:
            return
        pos += hit
        got = decode_member(file, pos, size)
        if got is None:
            pos += 1
            continue
        if got[0]:
            yield got[0]
        pos = got[1]


def parse(content: bytes) -> dict:
    """Fields of a record; the digest of a response is taken from its payload and must match."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    number = lambda f: int(v) if (v := fields.get(f, "").strip("<>").removeprefix(_ID)) else None
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {"page_id": number("WARC-Record-ID"), "url": fields.get("WARC-Target-URI"), "payload_bytes": length,
            "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"),
            "payload": None if revisit else payload}


_COLUMNS = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
            ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]


def read_archives(spark: SparkSession, path: str, payloads: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload) of every record."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    ranges = files.where("length > 0").select("path", "length", F.explode(F.expr(
        f"sequence(0L, length - 1, {range_bytes}L)")).alias("start"))
    ranges = ranges.repartition(spark.sparkContext.defaultParallelism * 2)  # a row a range: nothing heavy moves
    columns = [c for c in _COLUMNS if payloads or c[0] != "payload"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, weight = [], 0
                with _open(row["path"]) as file:
                    for content in members(file, row["length"], row["start"], min(row["start"] + range_bytes, row["length"])):
                        held.append(parse(content))
                        weight += len(content)
                        if weight > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], t) for c, t in columns],
                                                             [c for c, _ in columns])
                            held, weight = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], t) for c, t in columns],
                                                 [c for c, _ in columns])

    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    return ranges.mapInArrow(read, ", ".join(f"{c} {names[t]}" for c, t in columns))
