import base64
import gzip
import hashlib
import random
from pathlib import Path

import pytest
from pyspark.sql import types as T

from tripsmith.llm import warc as W
from tripsmith.llm.common import scratch_path

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                      T.StructField("record_type", T.StringType()), T.StructField("_sha", T.StringType())])


def expect(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = first.get(html or "") if len(data) >= least else None
        to = None if to == i else to
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def rows():
    rng = random.Random(5)
    noise = lambda n: "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(n))
    out = [(k, f"http://x.example/{k}", noise(rng.randint(0, 3000))) for k in range(60)]
    out += [(100 + k, "http://same.example/", "<p>same</p>") for k in range(40)] + [(7, None, out[3][2]), (3, "http://x.example/3", out[3][2])]
    out += [(200, None, None), (201, "", ""), (202, "http://é.example/ a\r\nX: y", noise(9)), (None, "u", "<p>same</p>"), (None, "u", "no id")]
    out += [(300, "http://long.example", noise(400_000)), (301, "u", "WARC/1.1\r\n\r\n\x1f")]
    return out


@pytest.mark.parametrize("least,range_bytes", [(0, 1 << 22), (0, 700), (100, 5000)])
def test_round_trip(spark, least, range_bytes):
    path = scratch_path(spark, "test-warc")
    data = rows()
    W.write_archives(spark.createDataFrame([(*r, "x", "y") for r in data], PAGES).repartition(4), path, least)
    back = W.read_archives(spark, path, range_bytes=range_bytes).collect()
    got = sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back], key=str)
    assert got == expect(data, least)
    texts = {(i, html or "") for i, _, html in data}
    assert all((r.page_id, bytes(r.payload).decode()) in texts for r in back if r.record_type == "response")


def test_archives_are_plain_gzip_members(spark):
    path = scratch_path(spark, "test-warc")
    W.write_archives(spark.createDataFrame([(*r, "x", "y") for r in rows()], PAGES).coalesce(1), path)
    (file,) = Path(path.removeprefix("file:")).glob("part-*")
    text = gzip.decompress(file.read_bytes())
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(rows())


def test_empty_table(spark):
    path = scratch_path(spark, "test-warc")
    W.write_archives(spark.createDataFrame([], PAGES), path)
    assert W.read_archives(spark, path).count() == 0


def test_members_after_false_magic(tmp_path):
    """Magic that begins no record is passed over; ranges own what starts inside them."""
    records = [W.member(W.record(k, None, b"payload %d" % k, None)) for k in range(20)]
    blob = b"".join(r + W.MAGIC + b"\x08junk" + gzip.compress(b"not a record") for r in records)
    (tmp_path / "a").write_bytes(blob)
    with W._open(f"file:{tmp_path}/a") as file:
        for step in (1, 37, 500, len(blob)):
            got = [W.parse(c)["page_id"] for s in range(0, len(blob), step) for c in W.members(file, len(blob), s, min(s + step, len(blob)))
                   if c.startswith(b"WARC/")]
            assert got == list(range(20))
    big = W.member(W.record(1, None, random.Random(1).randbytes(17 << 20), None))
    assert big[-1] == 0 and len(W.parse(gzip.decompress(big))["payload"]) == 17 << 20


def test_a_changed_payload_is_reported():
    data = W.record(1, None, b"abc", None)
    with pytest.raises(ValueError):
        W.parse(data.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))
