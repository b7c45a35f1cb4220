import io
import random
import zlib
from contextlib import redirect_stdout
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF001
from tripsmith.llm import token_files as K
from tripsmith.llm.common import scratch_path, table
from tripsmith.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [t.encode(x or "", add_special_tokens=False).ids + [2] for x in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def brute(pairs):
    """(doc_id, start, n_tokens, ids_crc32) of pairs in order of unique ids."""
    out, start = [], 0
    for (i, _), ids in zip(pairs, library([t for _, t in pairs])):
        out.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return out


def rows(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


@pytest.fixture(params=["dictionary", "delta"])
def written(request, spark, make_docs, monkeypatch):
    monkeypatch.setattr(K, "ROW_GROUP_BYTES", 6_000)
    monkeypatch.setattr(K, "PAGE_BYTES", 1_000)
    monkeypatch.setattr(K, "PAGE_ROWS", 50)
    rng = random.Random(8)
    words = ["alpha", "beta", " gamma", "Straße", "<|endoftext|>", "12", "\n"]
    pairs = [(k * 3, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for k in range(2500)]
    docs = make_docs(rng.sample(pairs, len(pairs)))
    path = scratch_path(spark, "tokens").removeprefix("file:")
    K.write_tokens(docs, path, PATH, request.param)
    return path, pairs, request.param


def test_given_table(spark):
    docs = table(spark, SF001, "documents")
    pairs = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert rows(QUERIES["op13_token_files"](spark, SF001)) == brute(pairs)


def test_edges(spark, make_docs):
    pairs = [(1, None), (2, ""), (5, "Hello world"), (9, "x" * 30_000), (10, "word " * 30_000), (11, "<|endoftext|>a"), (-4, "minus")]
    path = scratch_path(spark, "tokens")
    K.write_tokens(make_docs(pairs), path, PATH)
    assert rows(K.checksums(K.read_tokens(spark, path))) == brute(sorted(pairs))
    again = [(7, "same")] * 40 + [(7, "other")] * 3 + [(None, "nameless"), (8, "last")]
    path = scratch_path(spark, "tokens")
    K.write_tokens(make_docs(again), path, PATH)
    got = rows(K.checksums(K.read_tokens(spark, path)))
    assert [r[0] for r in got] == [None] + [7] * 43 + [8]
    assert all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:])) and got[0][1] == 0
    assert sorted(r[3] for r in got) == sorted(crc(i) for i in library([t for _, t in again]))
    path = scratch_path(spark, "tokens")
    K.write_tokens(make_docs([]), path, PATH)
    assert K.read_tokens(spark, path).count() == 0 and K.read_range(spark, path, 0, 9).count() == 0
    with pytest.raises(ValueError):
        K.write_tokens(make_docs([]), path, PATH, "plain")


def test_files_have_row_groups_page_indexes_and_encodings(written):
    path, pairs, encoding = written
    last = None
    files = sorted(Path(f"{path}/tokens").glob("*.parquet"))
    groups = 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        groups += meta.num_row_groups
        for g in range(meta.num_row_groups):
            by = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c) for c in range(meta.num_columns)}
            assert all(c.has_offset_index and c.has_column_index for c in by.values())
            used = set(by["ids.list.element"].encodings)
            assert ("RLE_DICTIONARY" in used) == (encoding == "dictionary") and ("DELTA_BINARY_PACKED" in used) == (encoding == "delta")
            assert "DELTA_BINARY_PACKED" in by["doc_id"].encodings and "DELTA_BINARY_PACKED" in by["at"].encodings
            assert meta.row_group(g).total_byte_size < 4 * K.ROW_GROUP_BYTES
        ids = pq.read_table(f, columns=["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids) and (last is None or not ids or last < ids[0])
        last = ids[-1] if ids else last
    assert groups > len(files) > 1


def test_parts_are_read_alone(spark, written):
    path, pairs, _ = written
    ids = library([t for _, t in pairs])
    starts = np.cumsum([0, *map(len, ids)]).tolist()
    flat = [x for i in ids for x in i]
    asked = [0, 300, 2997, 7497, 4]
    got = {r.doc_id: (r.start, r.ids) for r in K.read_tokens(spark, path, asked).collect()}
    assert got == {i: (starts[i // 3], ids[i // 3]) for i in asked[:4]}
    for a, b in ((0, 1), (0, len(flat)), (1234, 1234), (5, 5000), (starts[700], starts[701]), (starts[9] - 1, starts[9] + 1), (len(flat) - 1, len(flat) + 9)):
        part = sorted(K.read_range(spark, path, a, b).collect(), key=lambda r: r.start)
        assert [x for r in part for x in r.ids] == flat[a:b]
        assert not part or part[0].start == a

    def plan(frame):
        out = io.StringIO()
        with redirect_stdout(out):
            frame.explain("formatted")
        return out.getvalue()
    meta = plan(K.read_tokens(spark, path).select("doc_id", "start", "n_tokens"))
    assert "ids:array" not in meta
    assert "In(doc_id" in plan(K.read_tokens(spark, path, asked)) and "GreaterThanOrEqual(shard" in plan(K.read_range(spark, path, 5, 50))


def test_stretches_encode_as_the_whole_text():
    rng = random.Random(4)
    pool = [*map(chr, range(0, 0x250)), *" \u00a0\u0085\u1680\u2003\u2028\u2029\u202f\u205f\u3000\u200b\U0001f600一'", "'s", " the", "  ", "\n\n", " ", " ", " ", " a",
            "<|endoftext|>", " <|endoftext|> ", "é ", " é", "\u2013 "]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    e = K.Encoder(PATH)
    assert e.parted
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0, *(len(t.encode()) for t in texts)])
    for parted in (True, False):
        e.parted = parted
        ids, size = e.encode(raw, offs, 2)
        cut = np.cumsum(size).tolist()
        assert [ids[a:b].tolist() for a, b in zip([0, *cut], cut)] == library(texts)
    assert len(K.stretches(raw, offs)[0]) > len(texts)
    assert not K.parts_at_blanks({"pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": True}})
    assert not K.parts_at_blanks({"pre_tokenizer": {"type": "ByteLevel"}, "added_tokens": [{"content": "a b"}]})
