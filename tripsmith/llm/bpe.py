"""Operator 10: byte-level BPE encoding and decoding.

Each piece of text is a doubly linked list of symbols.  A heap holds (merge rank,
position) of adjacent pairs; entries whose pair has changed meanwhile are stale and
skipped.  Decoding concatenates vocabulary strings.  Encoded pieces are remembered
in a bounded per-task cache, since most words repeat.

Results: one row per input row.  A null or empty text has no tokens and decodes to
"".  Repeated rows give repeated results; text length is not limited (a long run
without white space is one piece and costs n log n).
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: how byte-level vocabularies cut text before merging.  White space is
#: Unicode's property; ``\\s`` of Python's engines also holds four control characters.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Pieces remembered by a task before it starts its cache anew; longer ones never are.
CACHE_PIECES, CACHE_CHARS = 300_000, 64


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, spec: dict):
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        model = spec["model"]
        vocab = model["vocab"]
        self.byte_id = [vocab[letters[b]] for b in range(256)]
        self.merge = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.special = {x["content"]: x["id"] for x in spec.get("added_tokens") or []}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for word, i in vocab.items():
            self.strings[i] = bytes(back[c] for c in word)
        for word, i in self.special.items():
            self.strings[i] = word.encode()
        self.split = (regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
                      if self.special else None)
        self.pieces = regex.compile(PIECES)
        self.cache: dict[str, bytes] = {}

    def merge_piece(self, data: bytes) -> list[int]:
        """Merge the bytes of one piece, lowest rank first, leftmost among equals."""
        symbol = [self.byte_id[b] for b in data]
        n = len(symbol)
        if n < 2:
            return symbol
        merge, before, after = self.merge, list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            if found := merge.get((symbol[i], symbol[i + 1])):
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        while heap:
            rank, i, new = heapq.heappop(heap)
            j = after[i] if symbol[i] >= 0 else n
            if j >= n or merge.get((symbol[i], symbol[j])) != (rank, new):
                continue  # stale: one side has been merged since
            symbol[i], symbol[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merge.get((new, symbol[k])):
                    heapq.heappush(heap, (found[0], i, found[1]))
            if (p := before[i]) >= 0 and (found := merge.get((symbol[p], new))):
                heapq.heappush(heap, (found[0], p, found[1]))
        return [s for s in symbol if s >= 0]

    def _plain(self, text: str, out: list[bytes]) -> None:
        cache = self.cache
        for piece in self.pieces.findall(text):
            got = cache.get(piece)
            if got is None:
                got = np.array(self.merge_piece(piece.encode()), "<u4").tobytes()
                if len(piece) <= CACHE_CHARS:
                    if len(cache) >= CACHE_PIECES:
                        cache.clear()
                    cache[piece] = got
            out.append(got)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        if self.split is None:
            self._plain(text, out)
            return b"".join(out)
        at = 0
        for m in self.split.finditer(text):
            self._plain(text[at:m.start()], out)
            out.append(self.special[m[0]].to_bytes(4, "little"))
            at = m.end()
        self._plain(text[at:] if at else text, out)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        strings = self.strings
        return b"".join([strings[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def _codec(name: str) -> Codec:
    """The task's codec of a file that ``share_vocabulary`` has shipped."""
    if name not in _CODECS:
        with open(SparkFiles.get(name), encoding="utf-8") as f:
            _CODECS[name] = Codec(json.load(f))
    return _CODECS[name]


def share_vocabulary(spark: SparkSession, path: str) -> str:
    """Ship a vocabulary file (about 2 MB, independent of the data) to the executors."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encoded(spark: SparkSession, text: Column, path: str) -> Column:
    """struct(ids binary, n_tokens long, decoded string) of a text column."""
    name = share_vocabulary(spark, path)

    @F.pandas_udf("ids binary, n_tokens long, decoded string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(name)
        for part in parts:
            ids = [codec.encode(t) if t else b"" for t in part]
            yield pd.DataFrame({"ids": ids, "n_tokens": [len(i) // 4 for i in ids],
                                "decoded": [codec.decode(i) for i in ids]})

    return run(text)


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    name = share_vocabulary(docs.sparkSession, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(name)
        for part in parts:
            rows = []
            for text in part:
                ids = codec.encode(text) if text else b""
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(codec.decode(ids).encode()).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), run(F.col(text_col)).alias("_r"))
    return out.select("doc_id", "_r.n_tokens", "_r.ids_sha256", "_r.decoded_sha256")
