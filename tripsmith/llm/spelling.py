"""Operator 11: grouping of spelling variants by PartEnum signatures.

Two words are near if one inserted, deleted or replaced code point turns one into the
other.  A word's letters are a binary vector: the entry (letter, k) is set if the letter
occurs at least k times.  Near words differ in one or two entries.  The entries are dealt
into ``CELLS`` parts of about equal entropy; two vectors that differ in at most two entries
agree on all parts but two, so each vector signs every choice of ``CELLS - 2`` parts and
near words share a signature.  Words with the same letters are one vector (they are never
near), so only vectors are signed and joined.  Joined vectors are verified by the Hamming
distance of their bits, and the words of the vectors that remain by edit distance.

A near word of largest count, ties to the smallest in code-point order, is the word's form
if it occurs at least ``FORM_RATIO`` times as often.  Counts at least double on the way, so
roots are found by a few rounds of pointer jumping.

Results: a row per distinct word of ``LEAST_LETTERS`` code points that occurs ``LEAST_COUNT``
times.  Null and empty texts hold no words.  A null id is written as nothing where a run is
hashed.  Repeated rows count as often as they occur.  Words have no greatest length.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripsmith.llm.common import LOWER_AZ, materialise, release, shuffled, slices, utf8

LEAST_LETTERS, LEAST_COUNT, FORM_RATIO = 5, 3, 2
#: One run in so many (by its hash) has a code point taken out.
SPOILT = 97
CELLS, DISTANCE = 7, 2
#: Occurrences of a letter that are dealt by measured entropy; further ones go by hash.
DEALT = 4
#: Text bytes a task cuts into words at once.
SLICE_BYTES = 8 << 20
#: Words longer than this are hashed one by one.
SHORT = 64

_LOWER = np.frombuffer(LOWER_AZ, np.uint8)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def runs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letter bytes lower-cased, end of each run among them, row of each run).

    U+00C0 to U+00FF are the two-byte letters that begin with C3.
    """
    low = _LOWER[raw]
    letter = ((low >= 97) & (low <= 122)) | (low == 0xC3)
    letter[1:] |= low[:-1] == 0xC3
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]
    first[edges] = letter[edges]
    starts = np.flatnonzero(first)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    before = np.cumsum(letter)
    ends = np.append(before[starts[1:]] - 1, before[-1] if len(before) else 0)[:len(starts)]
    return low[letter], ends, rows


def spoil(word: str, h: int) -> str:
    """The word without the code point that its hash points at, if it is one of those to be spoilt."""
    at = h % len(word)
    return word if h % SPOILT else word[:at] + word[at + 1:]


def _counted(ids: list, raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Words of some rows with their counts; a word may come twice."""
    letters, ends, rows = runs(raw, offsets)
    if not len(ends):
        return pa.array([], pa.string()), np.zeros(0, np.int64)
    bounds = np.concatenate([[0], ends])
    words = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(letters)).dictionary_encode()
    kind, names = words.indices.to_numpy(zero_copy_only=False), words.dictionary
    size = np.diff(bounds)
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    own = np.array([zlib.crc32(w.encode()) for w in names.to_pylist()], np.uint32)
    # crc32 is affine: a seed's share in a word's sum depends on the word's length alone
    share = np.empty((min(int(size.max()), SHORT) + 1, len(ids)), np.uint32)
    share[0] = seeds
    for n in range(1, len(share)):
        share[n] = _CRC[share[n - 1] & 255] ^ (share[n - 1] >> 8)
    short = size < len(share)
    h = own[kind]
    h[short] ^= share[size[short], rows[short]]
    for k in np.flatnonzero(~short).tolist():
        h[k] = zlib.crc32(letters[bounds[k]:bounds[k + 1]], int(seeds[rows[k]]))
    spoilt = h % SPOILT == 0
    odd = Counter(spoil(w, x) for w, x in zip(names.take(pa.array(kind[spoilt])).to_pylist(), h[spoilt].tolist()))
    count = np.bincount(kind[~spoilt], minlength=len(names))
    return (pa.concat_arrays([names.cast(pa.string()), pa.array(list(odd), pa.string())]),
            np.concatenate([count, np.fromiter(odd.values(), np.int64, len(odd))]))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: distinct words that are long and frequent enough."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                words, n = _counted(part.column("id").to_pylist(), *utf8(part.column("text")))
                yield pa.record_batch({"word": words, "n": pa.array(n, pa.int64())}).filter(pa.array(n > 0))

    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("length(text) > 0")
    parts = own.mapInArrow(count, "word string, n long").where(F.length("word") >= LEAST_LETTERS)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def entries(letters: str) -> Iterator[tuple[str, int]]:
    """Set entries (letter, k) of a vector written as its sorted letters."""
    last, k = "", 0
    for c in letters:
        last, k = c, k + 1 if c == last else 1
        yield c, k


def deal_cells(held: dict[tuple[str, int], int], total: int) -> dict[tuple[str, int], int]:
    """Cell of each common entry: the most uncertain entries first, each into the cell with least entropy."""
    def entropy(n: int) -> float:
        p = n / total
        return 0.0 if p in (0.0, 1.0) else -p * math.log(p) - (1 - p) * math.log(1 - p)

    load, cell = [0.0] * CELLS, {}
    for e in sorted(held, key=lambda e: (-entropy(held[e]), e)):
        at = cell[e] = min(range(CELLS), key=load.__getitem__)
        load[at] += entropy(held[e])
    return cell


def signed(letters: str, cell: dict[tuple[str, int], int]) -> tuple[list[str], int]:
    """Signatures of a vector, and 128 bits of which near vectors differ in at most two."""
    parts, bits = [[] for _ in range(CELLS)], 0
    for c, k in entries(letters):
        code = zlib.crc32(f"{c}{k}".encode())
        at = cell.get((c, k))
        parts[code % CELLS if at is None else at].append(f"{c}{k}")
        bits ^= 1 << (code >> 8) % 128
    parts = ["".join(p) for p in parts]
    return [",".join([str(i), *(parts[j] for j in kept)]) for i, kept in enumerate(combinations(range(CELLS), CELLS - DISTANCE))], bits


def near_vectors(vectors: DataFrame) -> DataFrame:
    """a, b (a < b): vectors, given as sorted ``letters``, that differ in one or two entries (a few more may come)."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Counter(e for x in batch.column("letters").to_pylist() for e in entries(x) if e[1] <= DEALT)
            yield pa.record_batch({"c": pa.array([c for c, _ in found], pa.string()), "k": pa.array([k for _, k in found], pa.int32()),
                                   "n": pa.array(list(found.values()), pa.int64())})

    # letters come from an alphabet of 90, so this is a table of 360 rows at most
    held = vectors.mapInArrow(spread, "c string, k int, n long").groupBy("c", "k").agg(F.sum("n").alias("n")).collect()
    cell = deal_cells({(r.c, r.k): r.n for r in held}, max(1, vectors.count()))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = []
                for x in batch.column("letters").slice(at, 2000).to_pylist():
                    signatures, bits = signed(x, cell)
                    high, low = (v - (1 << 64) if v >> 63 else v for v in (bits >> 64, bits & (1 << 64) - 1))
                    rows += [(s, x, len(x), high, low) for s in signatures]
                names = ["signature", "letters", "size", "high", "low"]
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    table = vectors.mapInArrow(sign, "signature string, letters string, size int, high long, low long") \
        .select(F.xxhash64("signature").alias("signature"), "letters", "size", "high", "low")
    a, b = table.alias("a"), table.alias("b")
    apart = F.bit_count(F.col("a.high").bitwiseXOR(F.col("b.high"))) + F.bit_count(F.col("a.low").bitwiseXOR(F.col("b.low")))
    near = ((F.col("a.signature") == F.col("b.signature")) & (F.col("a.letters") < F.col("b.letters"))
            & (F.abs(F.col("a.size") - F.col("b.size")) <= 1) & (apart <= DISTANCE))
    return a.join(shuffled(b), near).select(F.col("a.letters").alias("a"), F.col("b.letters").alias("b")).distinct()


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, other_n: every near pair of ``words`` (word, n), in both directions."""
    held = words.select("word", "n", F.concat_ws("", F.array_sort(F.regexp_extract_all("word", F.lit("(?s)."), 0))).alias("letters"))
    held = materialise(held, "words")
    pairs = near_vectors(held.select("letters").distinct())
    first = pairs.join(shuffled(held.withColumnsRenamed({"letters": "a", "word": "_u", "n": "_un"})), "a").select("b", "_u", "_un")
    second = held.withColumnsRenamed({"letters": "b", "word": "_v", "n": "_vn"})
    one_edit = F.levenshtein("_u", "_v", 1) == 1
    links = materialise(first.join(shuffled(second), (first["b"] == second["b"]) & one_edit).select("_u", "_un", "_v", "_vn"), "near")
    return (links.select(F.col("_u").alias("word"), F.col("_un").alias("n"), F.col("_v").alias("other"), F.col("_vn").alias("other_n"))
            .unionAll(links.select("_v", "_vn", "_u", "_un")))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word reached from each word of ``forms`` (word, form)."""
    table = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = table.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = table.join(shuffled(ahead), "root", "left")
        after = materialise(step.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        moved = after.where("_moved").limit(1).count()
        release(table)
        table = after.select("word", "root")
        table._scratch = after._scratch
        if not moved:
            return table


def spelling_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = materialise(word_counts(docs, id_col, text_col), "counts")

    def first(of: str) -> Column:
        return F.min(F.struct((-F.col("other_n")).alias("_n"), F.col("other"))).alias(of)

    best = near_words(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), first("_best"))
    fits = -F.col("_best._n") >= FORM_RATIO * F.col("n")
    best = materialise(best.select("word", "n_near", F.when(fits, F.col("_best.other")).alias("form"),
                                   F.when(fits, -F.col("_best._n")).alias("form_n")), "forms")
    last = roots(best.where("form is not null"))
    return (words.join(shuffled(best), "word", "left").join(shuffled(last), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
