"""Operator 1: near-duplicate documents by HyperMinHash.

A document is the set of its word shingles.  Each shingle is hashed once; the top bits
choose one of ``REGISTERS`` buckets, and a bucket stores, for its smallest value, the
count of leading zeros and some mantissa bits after the leading one.  Neighbouring
buckets merge into ``BANDS`` x ``ROWS`` coarser registers; documents that agree on all
registers of a band are candidates.  Candidates are kept if the Jaccard estimate,
corrected for equal registers by chance, comes near the threshold, and confirmed on
the full shingle sets.

How it scales
  * Equal sets form one class first (map-side aggregation), so exact copies of any
    number are one node.
  * Band rows are aggregated to (band, smallest member, count); only buckets with two
    members or more go on.  A bucket of up to ``BUCKET`` members is cut into parts whose
    members' registers come near each other (texts that share a few frequent shingles
    also meet in buckets).  Members of larger ones meet again by their rarest registers:
    near ones share one of these, texts with a frequent line in common do not.  Only if
    more than ``BUCKET`` share a rare register too, they stay whole.  Either way a bucket
    yields links that hold its parts together, fewer than members: no pair lists.
  * Classes joined by such links form families.  A family is cut into blocks of about
    ``BLOCK`` classes; a task holds one block, or two for families of more blocks,
    estimates and confirms its candidates there on sets and finer registers, and returns
    only links that join parts not yet joined in that task.  In a family of many blocks the first
    classes of the components are dealt to blocks anew, while that joins many.  Then the family's largest
    component and the other classes get blocks of their own, and all blocks are compared but
    those whose classes are joined already: work grows with the classes that are not.

Results: one row per input row: doc_id, n_shingles, component_id (smallest doc_id
reachable), kept.  A null, empty or wordless text has 0 shingles and is linked with
nothing.  A text with fewer than ``width`` words is one shingle.  Rows that share a
doc_id are one node.  A row without doc_id gets the component of its class (null if
no row of the class has an id) and is kept only in the latter case.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripsmith.llm.common import LOWER_AZ, materialise, mix64, release, sized
from tripsmith.llm.components import components

WIDTH = 5
REGISTERS = 512
#: Bits after the leading one: of registers that are compared one by one, and of those that
#: make up bands, where a band of a short text may rest on a single register.
MANTISSA, BAND_MANTISSA = 10, 24
BANDS, ROWS = 32, 4
BLOCK, BUCKET = 384, 1024
#: Rounds that join first classes of components, for families of more than so many blocks.
ROUNDS, SEVERAL = 4, 8
#: Estimates this far below the threshold still count: above five standard errors, of the
#: finer registers and of those that make up bands.
SLACK, COARSE_SLACK = 0.10, 0.20
CACHE_WORDS = 100_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_WORDS = _WordHashes()


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = text.encode().translate(LOWER_AZ).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([_WORDS[w] for w in words], np.uint64)
    span = min(width, len(h))
    rolled = h[:len(h) - span + 1].copy()
    for k in range(1, span):
        rolled = rolled * _MULTIPLIER + h[k:len(h) - span + 1 + k]
    return np.unique(mix64(rolled + np.uint64(span)))


def registers(values: np.ndarray, size: int, kept: int = MANTISSA) -> np.ndarray:
    """Compressed registers of a sorted hash set: (zeros + 1) << kept | mantissa; 0 if empty."""
    bits = size.bit_length() - 1
    out = np.zeros(size, np.uint16 if kept <= MANTISSA else np.uint32)
    if not len(values):
        return out
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))  # smallest of each bucket
    rest = values[first] << np.uint64(bits)
    # 53 bits are exact as a float, whose exponent tells the leading zeros
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    mantissa = ((rest << zeros.astype(np.uint64)) << np.uint64(1)) >> np.uint64(64 - kept)
    out[bucket[first]] = ((zeros.astype(np.int64) + 1) << kept) | mantissa.astype(np.int64)
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """One signed 64-bit key a band of BANDS x ROWS registers; empty bands are left out."""
    return band_keys(registers(values, BANDS * ROWS, BAND_MANTISSA))


def band_keys(coarse: np.ndarray) -> np.ndarray:
    """``bands`` of registers that keep BAND_MANTISSA bits."""
    coarse = coarse.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mix64(key * _MULTIPLIER + coarse[:, k])
    return key[coarse.any(axis=1)].view(np.int64)


def chance(n: np.ndarray, m: np.ndarray, size: int = REGISTERS) -> np.ndarray:
    """Expected count of registers that two disjoint sets of n and m shingles share by chance.

    The smallest values of a bucket are nearly exponential with rates n/size and m/size;
    registers agree where both fall in one cell (a leading-zero count and a mantissa).
    """
    zeros = np.arange(0, 40)[:, None]
    cell = 2.0 ** -(zeros + 1)  # [cell, 2 cell) is cut into 2**MANTISSA cells of equal width
    total = 0.0
    a, b = np.atleast_1d(n / size)[None, :], np.atleast_1d(m / size)[None, :]
    for part in (0.25, 0.75):  # two points of each octave are enough: the density is smooth
        x = cell * (1 + part)
        total = total + (a * b * np.exp(-(a + b) * x) * (cell / 2 ** MANTISSA) * cell / 2).sum(axis=0)
    return size * total


def estimate(one: np.ndarray, many: np.ndarray, n: int, ns: np.ndarray, least: float = 0.0) -> np.ndarray:
    """Collision-corrected Jaccard estimates of one document against rows of ``many``.

    The correction only lowers an estimate, so it is left out where that is below ``least`` already.
    """
    equal = ((many == one) & (one > 0)).sum(axis=1).astype(float)
    filled = np.maximum(((many > 0) | (one > 0)).sum(axis=1), 1).astype(float)
    out = equal / filled
    high = np.flatnonzero(out >= least)
    if len(high):
        luck = chance(np.float64(n), ns[high].astype(np.float64), len(one))
        out[high] = np.clip((equal[high] - luck) / np.maximum(filled[high] - luck, 1e-9), 0, 1)
    return out


def bucket_links(ids: list[int], n: np.ndarray, coarse: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that hold together the members of a bucket whose registers and sizes come near each other."""
    joined, out, least = _Joined(len(ids)), [], percent / 100 - COARSE_SLACK
    for i in range(len(ids) - 1):
        rest = n[i + 1:]
        near = np.flatnonzero(100 * np.minimum(rest, n[i]) >= percent * np.maximum(rest, n[i])) + i + 1
        near = near[estimate(coarse[i], coarse[near], n[i], n[near], least) >= least] if len(near) else near
        out += [(ids[i], ids[j]) for j in near.tolist() if joined.join(i, j)]
    return out


class _Joined:
    """Union-find over rows of a block."""

    def __init__(self, n: int):
        self.to = list(range(n))

    def root(self, x: int) -> int:
        while self.to[x] != x:
            self.to[x] = x = self.to[self.to[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.to[max(a, b)] = min(a, b)
        return True


def block_links(ids: list[int], sets: list[np.ndarray], side: list[int], labels: list[int], percent: int):
    """Links (a, b) that join rows of a block, or of two, which ``labels`` hasn't joined yet.

    side: 0 for a block compared within itself; 0 and 1 for two blocks, of which only
    pairs across count.
    """
    n, two = len(ids), max(side, default=0) == 1
    joined, first = _Joined(n), {}
    for i, label in enumerate(labels):
        joined.join(first.setdefault(label, i), i)
    for i, node in enumerate(ids):
        joined.join(first.setdefault(("id", node), i), i)
    if len({joined.root(i) for i in range(n)}) == 1:
        return []
    size = np.array([len(s) for s in sets], np.int64)
    fine = np.stack([registers(s, REGISTERS) for s in sets])
    keys = [bands(s) for s in sets]
    flat, rows = np.concatenate(keys), np.repeat(np.arange(n), [len(k) for k in keys])
    order = np.argsort(flat, kind="stable")
    flat, rows = flat[order], rows[order]
    cut = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1], [True])))
    meet = np.zeros((n, n), bool)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        if b - a > 1:
            meet[np.ix_(rows[a:b], rows[a:b])] = True
    root, part = np.array([joined.root(i) for i in range(n)]), np.array(side)
    meet &= root[:, None] != root[None, :]
    if two:
        meet &= part[:, None] != part[None, :]
    meet &= 100 * np.minimum(size[:, None], size[None, :]) >= percent * np.maximum(size[:, None], size[None, :])
    out, candidates = [], []
    for i in range(n):
        own = i + 1 + np.flatnonzero(meet[i, i + 1:])
        if len(own):
            guess = estimate(fine[i], fine[own], size[i], size[own], percent / 100 - SLACK)
            keep = guess >= percent / 100 - SLACK
            candidates += zip((-guess[keep]).tolist(), [i] * int(keep.sum()), own[keep].tolist())
    for _, i, j in sorted(candidates):
        if joined.root(i) != joined.root(j):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= percent * (size[i] + size[j] - both):
                joined.join(i, j)
                out.append((ids[i], ids[j]))
    return out


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """_id, _n, _h1, _h2 (identity of the set), _bands (keys), _coarse (registers), _low (their further bits) of every row."""
    further = BAND_MANTISSA - MANTISSA

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, h, keys, coarse, low = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingles(text, width)
                n.append(len(s))
                h.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64))
                own = registers(s, BANDS * ROWS, BAND_MANTISSA)
                keys.append(band_keys(own))
                coarse.append((own >> further).astype(np.uint16).tobytes())
                low.append((own & ((1 << further) - 1)).astype(np.uint16).tobytes())
            h = np.stack(h) if h else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(coarse, pa.binary()), pa.array(low, pa.binary())],
                ["_id", "_n", "_h1", "_h2", "_bands", "_coarse", "_low"])

    return docs.mapInArrow(run, "_id long, _n long, _h1 long, _h2 long, _bands array<long>, _coarse binary, _low binary")


def _shared(keyed: DataFrame) -> DataFrame:
    """_key, _rep of keys that several rows have, with the smallest _rep and the count of each key: _hub, _c."""
    hubs = materialise(keyed.groupBy("_key").agg(F.min("_rep").alias("_hub"), F.count("*").alias("_c")).where("_c > 1"), "hubs")
    out = materialise(keyed.join(sized(hubs), "_key"), "shared")
    release(hubs)
    return out


def _rare(classes: DataFrame, percent: int) -> DataFrame:
    """_key, _rep: the rarest registers of each class, so many that near classes have one of them in common.

    Classes that come near each other (``bucket_links``) agree in a share of the registers of either.  In
    whatever order, as long as it is the same for all, they then share one of the first of each: so many that
    fewer than that share are left.  Rare ones come first, so what many texts have in common is seldom among them.
    """
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coarse, low = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1).astype(np.int64)
                           for c in ("_coarse", "_low"))
            row, at = np.nonzero(coarse)
            key = at << 32 | coarse[row, at] << (BAND_MANTISSA - MANTISSA) | low[row, at]
            filled = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(row)) for c in ("_rep", "_h1", "_h2")), pa.array(key),
                                              pa.array(filled[row])], ["_rep", "_h1", "_h2", "_key", "_filled"])

    spelt = materialise(classes.select("_rep", "_h1", "_h2", "_coarse", "_low").mapInArrow(
        spell, "_rep long, _h1 long, _h2 long, _key long, _filled long"), "registers")
    often = materialise(spelt.groupBy("_key").agg(F.count("*").alias("_c")).where("_c > 1"), "often")
    least = percent - round(100 * COARSE_SLACK)
    first = F.col("_filled") - F.floor((least * F.col("_filled") + 99) / 100) + 1
    held = spelt.join(sized(often), "_key").groupBy("_rep", "_h1", "_h2").agg(
        F.first("_filled").alias("_filled"), F.sort_array(F.collect_list(F.struct("_c", "_key"))).alias("_keys"))
    # registers that no other class has are the rarest, and lead to none
    held = held.withColumn("_first", (first - (F.col("_filled") - F.size("_keys"))).cast("int")).where("_first > 0")
    out = materialise(held.select("_rep", F.explode(F.slice("_keys", 1, F.col("_first"))).alias("_k")).select("_k._key", "_rep"), "rare")
    release(spelt, often)
    return out


def _bucket_parts(rows: DataFrame, percent: int) -> DataFrame:
    """Links a, b of each bucket; rows: _key, _rep, _n, _coarse."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []

        def done():
            if len(held) > 1:
                out.extend(bucket_links([h[0] for h in held], np.array([h[1] for h in held]),
                                        np.frombuffer(b"".join(h[2] for h in held), np.uint16).reshape(len(held), -1), percent))

        for batch in batches:
            for k, *row in zip(*(batch.column(c).to_pylist() for c in ("_key", "_rep", "_n", "_coarse"))):
                if k != key:
                    done()
                    key, held = k, []
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])
            out.clear()
        done()
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    return (rows.select("_key", "_rep", "_n", "_coarse").repartition("_key").sortWithinPartitions("_key", "_rep")
            .mapInArrow(run, "a long, b long"))


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """_id, _set (hashes as bytes) and the rest of frames (_id, _text, ...); rows that repeat come once a task."""
    rest = [f for f in docs.schema.fields if f.name not in ("_id", "_text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for batch in batches:
            held, index = [], []
            for k, (i, text) in enumerate(zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist())):
                values = shingles(text, width).tobytes()
                if (key := (i, xxhash.xxh3_128_digest(values))) not in seen:
                    seen.add(key)
                    held.append(values)
                    index.append(k)
            batch = batch.take(pa.array(index, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(held, pa.binary()), *(batch.column(f.name) for f in rest)],
                ["_id", "_set", *(f.name for f in rest)])

    return docs.mapInArrow(run, "_id long, _set binary" + "".join(f", {f.name} {f.dataType.simpleString()}" for f in rest))


def _links(blocks: DataFrame, percent: int) -> DataFrame:
    """Links a, b found in each group of (_family, _i, _j); rows: _id, _set, _side, _label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done():
            found = block_links(held["_id"], [np.frombuffer(s, np.uint64) for s in held["_set"]],
                                held["_side"], held["_label"], percent) if held["_id"] else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        key, held = None, {c: [] for c in ("_id", "_set", "_side", "_label")}
        for batch in batches:
            rows = batch.to_pydict()
            for k in range(batch.num_rows):
                at = rows["_family"][k], rows["_i"][k], rows["_j"][k]
                if at != key:
                    yield done()
                    key, held = at, {c: [] for c in held}
                for c in held:
                    held[c].append(rows[c][k])
        yield done()

    keys = ["_family", "_i", "_j"]
    return (blocks.select(*keys, "_id", "_set", "_side", "_label").repartition(*keys)
            .sortWithinPartitions(*keys, "_id").mapInArrow(run, "a long, b long"))


def _labels(large: DataFrame, links: DataFrame) -> DataFrame:
    """_id, _family, _label (component by ``links``) of the classes of ``large``."""
    own = large.select("_id", "_family").distinct()
    return materialise(own.join(components(links).withColumnRenamed("node", "_id"), "_id", "left").select(
        "_id", "_family", F.coalesce("component", "_id").alias("_label")), "labels")


def _firsts(large: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """``links`` and those between first classes of components of a family, which are dealt to blocks anew.

    Blocks of near copies become one component so, in a few rounds of one class a component, as long as a round
    joins one in twenty.  What they leave is compared all the same, so they only save work.
    """
    labels = _labels(large, links)
    before = labels.where("_id = _label").count()
    for salt in range(1, ROUNDS + 1):
        firsts = labels.where("_id = _label").select("_id", "_family", "_label")
        counts = materialise(firsts.groupBy("_family").agg(F.ceil(F.count("*") / BLOCK).alias("_n")), "counts")
        dealt = materialise(firsts.join(sized(counts), "_family").select(
            "_id", "_label", F.pmod(F.xxhash64("_id", F.lit(salt)), "_n").cast("int").alias("_i")), "firsts")
        found = large.select("_id", "_set", "_family").join(sized(dealt), "_id").withColumns({"_j": F.col("_i"), "_side": F.lit(0)})
        links = materialise(links.unionAll(_links(found, percent)), "links")
        release(labels, counts, dealt)
        labels = _labels(large, links)
        now = labels.where("_id = _label").count()
        if 100 * now > 95 * before:
            break
        before = now
    release(labels)
    return links


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = WIDTH,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: 100 x intersection >= percent x union links."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    meta = materialise(_profiles(own, width), "profiles")
    classes = materialise(
        meta.where("_n > 0").groupBy("_h1", "_h2").agg(F.min("_id").alias("_rep"), *(F.first(c).alias(c) for c in ("_n", "_bands", "_coarse", "_low"))),
        "classes")
    named = classes.where("_rep is not null")
    near = named.select("_rep", "_n", "_coarse")
    shared = _shared(named.select("_rep", F.explode("_bands").alias("_key")))
    candidates = _bucket_parts(shared.where(F.col("_c") <= BUCKET).select("_key", "_rep").join(near, "_rep"), percent)
    held = [shared]
    crowded = materialise(shared.where(F.col("_c") > BUCKET).select("_rep").distinct(), "crowded")
    if crowded.limit(1).count():
        rare = _rare(named.join(sized(crowded), "_rep", "left_semi"), percent)
        again = _shared(rare)
        whole = again.where((F.col("_c") > BUCKET) & (F.col("_rep") != F.col("_hub")))
        candidates = candidates.unionAll(_bucket_parts(again.where(F.col("_c") <= BUCKET).select("_key", "_rep").join(near, "_rep"), percent)).unionAll(
            whole.select(F.col("_rep").alias("a"), F.col("_hub").alias("b")))
        held += [rare, again]
    candidates = materialise(candidates, "candidates")  # components reads its links twice
    families = components(candidates)
    release(*held, crowded, candidates)
    sizes = families.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks"))
    members = materialise(
        families.join(materialise(sizes, "sizes"), "component")
        .select(F.col("node").alias("_id"), F.col("component").alias("_family"), "_blocks",
                F.pmod(F.xxhash64("node"), "_blocks").cast("int").alias("_i")), "members")
    sets = materialise(_sets(own.join(sized(members), "_id"), width), "sets")
    links = materialise(_links(sets.withColumns({
        "_j": F.col("_i"), "_side": F.lit(0), "_label": F.xxhash64("_id")}), percent), "links")

    # families of several blocks: compare blocks pairwise, but for pairs already one component
    large = sets.where("_blocks > 1")
    if large.limit(1).count():
        several = large.where(F.col("_blocks") > SEVERAL)
        if several.limit(1).count():
            links = _firsts(several, links, percent)
        large = materialise(large.drop("_i", "_blocks").join(sized(_labels(large, links)).drop("_family"), "_id"), "large")
        parts = large.groupBy("_family", "_label").agg(F.count("*").alias("_c"))
        parts = parts.groupBy("_family").agg(F.max(F.struct("_c", "_label")).alias("_top"), F.sum("_c").alias("_all"))
        parts = materialise(parts.select("_family", F.col("_top._label").alias("_most"), F.ceil(F.col("_top._c") / BLOCK).alias("_inside"),
                                         F.ceil((F.col("_all") - F.col("_top._c")) / BLOCK).alias("_outside")), "parts")
        of = F.xxhash64("_id")
        large = large.join(sized(parts), "_family").withColumn("_i", F.when(
            F.col("_label") == F.col("_most"), F.pmod(of, "_inside")).otherwise(F.col("_inside") + F.pmod(of, "_outside")).cast("int"))
        whole = large.groupBy("_family", "_i").agg(F.min("_label").alias("_lo"), F.max("_label").alias("_hi"))
        whole = materialise(whole, "dealt")
        a, b = (whole.select("_family", *(F.col(c).alias(c + s) for c in ("_i", "_lo", "_hi"))) for s in ("a", "b"))
        todo = a.join(b, "_family").where(
            (F.col("_ia") <= F.col("_ib")) & ~((F.col("_loa") == F.col("_hib")) & (F.col("_hia") == F.col("_lob"))
                                               & (F.col("_loa") == F.col("_hia"))))
        todo = todo.select("_family", F.col("_ia").alias("_x"), F.col("_ib").alias("_y"))
        sides = F.array(F.struct(F.col("_x").alias("_i"), F.lit(0).alias("_side")), F.struct(F.col("_y").alias("_i"), F.lit(1).alias("_side")))
        sided = todo.select("_family", "_x", "_y", F.explode(F.slice(sides, 1, F.when(F.col("_x") == F.col("_y"), 1).otherwise(2))).alias("_s"))
        sided = materialise(sided.select("_family", "_x", "_y", "_s._i", "_s._side"), "todo")
        across = large.join(sided, ["_family", "_i"]).select(
            "_family", F.col("_x").alias("_i"), F.col("_y").alias("_j"), "_id", "_set", "_side", "_label")
        links = links.unionAll(materialise(_links(across, percent), "links"))

    found = components(links)
    release(sets, members)
    placed = materialise(
        classes.select("_h1", "_h2", "_rep").join(found.withColumnRenamed("node", "_rep"), "_rep", "left")
        .select("_h1", "_h2", F.coalesce("component", "_rep").alias("_component")), "placed")
    component = F.when(F.col("_n") > 0, F.col("_component")).otherwise(F.col("_id"))
    return (meta.select("_id", "_n", "_h1", "_h2").join(placed, ["_h1", "_h2"], "left")
            .select(F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))
