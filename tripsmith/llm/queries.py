"""Registered queries of the operators, each over its whole table, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsmith.llm.common import scratch_path, ship_code, table


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.warc import read_archives, write_archives
    path = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.sharding import assign_shards
    return assign_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.ann import nearest
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.suffix_tree import lm_scores
    return lm_scores(table(spark, sf_dir, "documents"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.repeats import remove_repeats
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.secret_scan import findings
    return findings(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.decontaminate import matches
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.toxicity import scores
    return scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tripsmith.llm.bpe import digests
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.spelling import spelling_groups
    return spelling_groups(table(spark, sf_dir, "documents"))


def op12_labels(rows: DataFrame) -> DataFrame:
    """The label that the query mines with: moved on by one in every seventh row."""
    return rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tripsmith.llm.hard_negatives import hard_negatives
    return hard_negatives(op12_labels(table(spark, sf_dir, "embeddings")))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from tripsmith.llm.token_files import checksums, read_tokens, write_tokens
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return checksums(read_tokens(spark, path))


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return query(spark, sf_dir)
    return run


QUERIES = {q.__name__: _shipped(q) for q in (
    op1_minhash, op2_warc, op3_sharding, op4_ann, op5_suffix_tree,
    op6_repeats, op7_secret_scan, op8_decontaminate, op9_toxicity, op10_bpe, op11_spelling, op12_hard_negatives, op13_token_files)}

#: Components over links of full shingle sets, by a recursive join.
_OP1_SQL = r"""
with recursive
w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents),
p as (select doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) as i from w where len(words) > 0),
s as (select distinct doc_id, array_to_string(words[i:i + 4], ' ') as g from p),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 85 * (x.n + y.n - k)),
edges as (select a, b from links union all select b, a from links),
reach as (select doc_id as a, doc_id as b from documents union select r.a, e.b from reach r join edges e on r.b = e.a),
comp as (select a as doc_id, min(b) as component_id from reach group by a)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join n using (doc_id) join comp using (doc_id)"""

#: Base32 of a digest: five bits a letter, four letters of each five hex digits.
_OP2_SQL = """
with d as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as x from pages),
f as (select x, min(page_id) as first_id from d group by x),
g as (select d.*, first_id, """ + ", ".join(
    f"cast('0x' || substr(x, {5 * k + 1}, 5) as bigint) as v{k}" for k in range(8)) + """ from d join f using (x))
select page_id, cast(payload_bytes as bigint) as payload_bytes, """ + " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(((v{k} >> {s}) & 31) + 1 as int), 1)" for k in range(8) for s in (15, 10, 5, 0)) + """
  as payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to from g"""

#: Every 400-byte window of the texts in hex, counted; what is left of a text is put together again.
_OP6_SQL = """
with h as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
w as (select doc_id, k, hash(substr(x, 2 * k + 1, 800)) as m
  from (select doc_id, x, unnest(range(0, len(x) // 2 - 399)) as k from h where len(x) >= 800) q),
twice as (select m from w group by m having count(*) > 1),
starts as (select doc_id, k, k - lag(k) over (partition by doc_id order by k) as gap from w semi join twice using (m)),
runs as (select doc_id, k, sum(case when gap is null or gap > 400 then 1 else 0 end) over (partition by doc_id order by k) as r from starts),
spans as (select doc_id, min(k) as a, max(k) + 400 as b from runs group by doc_id, r),
cuts as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as p from spans),
kept as (select c.doc_id, sum(b - a) as gone, count(*) as n, string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' order by a)
  || substr(any_value(x), 2 * max(b) + 1) as rest from cuts c join h using (doc_id) group by c.doc_id)
select h.doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(gone, 0) as bigint) as n_removed,
  cast(coalesce(n, 0) as bigint) as n_spans, sha256(unhex(coalesce(rest, x))) as kept_sha256
from h left join kept using (doc_id)"""

#: crc32 byte by byte from its table; words that share all letters around a gap are near.
_OP11_SQL = """
with recursive
t as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, _: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as crc),
r as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[A-Za-z\u00C0-\u00FF]+')) as w from documents),
d as (select doc_id, w, count(*) as n from r group by all),
b as (select w, n, flatten(list_transform(string_split(coalesce(cast(doc_id as varchar), '') || ':' || w, ''),
  lambda c: case when unicode(c) < 128 then [cast(unicode(c) as bigint)] else [195, cast(unicode(c) - 64 as bigint)] end)) as bytes from d),
h as (select w, n, xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
  lambda c, x: xor(c >> 8, crc[1 + (xor(c, x) & 255)]))) as h from b, t),
s as (select case when h % 97 = 0 then substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, n from h),
v as (select word, cast(sum(n) as bigint) as n from s group by word having sum(n) >= 3 and length(word) >= 5),
g as (select word, n, i, substr(word, 1, i) || substr(word, i + 2) as rest from (select *, unnest(range(length(word))) as i from v) q),
e as (select a.word, a.n, b.word as other, b.n as m from g a join g b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select g.word, g.n, v.word, v.n from g join v on g.rest = v.word
  union select v.word, v.n, g.word, g.n from g join v on g.rest = v.word),
k as (select *, count(*) over (partition by word) as n_near, row_number() over (partition by word order by m desc, other) as place from e),
f as (select word, n_near, case when m >= 2 * n then other end as form, case when m >= 2 * n then m end as form_n from k where place = 1),
p as (select word, word as root from v union all select p.word, f.form from p join f on f.word = p.root where f.form is not null),
l as (select p.word, p.root from p left join f on f.word = p.root where f.form is null)
select v.word, form, root, v.n, cast(coalesce(n_near, 0) as bigint) as n_near, form_n from v join l using (word) left join f using (word)"""

#: Every anchor against every row.
_OP12_SQL = """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  list_transform(embedding, lambda x: floor(256 * cast(x as double))) as c from embeddings
  where vec_id is not null and label is not null and embedding is not null
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, b.vec_id, b.label = a.label as same, cast(list_inner_product(a.c, b.c) as bigint) as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.c) = len(b.c)),
p as (select anchor_id, vec_id as positive_id, score as positive_score,
  row_number() over (partition by anchor_id order by score desc, vec_id) as place from s where same),
n as (select p.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
  row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank
  from p join s on s.anchor_id = p.anchor_id and not same and place <= 5
  and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 5"""

#: SQL that says the same, for ids that are unique and not null.
ORACLES: dict[str, str] = {"op1_minhash": _OP1_SQL, "op2_warc": _OP2_SQL, "op6_repeats": _OP6_SQL, "op11_spelling": _OP11_SQL,
                           "op12_hard_negatives": _OP12_SQL}
