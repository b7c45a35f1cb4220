"""A training-text pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written and read again
as the next stage's ``docs``.  All but the last keep the columns of ``documents``.

    toxicity      documents scored at or above the threshold go
    near_dedup    one document of each group of near-duplicates (five words, 0.8) stays
    decontaminate documents that hold a benchmark item within the edit budget go
    secrets       findings in the text are replaced by a mark; every document stays
    tokens        doc_id, text, ids, n_tokens and the decoded text of every document
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripsmith.llm import bpe, decontaminate, minhash, secret_scan, toxicity
from tripsmith.llm.common import materialise, ship_code, sized, table

PERCENT = 80
#: Rows that a Python worker gets at a time.  Texts run to 100 kB, so Spark's 10,000 would hold hundreds of MB.
BATCH_ROWS = 1000


def _ready(spark: SparkSession) -> None:
    ship_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score is below the threshold.

    Null and empty texts have the score of a text without evidence and stay; repeated rows fare alike.
    """
    _ready(spark)
    scorer = spark.sparkContext.broadcast(toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return docs.where(toxicity.toxic_score(F.col("text"), scorer) < toxicity.THRESHOLD)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group; of rows that share it, the one with the smallest text.

    Rows without doc_id cannot be named as another's copy and stay; so do rows without words.
    """
    _ready(spark)
    groups = materialise(minhash.near_duplicates(docs, percent=PERCENT).where("doc_id is not null"), "groups")
    gone = sized(materialise(groups.where("not kept").select("doc_id").distinct(), "gone"))
    repeated = materialise(groups.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    if not repeated.limit(1).count():
        return kept
    once = (kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).groupBy("doc_id")
            .agg(F.min_by(F.struct(*docs.columns), F.coalesce("text", F.lit(""))).alias("_row")).select("_row.*"))
    return kept.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item.

    Null and empty texts hold none and stay; repeated rows fare alike.  Items without id count as well.
    """
    _ready(spark)
    for block in decontaminate.item_blocks(table(spark, sf_dir, "benchmark")):
        docs = docs.where(~decontaminate.contaminated(F.col("text"), block))
    return docs


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with findings redacted in the text.  Null texts stay null, empty ones empty; repeated rows are redacted alike."""
    _ready(spark)
    text = secret_scan.redacted(F.col("text"))
    return docs.select(*(text.alias("text") if c == "text" else docs[c] for c in docs.columns))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), n_tokens, decoded, a row per row.

    Null and empty texts have no ids and decode to the empty text; repeated rows give repeated results.
    """
    _ready(spark)
    coded = docs.select("doc_id", bpe.encoded(spark, F.col("text"), public_tokenizers.path("byte_bpe_50k.json")).alias("_r"))
    return coded.select("doc_id", "_r.ids", "_r.n_tokens", "_r.decoded")


STAGES = [("toxicity", toxicity_stage), ("near_dedup", near_dedup_stage), ("decontaminate", decontaminate_stage),
          ("secrets", secrets_stage), ("tokens", tokens_stage)]

#: No stage is expressible in SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each on what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
