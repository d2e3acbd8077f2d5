"""The training-data pipeline: quality, near-dedup, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontamination, near_dedup, quality, secrets
from quarry.llm.common import settle, short_batches, table
from quarry.sources.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"
QUALITY_LEAST = 0.7


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under QUALITY_LEAST go."""
    ship(spark)
    short_batches(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, keep=("text", "lang", "source", "n_chars"))
    return scored.where(F.col("score") >= QUALITY_LEAST).select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8) the document of least id stays.

    Documents without words stay. Of a group's rows that share the least id the
    one of the least text stays. In a group without ids all rows stay.
    """
    ship(spark)
    short_batches(spark)
    found = settle(near_dedup.near_duplicates(docs, size=5, num=80, den=100))
    gone = settle(found.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h")).distinct())
    if gone.count() * 32 <= near_dedup.BROADCAST_BYTES:
        gone = F.broadcast(gone)
    hashed = docs.withColumn("_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    stay = hashed.join(gone, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left_anti").select(*COLUMNS)
    repeated = found.where(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("doc_id").agg(F.count("*").alias("_n")).where("_n > 1 and doc_id is not null").select("doc_id")
    repeated = settle(repeated)
    if repeated.isEmpty():
        return stay
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = stay.join(repeated.withColumn("_same", F.lit(True)), "doc_id", "left").withColumn("_same", F.coalesce("_same", F.lit(False)) & has_words)
    # Each task folds the rows of an id before they are sent on.
    first = same.where("_same").groupBy("doc_id").agg(F.min(F.struct("text", "source", "lang", "n_chars")).alias("_first"))
    first = first.select("doc_id", *(F.col(f"_first.{c}").alias(c) for c in ("text", "lang", "source", "n_chars")))
    return same.where(~F.col("_same")).select(*COLUMNS).unionByName(first.select(*COLUMNS))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    ship(spark)
    short_batches(spark)
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"), keep=("text", "lang", "source", "n_chars"))
    return found.where("n_hit = 0").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mask; n_chars follows."""
    out = secrets.redact(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source"), keep=("lang", "source"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    ship(spark)
    short_batches(spark)
    path = public_tokenizers.path(TOKENIZER)
    out = bpe.encode(docs, path, bpe.build_lexicon(docs, path), keep=("lang", "source", "n_chars"))
    return out.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), F.col("ids").alias("token_ids"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

#: Trained scores and tokens are beyond SQL; tests hold the pipeline against plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is settled for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs)
    return docs
