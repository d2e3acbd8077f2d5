"""Texts scored by models that every task holds packed, so that no n-gram is shuffled."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.packed_model import START, PackedModel, pack, text_codes
from quarry.operators.common import short_batches
from quarry.operators.language_model import classify, text_scores

#: Models of up to this many n-grams are packed: 24 bytes each, and while they are made about 300 on the driver.
PACKED_NGRAMS = 1 << 20


def packed(model: DataFrame, most: int = PACKED_NGRAMS) -> PackedModel | None:
    """The model as arrays, or None if it has more than `most` n-grams."""
    return pack(model.select("ngram", "logp", "bow").toArrow()) if model.count() <= most else None


def classify_packed(texts: DataFrame, clean: DataFrame, dirty: DataFrame, order: int, key: str = "key", text: str = "text", most: int = PACKED_NGRAMS) -> DataFrame:
    """(key, score, is_clean) as `classify` gives them, in one pass over the texts.

    Null texts count as empty, null and repeated keys stay rows of their own.
    Models of more than `most` n-grams are joined instead, which gives a row
    for each key with the same scores.
    """
    both = packed(clean, most), packed(dirty, most)
    if None in both:
        return classify(texts, clean, dirty, order, key, text)
    sent = texts.sparkSession.sparkContext.broadcast(both)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, d = sent.value
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                codes = (text_codes(x.as_py() or "") for x in part.column(1))
                scores = pa.array([c.text_score(x) - d.text_score(x) if len(x) else 0.0 for x in codes], pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), scores], ["key", "score"])

    kind = texts.schema[key].dataType.simpleString()
    out = texts.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(score, f"key {kind}, score double")
    return out.select(F.col("key").alias(key), "score", (F.col("score") > 0).alias("is_clean"))


def _text_figures(texts: DataFrame, models: list[PackedModel], keep: str, text: str) -> DataFrame:
    """(`keep`, full, n, scores) of each text: whether it has a letter or sign, how many symbols and line ends, and their score in each model."""
    short_batches(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            full, n, scores = [], [], []
            for x in b.column(1):
                codes = text_codes(x.as_py() or "")
                full.append(len(codes) > 0)
                n.append(int((codes != START).sum()))
                scores.append([m.text_score(codes) if len(codes) else 0.0 for m in sent.value])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(full, pa.bool_()), pa.array(n, pa.int64()), pa.array(scores, pa.list_(pa.float64()))], [keep, "full", "n", "scores"])

    return texts.select(keep, text).mapInArrow(run, f"`{keep}` {texts.schema[keep].dataType.simpleString()}, full boolean, n long, scores array<double>")


def classify_by_key(texts: DataFrame, clean: DataFrame, dirty: DataFrame, order: int, key: str = "key", text: str = "text", most: int = PACKED_NGRAMS) -> DataFrame:
    """(key, score, is_clean) as `classify` gives them, also for null and repeated keys: texts of one key share their score, those without one have 0. Only keys and scores are shuffled."""
    both = packed(clean, most), packed(dirty, most)
    if None in both:
        return classify(texts, clean, dirty, order, key, text)
    scores = F.col("scores")
    out = _text_figures(texts, list(both), key, text).select(key, "full", (scores[0] - scores[1]).alias("own"))
    shared = F.sum("own").over(Window.partitionBy(key))
    out = out.withColumn("score", F.when(F.col(key).isNull(), 0.0).otherwise(shared))
    return out.select(key, "score", ((F.col("score") > 0) & F.col("full")).alias("is_clean"))


def text_scores_of(texts: DataFrame, models: dict[str, DataFrame], order: int, by: str, key: str = "key", text: str = "text", most: int = PACKED_NGRAMS) -> DataFrame:
    """(`by`, model, n, logp): symbols and line ends of the texts of each value of `by`, and their score in each model, in one pass over the texts."""
    held = {name: packed(m, most) for name, m in models.items()}
    if None in held.values():
        parts = []
        for name, m in models.items():
            rows = texts.select(by, key).join(text_scores(texts.select(key, text), m, order, key, text), key)
            parts.append(rows.groupBy(by).agg(F.sum("n").alias("n"), F.sum("logp").alias("logp")).select(by, F.lit(name).alias("model"), "n", "logp"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    figures = _text_figures(texts, list(held.values()), by, text)
    each = figures.select(by, "n", F.explode(F.arrays_zip(F.array(*(F.lit(n) for n in held)).alias("model"), F.col("scores").alias("logp"))).alias("x"))
    return each.groupBy(by, F.col("x.model").alias("model")).agg(F.sum("n").alias("n"), F.sum("x.logp").alias("logp"))
