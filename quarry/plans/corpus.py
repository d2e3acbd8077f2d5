"""From pages of markup to numbered lines of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import articles, markup, sections
from quarry.operators.common import settle
from quarry.operators.packed_scoring import classify_by_key


def build_corpus(pages: DataFrame, clean: DataFrame, dirty: DataFrame, order: int, unwanted: DataFrame | None = None, language: str = "en") -> DataFrame:
    """(seg, art_id, sent_id, line) of `pages` (title, markup).

    Each section is scored by the clean and the dirty model; clean ones are
    kept, and headings that lead to them. Kept sections are segmented and get
    their marks back. Articles without any line get no number.
    """
    if unwanted is not None:
        pages = articles.without(pages, unwanted)
    # Pages are parsed once for scores and headings.
    rows = settle(markup.sections_of(pages).where(F.col("error").isNull()))
    keyed = rows.withColumn("key", F.struct("title", "sec_idx"))
    scores = classify_by_key(keyed.select("key", F.concat_ws("\n", "heading", "content").alias("text")), clean, dirty, order)
    rows = keyed.join(scores, "key").withColumn("clean", F.col("is_clean") & (F.length("content") > 0))
    kept = sections.retain_headings(rows, "title").where("sprint")
    keep = kept.groupBy("title").agg(F.collect_list(F.struct("sec_idx", F.col("clean").alias("whole"))).alias("keep"))
    lines = markup.marked_lines(pages.join(keep, "title"), language)
    texts = lines.where(F.size("lines") > 0).select("title", F.array_join("lines", "\n").alias("text"), "lines")
    return articles.corpus_lines(articles.article_ids(texts), F.col("lines"))


def training_texts(pages: DataFrame, stats: DataFrame, **limits) -> DataFrame:
    """(title, sec_idx, clean, dirty, text) of the sections that heading statistics label."""
    rows = markup.sections_of(pages).where(F.col("error").isNull()).withColumnRenamed("title", "article").withColumnRenamed("sec_title", "title")
    out = sections.training_labels(rows, stats, **limits).where("clean or dirty")
    return out.select(F.col("article").alias("title"), "sec_idx", "clean", "dirty", F.concat_ws("\n", "heading", "content").alias("text"))
