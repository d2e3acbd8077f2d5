"""N-grams counted as arrays, and texts scored in one pass, give what lines of symbols and joins give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.functions import packed_model
from quarry.operators import language_model as lm
from quarry.operators import packed_scoring as ps
from quarry.plans import language_queries, markup_queries

TEXTS = [(1, "ab\n\nbé \t x", True), (2, "a", True), (3, "", True), (4, None, False), (5, "\U0001f642 a\xa0\n", False), (6, "Aaaa" * 30, None), (7, "abab ab", False), (7, "ab", True), (None, "ab", True)]
SCHEMA = "key int, text string, clean boolean"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("order, piece", [(1, 5), (3, 7), (3, 1 << 20), (12, 9)])
def test_longest_counts(spark, monkeypatch, order, piece):
    monkeypatch.setattr(packed_model, "PIECE", piece)
    texts = spark.createDataFrame(TEXTS, SCHEMA)
    own = lm.line_symbols(texts.select(F.lit(1).alias("key"), "text"), "key")
    expected = {r.ngram: r.n for r in lm.scored_ngrams(own, "key", order).collect()}
    found = [packed_model.longest_counts(packed_model.text_codes(t), order) for _, t, _ in TEXTS if t]
    total: dict[str, int] = {}
    for grams, counts in found:
        for g, n in zip(grams, counts.tolist()):
            total[g] = total.get(g, 0) + n
    assert total == expected


def test_counts_of_texts_by_kind(spark):
    texts = spark.createDataFrame(TEXTS, SCHEMA)
    found = lm.text_ngram_counts(texts, 3, by="clean").cache()
    for kind in (True, False, None):
        own = lm.ngram_counts(lm.line_symbols(texts.where(F.col("clean").eqNullSafe(kind)), "key"), 3)
        assert rows_of(found.where(F.col("clean").eqNullSafe(kind)).drop("clean")) == rows_of(own)


def test_scores_are_those_of_the_join(spark):
    texts = spark.createDataFrame(TEXTS, SCHEMA)
    clean, dirty = language_queries.both_models(texts)
    rounded = lambda df: rows_of(df.select("key", F.round("score", 9) + 0.0, "is_clean"))
    joined = lm.classify(texts, clean, dirty, 3)
    assert rounded(ps.classify_by_key(texts, clean, dirty, 3)) == rounded(joined) == rounded(ps.classify_by_key(texts, clean, dirty, 3, most=0))
    single = texts.where("key < 7")
    both = [rows_of(ps.text_scores_of(single, {"clean": clean, "dirty": dirty}, 3, by="clean", most=m).select("clean", "model", "n", F.round("logp", 9))) for m in (0, 1 << 20)]
    assert both[0] == both[1] and len(both[0]) == 6


def test_no_ngram_of_a_text_is_joined(spark, monkeypatch):
    def no_join(*_, **__):
        raise AssertionError("joined")

    for name in ("scored_ngrams", "ngram_scores", "line_symbols"):
        monkeypatch.setattr(lm, name, no_join)
    sf = "/root/testdata/sf0.001"
    for name in ("lm_classify_all", "lm_perplexity"):
        assert language_queries.QUERIES[name](spark, sf).count()
    # Nor of a page's section.
    assert markup_queries.build_corpus(spark, sf).count()
