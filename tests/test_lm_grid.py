"""One count for a grid of models: each is the model that is trained alone."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import language_model as lm

LINES = [("a", "the cat sat on the mat"), ("a", "the dog sat\non the log"), ("b", "aaaa aaab"), ("b", ""), (None, "cats and dogs"), (None, "the cat sat on the mat"), ("c", None)]


def rows_of(spark, lines=LINES):
    return lm.line_symbols(spark.createDataFrame(lines, "kind string, text string").repartition(3), "kind")


def found(df):
    return sorted((r.ord, r.ngram, None if r.logp is None else round(r.logp, 9), round(r.bow, 9)) for r in df.collect())


@pytest.mark.parametrize("method", lm.METHODS)
def test_each_model_of_a_grid_is_the_one_trained_alone(spark, method):
    rows = rows_of(spark)
    both = lm.grid(rows, (1, 2, 4), (method,), by="kind").cache()
    for kind in ("a", "b", None):
        own = rows.where(rows.kind.eqNullSafe(kind))
        for n in (1, 2, 4):
            alone = found(lm.train(own, n, method))
            assert found(both.where(both.kind.eqNullSafe(kind) & (both.max_order == n))) == alone and alone


def test_a_grid_of_all_methods_at_once(spark):
    rows = rows_of(spark)
    every = lm.grid(rows, (2, 3)).cache()
    assert every.columns == ["method", "max_order", "ord", "ngram", "logp", "bow"]
    for method in lm.METHODS:
        assert found(every.where((every.method == method) & (every.max_order == 3))) == found(lm.train(rows, 3, method))


def test_a_grid_of_nothing(spark):
    assert lm.grid(rows_of(spark, []), (2,), by="kind").count() == 0 and lm.grid(rows_of(spark, [("a", "")]), (2,)).count() == 0
    for orders, methods in (((), lm.METHODS), ((0,), lm.METHODS), ((2,), ("none",))):
        with pytest.raises(ValueError):
            lm.grid(rows_of(spark), orders, methods)


def test_tables_of_ngrams_are_never_broadcast(spark, monkeypatch):
    # A text of few bytes has many n-grams, which the estimated sizes of plans don't know.
    monkeypatch.setattr(lm, "settle", lambda df: df)
    keys = re.compile(r"(\w+) (\[[^\]]*(?:ngram|\bh|\bs)#[^\]]*\])")

    def joins(df):
        return [kind for kind, _ in keys.findall(df._jdf.queryExecution().executedPlan().toString()) if kind.endswith("Join")]

    for model in (lm.grid(rows_of(spark), (2, 3), by="kind"), lm.train(rows_of(spark), 2, "kneser_ney")):
        assert len(joins(model)) >= 4 and set(joins(model)) == {"SortMergeJoin"}


def test_parts_of_ngrams(spark):
    rows = spark.createDataFrame([("<s> a b",), ("a",)], "x string")
    out = rows.select(lm._context(F.col("x")), lm._suffix(F.col("x")), lm._ends(F.col("x"))).collect()
    assert [tuple(r[:2]) for r in out] == [("<s> a", "a b"), ("", "")]
    assert [[tuple(e) for e in r[2]] for r in out] == [[(1, "b"), (2, "a b"), (3, "<s> a b")], [(1, "a")]]
