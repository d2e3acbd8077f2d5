"""Packed models score as joined ones do."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import packed_model
from quarry.operators import language_model as lm
from quarry.operators.packed_scoring import classify_packed, packed

CLEAN = [(1, "the cat sat on the mat\nthe dog"), (2, "a cat and a dog"), (3, "é ü 日本 😀 cats\\x")]
DIRTY = [(4, "### $$$ cat"), (5, "%%% the &&&\n\n###")]
TEXTS = [*CLEAN, *DIRTY, (6, ""), (7, None), (8, "zzz unseen ß\n"), (None, "the mat"), (None, "the mat"), (9, " \t\x1c\x0b\n"), (10, "\\ \\x \x85 cat" * 50)]


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "key long, text string").repartition(2)


@pytest.mark.parametrize("order,method", [(1, "witten_bell"), (3, "absolute"), (3, "modified_kneser_ney"), (5, "kneser_ney"), (4, "additive")])
def test_packed_scores_are_those_of_the_join(spark, order, method, monkeypatch):
    monkeypatch.setattr(packed_model, "PIECE", 7)
    clean, dirty = (lm.train(lm.line_symbols(rows_of(spark, x), "key"), order, method) for x in (CLEAN, DIRTY))
    texts = rows_of(spark, TEXTS)
    found = classify_packed(texts, clean, dirty, order)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().replace("REPARTITION", "").split("MapInArrow")[0]
    got = sorted(((r.key, round(r.score, 8), r.is_clean) for r in found.collect()), key=repr)
    named = texts.where("key is not null").withColumn("text", F.coalesce("text", F.lit("")))
    want = {r.key: (round(r.score, 8), r.is_clean) for r in lm.classify(named, clean, dirty, order).collect()}
    assert len(got) == len(TEXTS) and {k: (s, c) for k, s, c in got if k is not None} == want
    assert got[-1] == got[-2] and got[-1][0] is None
    # Too large to be packed: joined.
    joined = {r.key: (round(r.score, 8), r.is_clean) for r in classify_packed(named, clean, dirty, order, most=1).collect()}
    assert joined == want


def test_pieces_of_a_long_text(spark, monkeypatch):
    model = packed(lm.train(lm.line_symbols(rows_of(spark, CLEAN), "key"), 4, "witten_bell"))
    codes = packed_model.text_codes("the cat sat\non a dog " * 400)
    whole = model.text_score(codes)
    for piece in (1, 2, 3, 10, 1000):
        monkeypatch.setattr(packed_model, "PIECE", piece)
        assert model.text_score(codes) == pytest.approx(whole, abs=1e-6)


def test_symbols_of_texts():
    s, e = packed_model.START, packed_model.END
    assert packed_model.text_codes("a b\n\nc").tolist() == [s, 97, 98, e, s, e, s, 99, e]
    assert packed_model.text_codes("").tolist() == [] and packed_model.text_codes(" ").tolist() == [s, e]
    assert packed_model.text_codes("\n").tolist() == [s, e, s, e] and np.array_equal(packed_model.text_codes("😀"), [s, 0x1F600, e])


def test_models_without_unknown_symbols_are_refused(spark):
    with pytest.raises(ValueError):
        packed(spark.createDataFrame([(1, "a", -1.0, 0.0)], "ord int, ngram string, logp double, bow double"))
