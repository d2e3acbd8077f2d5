"""Charsets of the tokenizer's variants against Python's codecs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quarry.functions import charsets
from quarry.functions.charsets import VARIANTS, decoded, encoded, is_kept
from quarry.operators.tokenizer import segment
from quarry.plans import more_queries
from quarry.sources.pages import read_running_text

TEXTS = ["", "plain [a]\\-^", "Größe – „so“ €5", "Ёлка № 5 и «так»", "日本 😀 é", "\x80\x98\x9f\xa0", None]
CHARSETS = sorted({c for _, c in VARIANTS.values()})


def lossy(text, charset):
    return "".join(c if c.encode(charset, "ignore") or charset.startswith("cp") and 128 <= ord(c) < 160 and not bytes([ord(c)]).decode(charset, "ignore") else "?" for c in text)


@pytest.mark.parametrize("charset", CHARSETS)
def test_bytes_and_back(spark, charset):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    b = encoded(F.col("text"), charset)
    for r in rows.select("text", b.alias("b"), decoded(b, charset).alias("back"), is_kept(F.col("text"), charset).alias("kept")).collect():
        if r.text is None:
            assert r.b is None and r.back is None
            continue
        assert r.back == lossy(r.text, charset) and r.kept == (r.back == r.text)
        if r.kept and not any(128 <= ord(c) < 160 for c in r.text):
            assert bytes(r.b) == r.text.encode(charset)


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_files_of_each_variant(spark, tmp_path, variant):
    lang, charset = VARIANTS[variant]
    text = {"de": "Größe zählt. Das ist so.", "en": "That is £5. It is so.", "ru": "Это так. Да, так."}[lang]
    (tmp_path / "a.txt").write_bytes(text.encode(charset))
    (tmp_path / "b.txt").write_bytes(b"")
    rows = sorted(read_running_text(spark, str(tmp_path), variant).collect())
    assert [(r.path[-5:], r.lang, r.text) for r in rows] == [("a.txt", lang, text)]
    assert len(segment(spark.createDataFrame(rows), "text", "lang").orderBy("path").first().sentences) == 2


def test_whole_tables_in_one_pass(spark):
    signs = "".join(map(chr, [*range(0x3000), *range(0xD7F0, 0xD800), *range(0xE000, 0xE010), 0xFFFD, 0xFFFF, 0x1F600]))
    rows = [(k, signs[k::97]) for k in range(97)] + [(97, ""), (98, None), (99, "plain"), (None, "Ж")]
    docs = spark.createDataFrame(rows, "k int, text string")
    known = sorted({c for _, c in charsets.VARIANTS.values()})
    found = charsets.there_and_back(docs, known, "k")
    text = F.coalesce("text", F.lit(""))
    for c in known:
        content = charsets.encoded(text, c)
        own = docs.select("k", F.octet_length(content).cast("long").alias("n"), (charsets.decoded(content, c) == text).alias("s"))
        assert sorted(map(tuple, found.where(F.col("charset") == c).select("k", "n_bytes", "same").collect()), key=repr) == sorted(map(tuple, own.collect()), key=repr)
        made = {r.text: bytes(r.b) for r in docs.where("text is not null").select("text", charsets.encoded(F.col("text"), c).alias("b")).collect()}
        assert all(charsets.encode_text(t, c) == b and charsets.decode_text(b, c) == (t if c == "utf-8" else "".join(x if x in charsets.upper_half(c) or x < "\x80" else "?" for x in t)) for t, b in made.items())


def test_no_text_is_taken_apart_for_each_charset(spark):
    plan = more_queries.charset_variants(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "translate" not in plan and "regexp_replace" not in plan
