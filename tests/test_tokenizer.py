"""Hyphens at line ends and the modes of printing, worked out by hand."""

from __future__ import annotations

import time
import tracemalloc

from pyspark.sql import functions as F

from quarry.functions.lexer import Lexer
from quarry.operators import templates, tokenizer


def words(text, **options):
    return [x for _, x in Lexer(**options).tokens(text) if x.strip()]


def test_hyphens_at_line_ends():
    text = "a con-\nver-\n tible half-\nway first-\nclass soft\xadly Up-\nTown"
    assert words(text, hyphens="drop") == ["a", "convertible", "half-way", "first-class", "softly", "Up", "-", "Town"]
    assert words(text, hyphens="keep")[1] == "con-ver-tible" and "-" in words(text)
    assert words("self-\nmade", hyphens="drop", language="de") == ["selfmade"]
    began = time.time()
    assert len(words("con-\nver " * 20_000, hyphens="drop")) == 20_000 and time.time() - began < 20


def test_print_modes(spark):
    docs = spark.createDataFrame([(1, "One two. Three\nfour.\n\nFive six."), (2, None), (3, "")], "k int, text string")

    def out(**options):
        found = {r.k: r.out for r in tokenizer.printed(docs, "k", **options).collect()}
        assert found[2] is None and found[3] == ""
        return found[1]

    assert out() == "One two.<EOS /> Three\nfour.<EOS />\n\nFive six."
    assert out(mark="#", line_ends=True) == "One two.# Three#\nfour.##\n\nFive six."
    assert out(mark="#", paragraph_ends=True) == "One two.# Three\nfour.##\n\nFive six."
    assert out(mode="single", mark="#", separator="|") == "One|two|.|#|Three|four|.|#|Five|six|.|"
    assert out(mode="single", mark="#", separator="|", spaces=True) == "One| |two|.|#| |Three|four|.|#|\n\nFive| |six|.|"
    assert out(mode="sentences") == "One two.\nThree four.\n\nFive six." and out(mode="paragraphs", mark="").split("\n") == ["One two. Three four.", "Five six."]


def test_scanner_tokens_and_raw_tags(spark):
    pages = spark.createDataFrame([("a", "x {{t|{{{1}}}}} [[l|m]]<!-- {{c}} --><noinclude>y</noinclude> {z")], "title string, markup string")
    rows = [(r.kind, r.text) for r in templates.scanner_tokens(pages, "title").orderBy("pos").collect()]
    assert rows == [
        ("text", "x "), ("call", "{{"), ("text", "t"), ("bar", "|"), ("argument", "{{{"), ("text", "1"), ("argument", "}}}"), ("call", "}}"), ("text", " "), ("link", "[["), ("text", "l"), ("bar", "|"), ("text", "m"), ("link", "]]"),
        ("comment", "<!-- {{c}} -->"), ("tag", "<noinclude>"), ("text", "y"), ("tag", "</noinclude>"), ("text", " "), ("text", "{"), ("text", "z"),
    ]
    raw = spark.createDataFrame([("a<!-- {{b}}\n -->c<NOWIKI>{{d}}</nowiki>e<ref name=x>f</ref>",)], "t string").select(templates.without_raw_tags(F.col("t"))).first()[0]
    assert raw == "a\nc\ne<ref name=x>f</ref>"


def test_words_in_a_row_are_single_tokens():
    text = "Foo bar, baz; qux-quux (12 May 2001) in mai xvi drops, then e@x.org sees. Two  \t\nMay I go? Yes, a-b c1 \xa0d"
    for options in ({}, {"sentence_ends": False, "addresses": False}):
        lexer = Lexer("en", **options)
        tokens = lexer.tokens(text)
        found, longest = lexer.counts(text)
        assert found == {t: sum(n == t for n, _ in tokens) for t in found} and longest == 8
        assert [p for n, p in tokens if n == "WORD"][:5] == ["Foo", "bar", "baz", "qux-quux", "May"]
        assert tokens[:4] == [("WORD", "Foo"), ("HSPACE", " "), ("WORD", "bar"), ("OTHER", ",")]
        assert ("RUN", "Foo bar, baz; ") == next(lexer.parts(text))


def test_counts_take_no_list_of_tokens():
    text = "one two, three 4 " * 100_000
    tracemalloc.start()
    found, longest = Lexer("en", sentence_ends=False, addresses=False).counts(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found["WORD"], found["NUMBER"], found["OTHER"], longest) == (300_000, 100_000, 100_000, 5)
    assert peak < 8 << 20


def test_counts_of_null_and_empty_texts(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a bb 7!")], "k int, text string")
    out = rows.select("k", tokenizer.counts_of("en")(F.col("text")).alias("x")).select("k", "x.*").orderBy("k").collect()
    assert [tuple(r) for r in out] == [(1, None, None, None, None), (2, 0, 0, 0, 0), (3, 2, 1, 1, 2)]


def test_few_places_are_tried_by_all_rules():
    class Counting:
        def __init__(self, rule):
            self.rule, self.groupindex, self.tries = rule, rule.groupindex, 0

        def match(self, text, at):
            self.tries += 1
            return self.rule.match(text, at)

    lexer = Lexer("en")
    lexer.rules = [(n, Counting(p)) for n, p in lexer.rules]
    # Only the words before a bracket, in one and at the end.
    assert len(lexer.sentences("One two, three; (four) five. " * 100)) == 100
    assert lexer.rules[0][1].tries <= 300


def test_exploded_sentences_are_made_once(spark):
    docs = spark.createDataFrame([(1, "en", "One two. Three."), (2, "en", ""), (3, "de", None)], "k int, lang string, text string")
    out = tokenizer.segment(docs).select("k", F.posexplode("sentences").alias("pos", "sentence"))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in out.orderBy("k", "pos").collect()] == [(1, 0, "One two."), (1, 1, "Three.")]
