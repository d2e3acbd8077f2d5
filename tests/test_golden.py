"""Small cases with results worked out by hand."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quarry.functions import align, markup, text
from quarry.functions.lexer import Lexer
from quarry.functions.template_calls import Expander
from quarry.operators import articles, language_model, sections, templates
from quarry.operators import markup as pages
from quarry.operators.common import numbered
from quarry.operators.tokenizer import segment, token_lines
from quarry.plans.corpus import build_corpus, training_texts
from quarry.sources import pages as sources
from quarry.sources import sinks
from quarry.streaming import articles as streaming


@pytest.mark.parametrize(("levels", "clean", "shown"), [((1, 2, 3, 2, 3), "FFTFF", "TTTFF"), ((1, 3, 2, 4), "FFFT", "TFTT"), ((1, 2, 2), "FFF", "FFF"), ((1, 2), "TF", "TF")])
def test_headings_that_lead_to_clean_sections(spark, levels, clean, shown):
    rows = [("a", i, v, c == "T", "x") for i, (v, c) in enumerate(zip(levels, clean))]
    out = sections.retain_headings(spark.createDataFrame(rows, "article string, sec_idx int, level int, clean boolean, content string"), "article")
    assert "".join("T" if r.sprint else "F" for r in out.orderBy("sec_idx").collect()) == shown


def walk(levels, clean):
    """The outline filter as a loop from the end."""
    threshold, out = 0, [False] * len(levels)
    for i in reversed(range(len(levels))):
        if clean[i]:
            threshold, out[i] = levels[i], True
        elif i == 0:
            out[i] = threshold != 0
        elif levels[i] < threshold:
            threshold, out[i] = levels[i], True
    return out


def test_outline_filter_equals_the_loop(spark):
    r = random.Random(1)
    data = [[(1 if i == 0 else r.randint(2, 5), r.random() < 0.3) for i in range(r.randint(1, 8))] for _ in range(300)]
    rows = [(a, i, v, c, "x") for a, d in enumerate(data) for i, (v, c) in enumerate(d)]
    out = sections.retain_headings(spark.createDataFrame(rows, "article int, sec_idx int, level int, clean boolean, content string"), "article")
    got = {(x.article, x.sec_idx): x.sprint for x in out.collect()}
    assert all(got[a, i] == s for a, d in enumerate(data) for i, s in enumerate(walk([v for v, _ in d], [c for _, c in d])))


@pytest.mark.parametrize(("titles", "kept"), [(["Intro", "Notes", "Body", "Notes on style", "References", "After"], 3), (["Intro", "External links", "After"], 1), (["Intro", "See also (films)", "End"], 3), (["Notes"] * 6 + ["End"], 3), (["Intro", "Sources", "End"], 1)])
def test_closing_titles(spark, titles, kept):
    rows = spark.createDataFrame([("a", i, t) for i, t in enumerate(titles)], "article string, sec_idx int, title string")
    assert sections.cut_closing(rows, "article").where("kept").count() == kept


def test_training_labels(spark):
    stats = spark.createDataFrame([("Early career", 1, 900), ("Filmography", 6000, 300), ("Family", 6000, 300), ("Births", 2, 900)], "heading string, count long, avg_len long")
    rows = [("Early career", 4, "x"), ("Early career", 3, "x"), ("Filmography", 5, "x"), ("Filmography", 5, " "), ("Family", 5, "x"), ("Births", 1, "x"), ("Anything", 9, "x")]
    out = sections.training_labels(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, title string, n_par int, content string"), stats)
    assert [(r.clean, r.dirty) for r in out.orderBy("i").collect()] == [(True, False), (False, False), (False, True), (False, False), (False, False), (False, True), (False, False)]


def test_heading_statistics_round_down(spark):
    rows = spark.createDataFrame([("a_b", "x" * 10), ("a_b", "x" * 11)], "title string, content string")
    assert [tuple(r) for r in sections.heading_stats(rows).collect()] == [("a-b", 2, 10)]


def test_islands_of_lines(spark):
    text_lines = ["a", "< h 1 >T< / h 1 >", "b", "c", "< h 2 >U< / h 2 >"]
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(text_lines)], "f int, line_no int, line string")
    assert [r.text for r in sections.islands(lines, "f").orderBy("island").collect()] == ["a", "< h 1 >T< / h 1 >\nb\nc", "< h 2 >U< / h 2 >"]
    assert lines.agg(sections.is_exploded(lines)).first()[0] is True


def test_template_rules(spark):
    rules = spark.createDataFrame([(0, "IPA notice", "remove"), (1, "/stub$/", "remove"), (2, "/^auto/", "keep"), (3, "/^ipa/", "keep")], "ord int, pattern string, action string")
    names = ["IPA notice", "IPA-en", "Auto-stub", "Automatic", "Other"]
    known = [(n, n, 10) for n in names] + [("Missing", None, 10), ("Main page", "Main page", 0)]
    out = templates.action_of(spark.createDataFrame(known, "name string, canonical string, ns int"), templates.resolve_rules(rules, spark.createDataFrame([(n,) for n in names], "name string")))
    assert {r.name: r.action for r in out.collect()} == {"IPA notice": "remove", "IPA-en": "keep", "Auto-stub": "remove", "Automatic": "keep", "Other": "expand", "Missing": "remove", "Main page": "remove"}


def test_substring_cover(spark):
    counts = spark.createDataFrame([("Infobox city", 100), ("Infobox river", 60), ("Geo river", 10), ("Old city", 5)], "name string, direct long")
    assert [tuple(r) for r in templates.substring_cover(counts).collect()] == [(160, "^infobox", ["Infobox city", "Infobox river"])]
    assert templates.substring_cover(counts, skip=1).count() == 1


def test_multiset_difference_and_redirects(spark):
    rows = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x")], "i int, v string")
    assert [r.v for r in articles.multiset_difference(rows, rows.limit(0).union(spark.createDataFrame([(9, "x")], rows.schema)), "v", "i").orderBy("i").collect()] == ["y", "x"]
    hops = spark.createDataFrame([("a", "b"), ("b", "c"), ("p", "q"), ("q", "p")], "src string, dst string")
    assert {r.src: (r.final, r.broken) for r in articles.resolve_redirects(hops, rounds=6).collect()} == {"a": ("c", False), "b": ("c", False), "p": (None, True), "q": (None, True)}
    raw = spark.createDataFrame([(" #REDIRECT [[Foo bar#x|y]]",), ("text #redirect [[x]]",)], "raw string")
    assert [r[0] for r in raw.select(articles.redirect_target(F.col("raw"))).collect()] == ["Foo bar", None]


def test_pages_are_listed_and_followed(spark):
    data = [("B", 0, "b"), ("A", 0, "#redirect [[B]]"), ("Talk:C", 1, "c"), ("D", 0, "#redirect [[None]]")]
    p = spark.createDataFrame(data, "title string, ns int, raw string")
    assert [r.title for r in articles.list_articles(p).collect()] == ["B"] and articles.markup_of(p, "B").first().raw == "b"
    assert {r.title: r.raw for r in articles.follow_redirect(p).collect()} == {"B": "b", "A": "b", "Talk:C": "c", "D": None}
    names = spark.createDataFrame([("Talk:C",), ("Other:x",), ("x",)], "name string")
    assert [tuple(r.n) for r in names.select(articles.split_name(F.col("name"), {"Talk": 1}).alias("n")).collect()] == [(1, "C"), (0, "Other:x"), (0, "x")]
    assert articles.only(p, spark.createDataFrame([("B",), ("B",), ("no",)], "title string")).count() == 3


def test_numbers_and_corpus_lines(spark):
    assert [r.ordinal for r in numbered(spark.createDataFrame([(x,) for x in "cab"], "t string"), "t").orderBy("t").collect()] == [0, 1, 2]
    rows = spark.createDataFrame([("A", "one\ntwo"), ("B", " \n"), ("C", "three")], "title string, text string")
    out = articles.corpus_lines(articles.article_ids(rows), text.lines(F.col("text"))).orderBy("line")
    assert [r.line for r in out.collect()] == ["[1000010000000] |one", "[1000010000010] |two", "[1000010100000] |three"]
    many = spark.range(1001).select(F.format_string("%05d", "id").alias("title"), F.lit("x").alias("text"))
    assert articles.article_ids(many).groupBy("seg").count().orderBy("seg").collect()[1]["count"] == 1


def test_text_functions(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "t string").select(c(F.col("t"))).first()[0]
    assert one(text.exploded, "aé\nb") == "a \\xe9 \n b" and one(text.exploded, None) is None
    for s in ("aé\nb 漢🙂", "a", "x\\y", ""):
        assert spark.createDataFrame([(s,)], "t string").select(text.unexploded(text.exploded(F.col("t")))).first()[0] == s
    assert one(text.lines, "a\r\nb c\n") == ["a", "b", "c"]
    assert [text.base25(n) for n in (0, 24, 25, 650)] == ["a", "y", "ba", "bba"] and all(text.from_base25(text.base25(n)) == n for n in range(0, 2000, 7))
    assert one(text.masked, "x {(a)} y {(b)}") == "x zzzzazzzz y zzzzbzzzz" and one(lambda c: text.unmasked(text.masked(c), text.masked_items(c)), "x {(a)} y {(b)}") == "x {(a)} y {(b)}"
    assert one(text.entity_decoder(), "&lt;b&gt; &#233; &#xE9; &copy; &bogus; &") == "<b> é é © &bogus; &" and one(text.entity_decoder("skip", latin1=True), "&alpha;&bogus;x") == "x"
    assert one(text.html_headings_to_wiki, "<H2 >a</H2><h2>b</h2>") == "<H2 >a</H2>== b ==" and one(text.without_sentence_id, "[12] |x") == "x"


@pytest.mark.parametrize(("s", "n"), [("Dr. Smith went home. She slept.", 2), ("It cost 3.5 dollars. Then 7 left.", 2), ("He lives in the U.S. He is old.", 2), ("See http://a.org/xy. Next one.", 2), ("Smith (b. 1950) came.", 1), ("first line\nsecond line", 2), ("1.\nFoo bar", 1), ("", 0)])
def test_english_sentences(s, n):
    assert len(Lexer().sentences(s)) == n


def test_masks_of_very_many_items(spark):
    one = lambda c, v: spark.createDataFrame([(v,)], "t string").select(c(F.col("t"))).first()[0]
    n = 15_630
    long = "".join(f"{{({i})}} " for i in range(n))
    assert one(text.masked, long) == "".join(f"zzzz{text.base25(i)}zzzz " for i in range(n))
    assert one(lambda c: text.unmasked(text.masked(c), text.masked_items(c)), long) == long


def test_other_languages_and_hyphens():
    assert Lexer("de").sentences("Am 3. Mai 1999 kam Dr. Meier, geb. 1950, z. B. im 19. Jh. Die Frau blieb.") == ["Am 3. Mai 1999 kam Dr. Meier, geb. 1950, z. B. im 19. Jh.", "Die Frau blieb."]
    assert Lexer("ru").sentences("Он жил на ул. Ленина. Потом уехал.") == ["Он жил на ул. Ленина.", "Потом уехал."]
    assert Lexer(hyphens="drop").tokens("exam-\nple")[0] == ("WORD", "example") and Lexer(hyphens="keep").tokens("exam-\nple")[0] == ("WORD", "exam-ple")
    assert [t for t, _ in Lexer().tokens("See a@b.org, 3.5")] == ["WORD", "HSPACE", "WWW", "OTHER", "HSPACE", "NUMBER"]


def test_segment_by_language(spark):
    docs = spark.createDataFrame([(1, "en", "Mr. X came. He left."), (2, "de", "Am 3. Mai war es. Gut."), (3, None, "A b. C d."), (4, "fr", None)], "id int, lang string, text string")
    assert {r.id: r.sentences and len(r.sentences) for r in segment(docs).collect()} == {1: 2, 2: 2, 3: 2, 4: None}
    assert [r.line for r in token_lines(docs.where("id = 1"), "id", lower=True).orderBy("line_no").collect()] == ["mr . x came .", "he left ."]


def test_language_model(spark):
    t = spark.createDataFrame([("k", "aé\nb"), ("m", "a\n\nb"), ("s", "a b"), ("e", "")], "key string, text string")
    grams = language_model.scored_ngrams(language_model.line_symbols(t, "key"), "key", 3)
    want = {"k": ["<s> a", "<s> a \\xe9", "a \\xe9 </s>", "<s> b", "<s> b </s>"], "m": ["<s> a", "<s> a </s>", "<s> </s>", "<s> b", "<s> b </s>"], "s": ["<s> a", "<s> a b", "a b </s>"]}
    got = {}
    for r in grams.collect():
        got.setdefault(r.key, []).extend([r.ngram] * r.n)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("method", language_model.METHODS)
def test_probabilities_of_a_context_add_up(spark, method):
    r = random.Random(2)
    rows = spark.createDataFrame([(i, "".join(r.choice("aabcd") for _ in range(r.randint(1, 9)))) for i in range(60)], "key int, text string")
    model = language_model.train(language_model.line_symbols(rows, "key"), 3, method).cache()
    symbols = [x.ngram for x in model.where("ord = 1 and logp is not null").collect()]
    for context in ("<s> a", "a b", "d d", "b"):
        grams = spark.createDataFrame([(f"{context} {w}",) for w in symbols], "ngram string")
        total = sum(10**x.logp for x in language_model.ngram_scores(grams, model, 3).collect())
        assert total == pytest.approx(1, abs=1e-6), context
    model.unpersist()


@pytest.mark.parametrize(("m", "w", "p"), [(5, 5, 0.03125), (10, 10, 0.0009765625), (4, 3, 0.3125), (0, 0, 1.0), (300, 160, 0.13614)])
def test_sign_test(spark, m, w, p):
    assert spark.range(1).select(language_model.sign_test(F.lit(w), F.lit(m))).first()[0] == pytest.approx(p, abs=2e-4)


WIKI = """Intro '''bold''' one. And [[Link|label two]].<ref>gone</ref> End.

Second <b>para. Here</b> now.

== Hist ''x'' ==
* one
* two."""


def test_sections_and_marks():
    found = markup.sections("Title", WIKI)
    assert [(s["level"], s["title"], s["n_par"]) for s in found] == [(1, "Title", 2), (2, "Hist <Italic>x</Italic>", 0)]
    first = align.article_tree("Title", WIKI)[0]
    plain = markup.Renderer("segment")
    lines = align.marked_sentences(first, Lexer().sentences("Title\n" + "".join(map(plain.render, first.children[:2]))), markup.Renderer("mark"))
    assert [align.new_lines(align.tidy(x)) for x in lines] == ["⌊δTitleδ⌋", "Intro ⌊∗bold∗⌋ one.", "And ⌊>label two>⌋.", "End.\n", "Second ⌊∗para.", "Here∗⌋ now.\n"]
    assert align.escape("a⌊b") == "a⌊⌊⌋b" and align.letters(" a\t b\x00\n") == "ab"


@pytest.mark.parametrize(("s", "want"), [("{(Quote+text+a+b)}", "⌊λtext¦a¦b¦Quoteλ⌋"), ("{(Nbtext+)}", "{(Nbtext+)}"), ("{(Nbtext+)} and {(C+t+a)}", "⌊λ)} and {(C¦t¦a¦Nbtextλ⌋"), ("⌊∗⌊/ /⌋∗⌋x", "x"), ("<___⌊δA\nBδ⌋___>", "⌊δA Bδ⌋"), ("<______>p___NL___", "p___NL___")])
def test_kept_templates(s, want):
    assert align.tidy(s) == want


def test_template_calls():
    bodies = {"A": "[{{{1|d}}} {{B|{{{2}}}}}]", "B": "b{{{1}}}", "K": "kept {{{x}}}", "L": "{{L}}"}
    e = Expander(bodies.get, {"K": "keep", "R": "remove"}.get, lambda n: n if n in bodies or n == "R" else None)
    e.action = lambda n: {"K": "keep", "R": "remove"}.get(n, "expand")
    assert e.run("x {{A|1|2}} {{K|x=5|y}} {{R|z}} {{None}} {{#if: a |yes|no}} {{#ifeq:1.0|1|same|diff}} {{#switch:b|a=1|b|c=3|#default=4}} {{unclosed") == "x [1 b2] {(K+kept 5+5+y)}   yes same 3 {{unclosed"
    assert e.calls[:2] == [("A", True), ("B", False)] and e.run("{{L}}") == "{{L}}"


def test_corpus_and_training_texts(spark):
    good, bad = "the cat sat on the mat and saw the dog. ", "## 12 %% 99 || 47 ## "
    texts = [(f"c{i}", good * 5) for i in range(5)], [(f"d{i}", bad * 5) for i in range(5)]
    models = [language_model.train(language_model.line_symbols(spark.createDataFrame(t, "key string, text string"), "key"), 3, "witten_bell") for t in texts]
    p = spark.createDataFrame([("B", f"{good}\n\n== Junk ==\n{bad}\n== Lead ==\n=== Sub ===\nThe dog saw the cat."), ("A", bad), ("Z", good)], "title string, markup string")
    lines = [r.line for r in build_corpus(p, *models, 3, unwanted=spark.createDataFrame([("Z",)], "title string")).orderBy("line").collect()]
    assert lines[0] == "[1000010000000] |⌊δBδ⌋" and any("⌊=Lead¦2=⌋" in x for x in lines) and not any("Junk" in x for x in lines) and lines[-1].endswith("|The dog saw the cat.\n")
    stats = spark.createDataFrame([("Junk", 9000, 10)], "heading string, count long, avg_len long")
    assert [(r.title, r.dirty) for r in training_texts(p, stats).collect()] == [("B", True)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "dump.xml").write_text("<mediawiki><page><title>A</title><ns>0</ns><revision><text xml:space='preserve'>#REDIRECT [[B]]</text></revision></page><page><title>B</title><ns>0</ns><revision><text>body</text></revision></page></mediawiki>")
    assert sorted((r.title, r.redirect_target) for r in sources.read_dump(spark, str(tmp_path / "dump.xml")).collect()) == [("A", "B"), ("B", None)]
    (tmp_path / "one.txt").write_text("<article>T</article>\nline\nmore")
    assert tuple(sources.read_article_files(spark, str(tmp_path / "one.txt")).first()) == ("T", "line\nmore")
    (tmp_path / "rules.csv").write_text("template_action_comment\nx y_ Keep_c\n_remove\n/z/_remove\n")
    assert [tuple(r) for r in sources.read_rules(spark, str(tmp_path / "rules.csv")).orderBy("ord").collect()] == [(1, "x y", "keep"), (3, "/z/", "remove")]
    assert sources.read_config("a = b # c\n# d = e\nf=g") == {"a": "b", "f": "g"}
    rows = spark.createDataFrame([(101, 100, 0, "x"), (101, 100, 10, "y"), (102, 1100, 0, "z")], "seg long, art_id long, sent_id long, line string")
    articles.write_corpus(rows, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["x", "y", "z"]


def test_streamed_sections(spark, tmp_path):
    spark.createDataFrame([(1, "u", "<h1>T</h1><p>x</p>")], streaming.PAGES).write.parquet(str(tmp_path / "in"))
    q = streaming.write_sections(streaming.read_pages(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_trees_and_errors(spark):
    p = spark.createDataFrame([("A", "x [[y]]"), ("B", None)], "title string, markup string")
    assert pages.nodes_of(p).count() == 5 and pages.sections_of(p).count() == 1


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(i, "ab\nc é") for i in range(3)], "key int, text string")
    sinks.write_exploded(rows, str(tmp_path / "x"), records=2)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "x")).collect()) == ["a b"] * 3 + ["c   \\xe9"] * 3
    model = language_model.train(language_model.line_symbols(rows, "key"), 2, "witten_bell")
    sinks.write_model(model, str(tmp_path / "lm"))
    back = language_model.parse_arpa(spark.read.text(str(tmp_path / "lm")))
    assert back.count() == model.count()
    assert sinks.cached(spark, str(tmp_path / "c"), lambda: rows).count() == sinks.cached(spark, str(tmp_path / "c"), lambda: rows.limit(0)).count() == 3
    df, seen = sinks.progress(rows, "p")
    df.count()
    assert seen.get == {"rows": 3, "empty": 0}
