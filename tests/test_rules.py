"""Tables, nested lists, node rules as data and both renderings, worked out by hand."""

from __future__ import annotations

from quarry.functions import markup
from quarry.sources.pages import read_config, read_node_rules


def tree(wiki):
    return [(n["depth"], n["cls"]) + ((n["text"],) if n["text"] else ()) for n in markup.nodes("T", wiki)][1:]


def test_tables():
    wiki = '{| class="x"\n|+ Cap\n! h1 !! h2\n|-\n| a || style="s" | b\n| [[c|d]]\nmore\n|}\nafter'
    assert tree(wiki) == [
        (1, "Table"), (2, "Caption"), (3, "Paragraph"), (4, "Text", "Cap"),
        (2, "Row"), (3, "Cell"), (4, "Paragraph"), (5, "Text", "h1"), (3, "Cell"), (4, "Paragraph"), (5, "Text", "h2"),
        (2, "Row"), (3, "Cell"), (4, "Paragraph"), (5, "Text", "a"), (3, "Cell"), (4, "Paragraph"), (5, "Text", "b"), (3, "Cell"), (4, "Paragraph"), (5, "ArticleLink"), (6, "Text", "d"), (5, "Text", "\nmore"),
        (1, "Paragraph"), (2, "Text", "after"),
    ]
    nested = tree("{|\n| a\n{|\n| b\n|}\n|}")
    assert [x[:2] for x in nested if x[1] in ("Table", "Row", "Cell")] == [(1, "Table"), (2, "Row"), (3, "Cell"), (4, "Table"), (5, "Row"), (6, "Cell")]
    assert tree("{|\n| open") == [(1, "Table"), (2, "Row"), (3, "Cell"), (4, "Paragraph"), (5, "Text", "open")]
    assert markup.sections("T", wiki, "segment")[0]["content"].split() == ["after"]


def test_nested_lists():
    assert tree("* a\n** b\n** c\n* d") == [(1, "ItemList"), (2, "Item"), (3, "Text", "a"), (3, "ItemList"), (4, "Item"), (5, "Text", "b"), (4, "Item"), (5, "Text", "c"), (2, "Item"), (3, "Text", "d")]
    assert tree("; t\n: d") == [(1, "DefinitionTerm"), (2, "Text", "t"), (1, "DefinitionDescription"), (2, "Text", "d")]


def test_classifier_text_purges_without_a_trace():
    s = markup.sections("T", "a<ref>x</ref>b<br>c <b> d </b> <i> </i>[[File:x.png]]\n\n== ''H'' ==\ne")
    assert [x["heading"] for x in s] == ["<h1>T</h1>", "<h2><Italic>H</Italic></h2>"]
    assert s[0]["content"] == "<p>ab<br />\nc <b>d</b> <ImageLink /></p>"
    assert markup.sections("T", "a<ref>x</ref>b", "segment")[0]["content"] == "a b"


def test_rules_are_data(spark, tmp_path):
    path = tmp_path / "rules.tsv"
    path.write_text("name\taction\tstart\tend\tseperator\tparameters\n\t\tnotes\nSection\tkeep\t⌊=\t=⌋\t¦\tlevel\nBold\tkeep\nItalic\tkeep\t/\nMath\treplace\nSpan\tremove\nReference \tPurge \n\nbig\tkeep\t<B>\t</B>\n")
    rows = {r.name: tuple(r)[1:] for r in read_node_rules(spark, str(path)).collect()}
    assert rows == {
        "Section": ("keep", "⌊=", "=⌋", "¦", ["level"]), "Bold": ("keep", "<Bold>", "</Bold>", "", []), "Italic": ("keep", "/", "", "", []), "Math": ("replace", "<Math />", "", "", []),
        "Span": ("remove", "", "", "", []), "Reference": ("purge", "", "", "", []), "big": ("keep", "<B>", "</B>", "", []),
    }
    rules = markup.rules_of(read_node_rules(spark, str(path)).collect())
    s = markup.sections("T", "'''a''' ''b'' <math>c</math> <span>d</span><ref>e</ref> <u>f</u> <big>g</big>\n== H ==\nx", "mark", rules)
    assert s[0]["content"] == "<Bold>a</Bold> /b <Math /> d  f <B>g</B>" and s[1]["heading"] == "⌊=H¦2=⌋"


def test_paths_of_a_configuration():
    assert read_config("a = b # c\n# d = e\nf=/g\n", "/h/") == {"a": "/h/b", "f": "/g"} and read_config("a = b") == {"a": "b"}


def test_results_are_kept_by_content(spark, tmp_path):
    from quarry.sources import sinks

    rows = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "ord int, pattern string")
    assert sinks.content_key(rows) == sinks.content_key(rows.repartition(3)) != sinks.content_key(rows.where("ord > 0"))
    made = []
    for of in (rows, rows.repartition(2), rows.where("ord > 0")):
        assert sinks.cached(spark, str(tmp_path / "c"), lambda of=of: made.append(1) or of, of).count() == of.count()
    assert len(made) == 2
    sinks.write_rules(spark.createDataFrame([("b_c", "keep"), ("a", "remove")], "name string, action string"), str(tmp_path / "r"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "r")).collect()) == ["a_remove_", "b c_keep_"]


def test_references_of_all_kinds(spark):
    """Every name, numbers at the edges of Unicode, and what is no reference."""
    from html.entities import name2codepoint

    from pyspark.sql import functions as F

    from quarry.functions import text

    named = "".join(f"&{n};" for n in name2codepoint)
    edges = "&#65;&#x41;&#X00041;&#0;&#x10FFFF;&#x110000;&#xD800;&#xDFFF;&#xE000;&#99999999999999999999;&#xffffffffffff;&;&#;&#x;&amp;lt;&Amp;&bogus1;&lt"
    rows = spark.createDataFrame([(named,), (edges,), ("",), (None,), ("no & or ;",)], "t string")
    found = [r[0] for r in rows.coalesce(1).select(text.entity_decoder()(F.col("t"))).collect()]
    assert found == ["".join(map(chr, name2codepoint.values())), "AAA&#0;\U0010ffff&#x110000;&#xD800;&#xDFFF;&#99999999999999999999;&#xffffffffffff;&;&#;&#x;&lt;&Amp;&bogus1;&lt", "", None, "no & or ;"]
    assert [r[0] for r in rows.coalesce(1).select(text.entity_decoder("replace", "_", latin1=True)(F.col("t"))).collect()][1] == "AAA________&;&#;&#x;&lt;__&lt"


def test_pages_of_any_depth(spark):
    """Nodes within nodes and signs that nothing closes: no error rows, and in little time."""
    import random
    import time

    from quarry.functions import markup
    from quarry.operators import markup as pages

    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = spark.createDataFrame([("d", deep), ("l", "[[" * 20_000 + "x"), ("q", "'''''" * 20_000)], "title string, markup string")
    began = time.time()
    found = pages.sections_of(rows, mode="segment").collect()
    assert {r.title: r.content for r in found}["d"] == "x" and all(r.error is None for r in found) and pages.nodes_of(rows.where("title = 'd'")).count() == 3002
    assert time.time() - began < 40
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(["[[", "]]", "[", "]", "a"]) for _ in range(rng.randrange(12)))
        closings = markup._closings(text)
        assert all(end == markup._closing(text, at) for at, end in closings.items())
