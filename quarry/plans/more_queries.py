"""More queries of the corpus engine's operators, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quarry.functions import charsets
from quarry.functions import text as tx
from quarry.operators import articles, sections, templates
from quarry.operators import language_model as lm
from quarry.operators.common import shared_folder, short_batches
from quarry.plans.language_queries import ORDER, labelled, with_model
from quarry.plans.language_queries import SQL as LANGUAGE_SQL
from quarry.sources import page_store
from quarry.sources import pages as sources
from quarry.sources.tables import table

SPACES = {"en": 0, "de": 1, "fr": 2}


def _pages(spark, sf_dir):
    """(title, ns, raw): documents as pages; a short one points to the document of a third of its number."""
    docs = table(spark, sf_dir, "documents")
    ns = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).otherwise(2)
    target = F.concat(F.lit("#REDIRECT [["), F.expr("doc_id div 3"), F.lit("]]"))
    return docs.select(F.col("doc_id").cast("string").alias("title"), ns.alias("ns"), F.when(F.col("n_chars") < 300, target).otherwise(F.col("text")).alias("raw"))


def list_articles(spark, sf_dir):
    return articles.list_articles(_pages(spark, sf_dir))


def markup_look_up(spark, sf_dir):
    """All pages in a store, and the first one of each source and language looked up in it, besides names that it doesn't have."""
    pages = _pages(spark, sf_dir)
    path = f"{shared_folder(pages)}/pages-{uuid.uuid4().hex}"
    page_store.write_page_store(pages, path)
    first = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.min("doc_id").cast("string").alias("title"))
    names = first.select("title").unionByName(first.select(F.concat("title", F.lit("?")).alias("title")))
    return page_store.look_up(page_store.read_page_store(spark, path), names).select("title", "ns", F.md5("raw").alias("digest"))


def redirect_targets(spark, sf_dir):
    return _pages(spark, sf_dir).select("title", articles.redirect_target(F.col("raw")).alias("target")).where("target is not null")


def follow_redirects(spark, sf_dir):
    return articles.follow_redirect(_pages(spark, sf_dir)).select("title", F.md5("raw").alias("digest"))


def article_list(spark, sf_dir):
    """The labelled names with their articles, also those that are no documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return articles.only(docs, table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.col("n_chars").cast("long").alias("n_chars"))


def names_split(spark, sf_dir):
    """Names whose prefix is a known namespace or isn't."""
    name = F.concat(F.col("lang"), F.lit(": "), F.col("source"), F.lit(":"), F.col("doc_id"))
    return table(spark, sf_dir, "documents").select("doc_id", articles.split_name(name, SPACES).alias("x")).select("doc_id", F.col("x.ns").cast("long").alias("ns"), F.col("x.local").alias("local"))


def empty_articles(spark, sf_dir):
    """Per source: documents, and those without text."""
    rows = table(spark, sf_dir, "documents").groupBy("source")
    return rows.agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.trim("text"), F.lit("")) == "").alias("empty"))


def character_totals(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("clean"), (F.col("quality") == 0).alias("dirty"))
    rows = sections.line_sections(table(spark, sf_dir, "documents")).join(labels, "doc_id")
    return sections.character_totals(rows)


def title_mark_check(spark, sf_dir):
    """Whether texts hold the first word of the benchmark's items, as articles hold the mark of their title."""
    return articles.without_title_mark(table(spark, sf_dir, "documents"), mark="the")


def _heading_lines(spark, sf_dir):
    html = F.replace(F.replace("html", F.lit("<h1>"), F.lit("\n<h1>")), F.lit("</h1>"), F.lit("</h1>\n"))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(F.split(html, "\n")).alias("line_no", "line"))


def file_kinds(spark, sf_dir):
    return _heading_lines(spark, sf_dir).groupBy("page_id").agg(sections.is_exploded(_heading_lines(spark, sf_dir)).alias("exploded"))


def file_sections(spark, sf_dir):
    out = sections.file_sections(_heading_lines(spark, sf_dir), "page_id")
    return out.select("page_id", "island", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


def paragraph_breaks(spark, sf_dir):
    runs = F.regexp_extract_all("text", F.lit(r"[ \t\n\r]+"), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.filter(runs, tx.is_paragraph_break)).cast("long").alias("breaks"))


def elapsed_times(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", tx.hms(F.col("n_chars")).alias("time"))


def charset_variants(spark, sf_dir):
    """Every text in each charset of the tokenizer's variants and back: its bytes, and whether all of it comes back."""
    short_batches(spark)
    return charsets.there_and_back(table(spark, sf_dir, "documents"), sorted({c for _, c in charsets.VARIANTS.values()}), "doc_id")


def exploded_documents(spark, sf_dir):
    """All documents exploded and put together again."""
    out = table(spark, sf_dir, "documents").select("doc_id", "text", tx.exploded(F.col("text")).alias("e"))
    return out.select("doc_id", F.md5("e").alias("digest"), (tx.unexploded(F.col("e")) == F.col("text")).alias("same"))


def base25_codes(spark, sf_dir):
    """The codes of the documents' numbers, by way of masks."""
    marks = tx.masked(F.repeat(F.lit("#"), (F.col("doc_id") % 1000 + 1).cast("int")), "#")
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_extract(marks, "zzzz([a-y]+)zzzz$", 1).alias("code"))


def template_summary(spark, sf_dir):
    calls = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return templates.usage_summary(calls.select(F.col("l_orderkey").alias("article"), F.col("p_name").alias("name"), (F.col("l_linenumber") <= 2).alias("direct")))


def template_substrings_skip(spark, sf_dir):
    """The index without the ten most used names."""
    counts = table(spark, sf_dir, "part").groupBy(F.concat_ws(" ", "p_type", "p_name").alias("name")).agg(F.sum(F.col("p_size").cast("long")).alias("direct"))
    out = templates.substring_cover(counts, skip=10)
    return out.select("weight", "part", F.array_join("names", ", ").alias("names"))


def scanner_tokens(spark, sf_dir):
    """Parts as calls with an argument and a link: their tokens by kind and text length."""
    text = F.concat(F.lit("{{"), F.substring_index("p_name", " ", -1), F.lit("|{{{"), "p_brand", F.lit("}}}}} [["), "p_type", F.lit("]]"))
    out = templates.scanner_tokens(table(spark, sf_dir, "part").select("p_partkey", text.alias("markup")), "p_partkey")
    return out.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def raw_tags_removed(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(templates.without_raw_tags(F.col("html"))).alias("digest"))


def _clean_model(spark, sf_dir):
    return lm.train(lm.line_symbols(labelled(spark, sf_dir).where("clean"), "key"), ORDER, "witten_bell")


def lm_sizes(spark, sf_dir):
    model = _clean_model(spark, sf_dir)
    return lm.vocabulary_size(model).select(F.col("size").alias("vocabulary")).crossJoin(lm.highest_order(model).select(F.col("size").alias("max_order"))).crossJoin(model.groupBy().agg(F.count("*").alias("ngrams")))


def lm_arpa(spark, sf_dir):
    """The model as ARPA text, read again."""
    lines = lm.arpa_lines(_clean_model(spark, sf_dir)).select(F.col("line").alias("value"))
    return lm.parse_arpa(lines).select("ord", "ngram", F.round("logp", 6).alias("logp"), F.round("bow", 6).alias("bow"))


def tune_lm(spark, sf_dir):
    texts = labelled(spark, sf_dir)
    models = [lm.train(lm.line_symbols(texts.where(F.col("clean") == c), "key"), ORDER, "witten_bell") for c in (True, False)]
    out = lm.tuning_perplexity(texts.where("clean"), texts.where("not clean"), {"documents_3gram_wb": (*models, ORDER)})
    return out.select("classifier", *(F.round(c, 4).alias(c) for c in ("ppl_clean", "ppl_dirty", "avg")))


def _rule_scores(spark, sf_dir):
    """(classifier, key, label_clean, score) by length, by lines and by the share of letters."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    letters = F.length(F.regexp_replace("text", "[^a-z]", "")) * 10 - F.length("text") * 7
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) - 3
    scores = F.array(*(F.struct(F.lit(n).alias("classifier"), s.cast("double").alias("score")) for n, s in (("length", F.col("n_chars") - 1000), ("lines", lines), ("letters", letters))))
    return docs.select(F.col("doc_id").alias("key"), (F.col("quality") == 1).alias("label_clean"), F.explode(scores).alias("x")).select("key", "label_clean", "x.classifier", "x.score")


def tune_classifiers(spark, sf_dir):
    return lm.tuning_accuracy(_rule_scores(spark, sf_dir))


def sign_test_by_text(spark, sf_dir):
    out = lm.sign_test_of(_rule_scores(spark, sf_dir), "letters")
    return out.select("classifier", "differing", "wins", F.round("p", 6).alias("p"), "mark")


def sign_test_by_position(spark, sf_dir):
    """Outcomes by letters and by length, written line by line in the order of documents, and compared line by line."""
    scores = _rule_scores(spark, sf_dir)
    right = F.when(F.col("label_clean"), F.col("score") > 0).otherwise(F.col("score") < 0)
    lists = []
    for name in ("letters", "length"):
        rows = scores.where(F.col("classifier") == name).select("key", F.when(right, "1").otherwise("0").alias("value"))
        path = f"{shared_folder(rows)}/outcomes-{uuid.uuid4().hex}"
        rows.repartitionByRange("key").sortWithinPartitions("key").select("value").write.text(path)
        lists.append(sources.read_lines(spark, path).select("place", (F.col("value") == "1").alias("right")))
    out = lm.sign_test_by_position(*lists)
    return out.select("differing", "wins", F.round("p", 6).alias("p"), "mark")


def classifier_names(spark, sf_dir):
    """Paths of models, made of the parts' types, and what their names tell."""
    part = table(spark, sf_dir, "part").select(F.regexp_replace("p_type", "[^A-Za-z]+", "-").alias("t"), (F.col("p_size") % 5 + 1).alias("n")).distinct()
    paths = part.select(F.explode(F.array(*(F.format_string(f"lms/{k}_%s_%dgram_wb.lm{z}", "t", "n") for k, z in (("clean", ""), ("dirty", ".gz"), ("other", ""))))).alias("path"))
    return lm.classifiers(paths).select("label", "kind", F.col("order").cast("long").alias("order"), "path")


QUERIES = {f.__name__: f for f in (
    list_articles, markup_look_up, redirect_targets, follow_redirects, article_list, names_split, empty_articles, character_totals, title_mark_check, file_kinds, file_sections, paragraph_breaks,
    elapsed_times, charset_variants, exploded_documents, base25_codes, template_summary, template_substrings_skip, scanner_tokens, raw_tags_removed, lm_sizes, lm_arpa, tune_lm, tune_classifiers,
    sign_test_by_text, sign_test_by_position, classifier_names,
)}

_PAGES = """p AS (
  SELECT doc_id::VARCHAR AS title, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS ns, CASE WHEN n_chars < 300 THEN '#REDIRECT [[' || doc_id // 3 || ']]' ELSE text END AS raw,
    CASE WHEN n_chars < 300 THEN (doc_id // 3)::VARCHAR END AS target FROM documents
)"""

_HEADING_LINES = """l AS (
  SELECT page_id, i - 1 AS line_no, parts[i] AS line
  FROM (SELECT page_id, string_split(replace(replace(html, '<h1>', chr(10) || '<h1>'), '</h1>', '</h1>' || chr(10)), chr(10)) AS parts, unnest(range(1, len(parts) + 1)) AS i FROM pages)
)"""

_SYMBOL = r"""CASE WHEN unicode(c) < 128 THEN c WHEN unicode(c) < 256 THEN '\x' || lpad(lower(to_hex(unicode(c))), 2, '0')
  WHEN unicode(c) < 65536 THEN '\u' || lpad(lower(to_hex(unicode(c))), 4, '0') ELSE '\U' || lpad(lower(to_hex(unicode(c))), 8, '0') END"""
_EXPLODED = "array_to_string(list_transform(list_filter(string_split({0}, ''), lambda c: c <> ''), lambda c: " + _SYMBOL + "), ' ')"

_RAW = "regexp_replace(html, '(?s)<!--.*?-->', chr(10), 'g')"
for _tag in ("nowiki", "math", "gallery", "source", "pre", "timeline", "poem", "ref"):
    _RAW = f"regexp_replace({_RAW}, '(?is)<{_tag}>.*?</{_tag}>', chr(10), 'g')"

_RULES = """r AS (
  SELECT doc_id, quality = 1 AS clean, n_chars - 1000 AS by_length, length(text) - length(replace(text, chr(10), '')) - 3 AS by_lines,
    length(regexp_replace(text, '[^a-z]', '', 'g')) * 10 - length(text) * 7 AS by_letters
  FROM documents JOIN labels USING (doc_id)
), s AS (
  SELECT doc_id, clean, unnest(['length', 'lines', 'letters']) AS classifier, unnest([by_length, by_lines, by_letters]) AS score FROM r
), o AS (SELECT *, coalesce(CASE WHEN clean THEN score > 0 ELSE score < 0 END, false) AS ok FROM s)"""

SQL = {
    "list_articles": f"WITH {_PAGES} SELECT title FROM p WHERE ns = 0 AND target IS NULL",
    "markup_look_up": f"WITH {_PAGES} SELECT title, ns, md5(raw) AS digest FROM p WHERE title IN (SELECT min(doc_id)::VARCHAR FROM documents GROUP BY source, lang)",
    "redirect_targets": f"WITH {_PAGES} SELECT title, target FROM p WHERE target IS NOT NULL",
    "follow_redirects": f"WITH {_PAGES} SELECT p.title, md5(CASE WHEN p.target IS NULL THEN p.raw ELSE q.raw END) AS digest FROM p LEFT JOIN p q ON p.target = q.title",
    "article_list": "SELECT l.doc_id, n_chars::BIGINT AS n_chars FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id",
    "names_split": "SELECT doc_id, CASE lang WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 0 END::BIGINT AS ns, CASE WHEN lang IN ('en', 'de', 'fr') THEN '' ELSE lang || ': ' END || source || ':' || doc_id AS \"local\" FROM documents",
    "empty_articles": "SELECT source, count(*) AS \"rows\", (count(*) FILTER (WHERE trim(coalesce(text, '')) = ''))::BIGINT AS \"empty\" FROM documents GROUP BY source",
    "character_totals": """
SELECT coalesce(sum(n) FILTER (WHERE quality = 1), 0)::BIGINT AS clean, coalesce(sum(n) FILTER (WHERE quality = 0), 0)::BIGINT AS dirty
FROM (SELECT doc_id, length(unnest(string_split(text, chr(10)))) AS n FROM documents) JOIN labels USING (doc_id)""",
    "title_mark_check": "SELECT (count(*) FILTER (WHERE length(text) > 0))::BIGINT AS articles, (count(*) FILTER (WHERE length(text) > 0 AND NOT contains(text, 'the')))::BIGINT AS missing FROM documents",
    "file_kinds": f"""WITH {_HEADING_LINES}
SELECT page_id, arg_min(kind, line_no) FILTER (WHERE kind IS NOT NULL) AS exploded
FROM (SELECT *, CASE WHEN regexp_matches(line, '^<h[1-6]>.*</h[1-6]>$') THEN false WHEN regexp_matches(line, '^< h [1-6] >.*< / h [1-6] >$') THEN true END AS kind FROM l) GROUP BY page_id""",
    "file_sections": f"""WITH {_HEADING_LINES}, k AS (
  SELECT *, (sum(regexp_matches(line, '^<h[1-6]>.*</h[1-6]>$')::INT) OVER (PARTITION BY page_id ORDER BY line_no))::BIGINT AS island FROM l
), t AS (SELECT page_id, island, string_agg({_EXPLODED.format('line')}, chr(10) ORDER BY line_no) AS text FROM k GROUP BY ALL)
SELECT page_id, island, length(text) AS n_chars, md5(text) AS digest FROM t""",
    "paragraph_breaks": r"SELECT doc_id, len(list_filter(regexp_extract_all(text, '[ \t\n\r]+'), lambda s: length(s) - length(replace(s, chr(10), '')) >= 2))::BIGINT AS breaks FROM documents",
    "elapsed_times": "SELECT doc_id, (n_chars // 3600) || ':' || lpad((n_chars // 60 % 60)::VARCHAR, 2, '0') || ':' || lpad((n_chars % 60)::VARCHAR, 2, '0') AS time FROM documents",
    # What the charsets have beyond ASCII.
    "charset_variants": r"""
WITH c AS (
  SELECT unnest(['cp1251', 'cp1252', 'iso8859-1', 'iso8859-5', 'utf-8']) AS charset, unnest([
    '[^\x00-\x7f\x98\x{a0}\x{a4}\x{a6}\x{a7}\x{a9}\x{ab}-\x{ae}\x{b0}\x{b1}\x{b5}-\x{b7}\x{bb}\x{401}-\x{40c}\x{40e}-\x{44f}\x{451}-\x{45c}\x{45e}\x{45f}\x{490}\x{491}\x{2013}\x{2014}\x{2018}-\x{201a}\x{201c}-\x{201e}\x{2020}-\x{2022}\x{2026}\x{2030}\x{2039}\x{203a}\x{20ac}\x{2116}\x{2122}]',
    '[^\x00-\x7f\x{81}\x{8d}\x{8f}\x{90}\x{9d}\x{a0}-\x{ff}\x{152}\x{153}\x{160}\x{161}\x{178}\x{17d}\x{17e}\x{192}\x{2c6}\x{2dc}\x{2013}\x{2014}\x{2018}-\x{201a}\x{201c}-\x{201e}\x{2020}-\x{2022}\x{2026}\x{2030}\x{2039}\x{203a}\x{20ac}\x{2122}]',
    '[^\x00-\x{ff}]', '[^\x00-\x{a0}\x{ad}\x{a7}\x{401}-\x{40c}\x{40e}-\x{44f}\x{451}-\x{45c}\x{45e}\x{45f}\x{2116}]', '[^\x00-\x{10ffff}]']) AS lacking
)
SELECT doc_id, charset, (CASE WHEN charset = 'utf-8' THEN strlen(text) ELSE length(text) END)::BIGINT AS n_bytes, NOT regexp_matches(text, lacking) AS same
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) CROSS JOIN c""",
    "exploded_documents": f"SELECT doc_id, md5({_EXPLODED.format('text')}) AS digest, true AS same FROM documents",
    "base25_codes": """
SELECT doc_id, CASE WHEN k >= 625 THEN chr((97 + k // 625)::INT) ELSE '' END || CASE WHEN k >= 25 THEN chr((97 + k // 25 % 25)::INT) ELSE '' END || chr((97 + k % 25)::INT) AS code
FROM (SELECT doc_id, doc_id % 1000 AS k FROM documents)""",
    "template_summary": "SELECT count(DISTINCT p_name) AS templates, count(*) AS calls, (count(*) FILTER (WHERE l_linenumber <= 2))::BIGINT AS direct, count(DISTINCT l_orderkey) AS articles FROM lineitem JOIN part ON l_partkey = p_partkey",
    "template_substrings_skip": """
WITH counts AS (
  SELECT name, direct FROM (SELECT *, row_number() OVER (ORDER BY direct DESC, name) AS r FROM (SELECT p_type || ' ' || p_name AS name, sum(p_size)::BIGINT AS direct FROM part GROUP BY 1)) WHERE r > 10
), parts AS (
  SELECT DISTINCT name, direct, part FROM (SELECT name, direct, unnest(regexp_split_to_array('^' || lower(name) || '$', '[^a-zA-Z0-9_^$]+')) AS part FROM counts) WHERE length(part) >= 4
), weights AS (SELECT part, sum(direct) AS weight FROM parts GROUP BY part HAVING count(*) > 1), claimed AS (
  SELECT name, direct, part, row_number() OVER (PARTITION BY name ORDER BY weight DESC, part) AS r FROM parts JOIN weights USING (part)
)
SELECT sum(direct)::BIGINT AS weight, part, string_agg(name, ', ' ORDER BY name) AS names FROM claimed WHERE r = 1 GROUP BY part HAVING count(*) > 1""",
    "scanner_tokens": """
WITH t AS (
  SELECT unnest(['call', 'text', 'bar', 'argument', 'text', 'argument', 'call', 'text', 'link', 'text', 'link']) AS kind,
    unnest(['{{', string_split(p_name, ' ')[-1], '|', '{{{', p_brand, '}}}', '}}', ' ', '[[', p_type, ']]']) AS text FROM part
)
SELECT kind, count(*) AS n, sum(length(text))::BIGINT AS chars FROM t GROUP BY kind""",
    "raw_tags_removed": f"SELECT page_id, md5({_RAW}) AS digest FROM pages",
    "lm_sizes": f"{with_model('witten_bell')} SELECT (count(*) FILTER (WHERE ord = 1 AND ngram NOT IN ('<s>', '</s>', '<unk>')))::BIGINT AS vocabulary, max(ord)::BIGINT AS max_order, count(*) AS ngrams FROM m",
    "lm_arpa": f"{with_model('witten_bell')} SELECT ord, ngram, round(coalesce(logp, -99), 6) AS logp, round(bow, 6) AS bow FROM m",
    "tune_lm": f"""WITH q AS ({LANGUAGE_SQL['lm_perplexity']}), r AS (
  SELECT 'documents_3gram_wb' AS classifier, max(ppl) FILTER (WHERE test_set = 'clean' AND model = 'clean') AS a, max(ppl) FILTER (WHERE test_set = 'dirty' AND model = 'dirty') AS b FROM q
)
SELECT classifier, round(a, 4) AS ppl_clean, round(b, 4) AS ppl_dirty, round((a + b) / 2, 4) AS avg FROM r""",
    "tune_classifiers": f"""WITH {_RULES}
SELECT classifier, (count(*) FILTER (WHERE clean))::BIGINT AS clean, (count(*) FILTER (WHERE clean AND ok))::BIGINT AS acc_clean, (count(*) FILTER (WHERE NOT clean))::BIGINT AS dirty, (count(*) FILTER (WHERE NOT clean AND ok))::BIGINT AS acc_dirty
FROM o GROUP BY classifier""",
    "sign_test_by_text": f"""WITH {_RULES}, c AS (
  SELECT o.classifier, count(*) FILTER (WHERE o.ok <> t.ok) AS m, count(*) FILTER (WHERE t.ok AND NOT o.ok) AS w FROM o JOIN o t ON o.doc_id = t.doc_id AND t.classifier = 'letters' WHERE o.classifier <> 'letters' GROUP BY 1
), p AS (
  SELECT classifier, m, w, CASE WHEN w = 0 THEN 1.0 ELSE list_sum(list_transform(range(w, m + 1), lambda k: exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) - m * ln(2)))) END AS p FROM c
)
SELECT classifier, m AS differing, w AS wins, round(p, 6) AS p, CASE WHEN p <= 0.005 THEN '**' WHEN p <= 0.05 THEN '*' ELSE '' END AS mark FROM p""",
    "sign_test_by_position": f"""WITH {_RULES}, c AS (
  SELECT o.classifier, count(*) FILTER (WHERE o.ok <> t.ok) AS m, count(*) FILTER (WHERE t.ok AND NOT o.ok) AS w FROM o JOIN o t ON o.doc_id = t.doc_id AND t.classifier = 'letters' WHERE o.classifier = 'length' GROUP BY 1
), p AS (
  SELECT classifier, m, w, CASE WHEN w = 0 THEN 1.0 ELSE list_sum(list_transform(range(w, m + 1), lambda k: exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) - m * ln(2)))) END AS p FROM c
)
SELECT m AS differing, w AS wins, round(p, 6) AS p, CASE WHEN p <= 0.005 THEN '**' WHEN p <= 0.05 THEN '*' ELSE '' END AS mark FROM p""",
    "classifier_names": """
WITH t AS (SELECT DISTINCT regexp_replace(p_type, '[^A-Za-z]+', '-', 'g') AS t, p_size % 5 + 1 AS n FROM part), k AS (SELECT t, n, unnest(['clean', 'dirty']) AS kind, unnest(['', '.gz']) AS z FROM t)
SELECT t || '_' || n || 'gram_wb' AS label, kind, n::BIGINT AS "order", 'lms/' || kind || '_' || t || '_' || n || 'gram_wb.lm' || z AS path FROM k""",
}
