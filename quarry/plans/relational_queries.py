"""Queries of listing, sections, templates and text functions, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import text as tx
from quarry.operators import articles, sections, templates
from quarry.operators.common import numbered
from quarry.sources.tables import table

NAMESPACES = [*(f"src{i}" for i in range(0, 20)), "talk", "user"]
#: In order; the first that meets a name wins.
TEMPLATE_RULES = [("small ring", "keep"), ("/^RED/", "remove"), ("/bolt$/", "keep"), ("/(ring|gear)$/", "remove"), ("small gear", "keep"), ("/^hot/", "expand"), ("/small/", "keep")]


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def list_articles_sorted(spark, sf_dir):
    docs = _docs(spark, sf_dir).select(F.concat_ws("/", "source", "doc_id").alias("title"), "text")
    return articles.article_ids(docs).select("title", "art_id", "seg")


def article_blacklist(spark, sf_dir):
    unwanted = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    return articles.without(_docs(spark, sf_dir).select("doc_id", "lang"), unwanted, "doc_id")


def namespace_counts(spark, sf_dir):
    pages = _docs(spark, sf_dir).select(F.col("source").alias("ns"), (F.col("lang") == "de").alias("is_redirect"))
    return articles.namespace_counts(pages, spark.createDataFrame([(n,) for n in NAMESPACES], "ns string"))


def redirect_closure(spark, sf_dir):
    """Documents of under 1,000 characters point to the one of a third of their number; a longer one ends the chain."""
    docs = _docs(spark, sf_dir).where("n_chars < 1000")
    return articles.resolve_redirects(docs.select(F.col("doc_id").alias("src"), F.expr("doc_id div 3").alias("dst")))


def template_rule_index(spark, sf_dir):
    """As many rules as parts: first letters of the name behind its start, its last word and size at the end, or either of two words; they are tried on brand, type and name of all parts."""
    part = table(spark, sf_dir, "part")
    first, last = F.substring_index("p_name", " ", 1), F.substring_index("p_name", " ", -1)
    size = F.col("p_size").cast("string")
    pattern = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("/^"), F.upper(first), F.lit(".*"), last, F.lit(" "), size, F.lit("$/")))
    pattern = pattern.when(F.col("p_size") % 4 == 1, F.concat(F.lit("/("), "p_type", F.lit("|no"), last, F.lit(") [a-z]+ "), size, F.lit("?$/")))
    pattern = pattern.when(F.col("p_size") % 4 == 2, F.concat(F.lit("/"), last, F.lit(" ?"), size, F.lit("+$/"))).otherwise(F.concat(first, F.lit(" "), size))
    rules = part.select(F.col("p_partkey").alias("ord"), pattern.alias("pattern"), F.col("p_brand").alias("action"))
    names = part.select(F.concat_ws(" ", "p_type", "p_name", size).alias("name")).union(part.select(F.concat_ws(" ", "p_name", size))).distinct()
    return templates.resolve_rules(rules, names).join(names, "name", "left_semi")


def redirect_circles(spark, sf_dir):
    """Documents without a label point to the one whose number is their length, counted round; those with a label end a chain. Some run in circles."""
    docs = _docs(spark, sf_dir)
    hops = docs.join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_anti")
    return articles.resolve_redirects(hops.select(F.col("doc_id").alias("src"), (F.col("n_chars") % F.lit(docs.count())).alias("dst")))


def section_setdiff(spark, sf_dir):
    """All lines less those of toxic documents, a copy for each."""
    lines = sections.line_sections(_docs(spark, sf_dir))
    rows = lines.select("doc_id", "sec_idx", F.struct("doc_id", "sec_idx").alias("place"), "content")
    unwanted = lines.join(table(spark, sf_dir, "labels").where("toxic = 1"), "doc_id", "left_semi").select("content")
    return articles.multiset_difference(rows, unwanted, "content", "place").select("doc_id", F.col("sec_idx").cast("long").alias("sec_idx"), "content")


def heading_stats(spark, sf_dir):
    return sections.heading_stats(sections.line_sections(_docs(spark, sf_dir)))


def heading_retention(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("_good"))
    rows = sections.line_sections(_docs(spark, sf_dir)).join(labels, "doc_id", "left")
    clean = F.coalesce("_good", F.lit(False)) & (F.length("content") % 3 == 0)
    return sections.retain_headings(rows.withColumn("clean", clean), "doc_id").select("doc_id", F.col("sec_idx").cast("long").alias("sec_idx"), "sprint")


def _titled(spark, sf_dir):
    """Line sections with titles that end articles now and then."""
    kind = F.length("content") % 23
    title = F.when(kind == 3, "See also").when(kind == 7, F.concat(F.lit("Notes "), "title")).when(kind == 11, "References").when(kind == 13, F.lit("External links")).when(kind == 17, "Sources").otherwise(F.col("title"))
    return sections.line_sections(_docs(spark, sf_dir)).withColumn("title", title)


def purge_cut(spark, sf_dir):
    return sections.cut_closing(_titled(spark, sf_dir), "doc_id").select("doc_id", F.col("sec_idx").cast("long").alias("sec_idx"), "kept")


def training_labels(spark, sf_dir):
    """Labels by the operator's own limits."""
    rows = sections.line_sections(_docs(spark, sf_dir)).withColumn("n_par", F.length("content") % 7)
    out = sections.training_labels(rows, sections.heading_stats(rows))
    return out.select("doc_id", F.col("sec_idx").cast("long").alias("sec_idx"), "clean", "dirty")


def training_labels_by_share(spark, sf_dir):
    """Labels by limits that follow from the headings: the commonest hundredth, and the shorter half of these."""
    rows = sections.line_sections(_docs(spark, sf_dir)).withColumn("n_par", F.length("content") % 7)
    stats = sections.heading_stats(rows)
    out = sections.training_labels(rows, stats, **sections.limits_of(stats))
    return out.select("doc_id", F.col("sec_idx").cast("long").alias("sec_idx"), "clean", "dirty")


def exploded_islands(spark, sf_dir):
    """Lines that end in a point and a three-letter word stand for headings."""
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    out = sections.islands(lines, "doc_id", r"[^.]{3}\.$")
    return out.select("doc_id", "island", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("digest"))


def template_rule_resolution(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()
    rules = spark.createDataFrame([(i, p, a) for i, (p, a) in enumerate(TEMPLATE_RULES)], "ord int, pattern string, action string")
    known = names.select("name", F.col("name").alias("canonical"), F.when(F.col("name").startswith("old"), 0).otherwise(10).alias("ns"))
    return templates.action_of(known, templates.resolve_rules(rules, names)).select("name", "action")


def _template_counts(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy(F.concat_ws(" ", "p_type", "p_name").alias("name")).agg(F.sum(F.col("p_size").cast("long")).alias("direct"))


def template_substrings(spark, sf_dir):
    out = templates.substring_cover(_template_counts(spark, sf_dir))
    return out.select("weight", "part", F.array_join("names", ", ").alias("names"))


def template_usage(spark, sf_dir):
    calls = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return templates.usage_counts(calls.select(F.col("l_orderkey").alias("article"), F.col("p_name").alias("name"), (F.col("l_linenumber") <= 2).alias("direct")))


def entity_decode(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.decode_entities(F.col("html")).alias("html"))


def html_heading_rewrite(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(tx.html_headings_to_wiki(F.col("html"))).alias("digest"))


def mask_roundtrip(spark, sf_dir):
    """Addresses hidden and brought back."""
    pattern = r"[A-Za-z0-9._]+@[A-Za-z0-9.]+"
    out = _docs(spark, sf_dir).select("doc_id", "text", tx.masked(F.col("text"), pattern).alias("hidden"), tx.masked_items(F.col("text"), pattern).alias("items"))
    return out.select("doc_id", F.md5("hidden").alias("hidden_md5"), F.size("items").cast("long").alias("n_items"), (tx.unmasked(F.col("hidden"), F.col("items")) == F.col("text")).alias("same"))


def sentence_split_simple(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", F.posexplode(tx.simple_sentences(F.col("text"))).alias("pos", "sentence")).select("doc_id", F.col("pos").cast("long").alias("pos"), "sentence")


def corpus_lines(spark, sf_dir):
    """The kept sections of each document as numbered sentences."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("clean"))
    rows = sections.line_sections(_docs(spark, sf_dir)).join(labels, "doc_id", "left").withColumn("clean", F.coalesce("clean", F.lit(False)))
    kept = sections.retain_headings(rows, "doc_id").where("sprint")
    kept = kept.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sec_idx", "content"))), lambda s: s["content"]), "\n").alias("text"))
    named = kept.select(F.format_string("%010d", "doc_id").alias("title"), "text")
    sentences = F.flatten(F.transform(tx.lines(F.col("text")), tx.simple_sentences))
    return articles.corpus_lines(articles.article_ids(named), sentences)


def balanced_chunks(spark, sf_dir):
    """Seven near-equal parts of each source's documents, in order."""
    docs = numbered(_docs(spark, sf_dir).select("source", "doc_id", F.struct("source", "doc_id").alias("_by")), "_by", "_k")
    sizes = docs.groupBy(F.col("source").alias("_s")).agg(F.min("_k").alias("_first"), F.expr("count(*) div 7").alias("_q"), F.expr("count(*) % 7").alias("_r"))
    placed = docs.join(sizes, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_k", F.col("_k") - F.col("_first"))
    # The first _r parts have one more document than the others.
    part = F.expr("CASE WHEN _k < _r * (_q + 1) THEN _k div (_q + 1) ELSE _r + (_k - _r * (_q + 1)) div _q END")
    return placed.select("source", "doc_id", part.cast("long").alias("part"))


QUERIES = {f.__name__: f for f in (
    list_articles_sorted, article_blacklist, namespace_counts, redirect_closure, redirect_circles, template_rule_index, section_setdiff, heading_stats, heading_retention, purge_cut,
    training_labels, training_labels_by_share, exploded_islands, template_rule_resolution, template_substrings, template_usage, entity_decode, html_heading_rewrite,
    mask_roundtrip, sentence_split_simple, corpus_lines, balanced_chunks,
)}

_SECTIONS = """s AS (
  SELECT doc_id, i - 1 AS sec_idx, parts[i] AS content, CASE WHEN i = 1 THEN 1 ELSE 2 + length(parts[i]) % 4 END AS level, string_split(parts[i], ' ')[1] AS title
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
)"""

_RETAINED = """g AS (
  SELECT *, sum(c::INT) OVER (PARTITION BY doc_id ORDER BY sec_idx DESC) AS g FROM c
), r AS (
  SELECT *, min(level) OVER (PARTITION BY doc_id, g ORDER BY sec_idx DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS threshold FROM g
), kept AS (
  SELECT doc_id, sec_idx, content, c OR coalesce(g > 0 AND (sec_idx = 0 OR level < threshold), false) AS sprint FROM r
)"""

_SENTENCES = r"""string_split(regexp_replace({0}, '([.!?]+)(["'')\]}}>]*)\s+([A-Z0-9])', '\1\2' || chr(1) || '\3', 'g'), chr(1))"""

_HEADINGS = "html"
for _n in range(1, 7):
    _HEADINGS = f"regexp_replace({_HEADINGS}, '(?is)<h{_n}>(.*?)</h{_n}>', '{'=' * _n} \\1 {'=' * _n}', 'g')"

SQL = {
    "list_articles_sorted": """
SELECT title, 99 + n AS art_id, 101 + (n - 1) // 1000 AS seg
FROM (SELECT source || '/' || doc_id AS title, row_number() OVER (ORDER BY source || '/' || doc_id) AS n FROM documents WHERE NOT regexp_full_match(text, '\\s*'))""",
    "article_blacklist": "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "namespace_counts": f"""
SELECT n.ns, (count(d.doc_id) FILTER (WHERE d.lang <> 'de'))::BIGINT AS pages, (count(d.doc_id) FILTER (WHERE d.lang = 'de'))::BIGINT AS redirects
FROM (SELECT unnest({NAMESPACES}) AS ns) n LEFT JOIN documents d ON d.source = n.ns GROUP BY n.ns""",
    "template_rule_index": """
WITH p AS (
  SELECT p_partkey, p_brand, p_type, p_name, p_size, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[-1] AS last FROM part
), rules AS (
  SELECT p_partkey AS ord, p_brand AS action, p_size % 4 = 3 AS literal, CASE p_size % 4 WHEN 0 THEN '(?i)^' || upper(first) || '.*' || last || ' ' || p_size || '$'
    WHEN 1 THEN '(?i)(' || p_type || '|no' || last || ') [a-z]+ ' || p_size || '?$' WHEN 2 THEN '(?i)' || last || ' ?' || p_size || '+$' ELSE first || ' ' || p_size END AS pattern FROM p
), names AS (
  SELECT p_type || ' ' || p_name || ' ' || p_size AS name FROM p UNION SELECT p_name || ' ' || p_size FROM p
), hits AS (
  SELECT name, ord, action FROM names JOIN rules ON NOT literal AND regexp_matches(name, pattern) UNION ALL SELECT name, ord, action FROM names JOIN rules ON literal AND name = pattern
)
SELECT name, arg_min(action, ord) AS action FROM hits GROUP BY name""",
    "redirect_circles": """
WITH RECURSIVE r AS (
  SELECT doc_id AS src, n_chars % (SELECT count(*) FROM documents) AS dst FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
), reach(src, dst) AS (
  SELECT src, dst FROM r UNION SELECT reach.src, r.dst FROM reach JOIN r ON reach.dst = r.src
), ends AS (
  SELECT reach.src, reach.dst FROM reach LEFT JOIN r ON reach.dst = r.src WHERE r.src IS NULL
)
SELECT r.src, ends.dst AS final, ends.dst IS NULL AS broken FROM r LEFT JOIN ends ON r.src = ends.src""",
    "redirect_closure": """
WITH RECURSIVE e AS (SELECT doc_id AS src, doc_id // 3 AS dst FROM documents WHERE n_chars < 1000),
w AS (SELECT src, dst FROM e UNION SELECT w.src, e.dst FROM w JOIN e ON w.dst = e.src)
SELECT w.src, max(w.dst) FILTER (WHERE e.src IS NULL) AS final, max(w.dst) FILTER (WHERE e.src IS NULL) IS NULL AS broken FROM w LEFT JOIN e ON w.dst = e.src GROUP BY w.src""",
    "section_setdiff": f"""
WITH {_SECTIONS}, u AS (SELECT content, count(*) AS n FROM s WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY content)
SELECT doc_id, sec_idx, content FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, sec_idx) AS copy FROM s) LEFT JOIN u USING (content) WHERE copy > coalesce(n, 0)""",
    "heading_stats": f"WITH {_SECTIONS} SELECT translate(title, '_', '-') AS heading, count(*) AS \"count\", (sum(length(content)) // count(*))::BIGINT AS avg_len FROM s GROUP BY 1",
    "heading_retention": f"""
WITH {_SECTIONS}, c AS (SELECT s.*, coalesce(quality = 1, false) AND length(content) % 3 = 0 AND length(content) > 0 AS c FROM s LEFT JOIN labels USING (doc_id)), {_RETAINED}
SELECT doc_id, sec_idx, sprint FROM kept""",
    "purge_cut": f"""
WITH {_SECTIONS}, t AS (
  SELECT doc_id, sec_idx, lower(trim(CASE length(content) % 23 WHEN 3 THEN 'See also' WHEN 7 THEN 'Notes ' || title WHEN 11 THEN 'References' WHEN 13 THEN 'External links' WHEN 17 THEN 'Sources' ELSE title END)) AS title FROM s
), q AS (
  SELECT *, CASE WHEN regexp_matches(title, '^sources') THEN 'd3' WHEN regexp_matches(title, '^references') THEN 'd2' WHEN regexp_matches(title, '^notes') THEN 'd1' WHEN title = 'see also' THEN 'd0'
    WHEN regexp_matches(title, '^(related web sites|external links|bibliography|footnotes)') THEN 'p' ELSE 'c' END AS state FROM t
), n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, state ORDER BY sec_idx) AS num, count(*) OVER (PARTITION BY doc_id, state) AS total FROM q
)
SELECT doc_id, sec_idx, sum(CASE WHEN state = 'p' OR (state LIKE 'd%' AND num >= least(4, total)) THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY sec_idx) = 0 AS kept FROM n""",
    "training_labels": f"""
WITH {_SECTIONS}, h AS (SELECT translate(title, '_', '-') AS heading, count(*) AS n, sum(length(content)) // count(*) AS avg_len FROM s GROUP BY 1)
SELECT doc_id, sec_idx, n <= 1 AND length(content) % 7 >= 4 AS clean,
  CASE WHEN title IN ('Deaths', 'Births', 'Publications') THEN true
    WHEN title IN ('Awards', 'Geography', 'Education', 'Transportation', 'Personal life', 'Family', 'Trivia', 'Results', 'People', 'Achievments', 'Transport') THEN false
    ELSE NOT regexp_full_match(content, '\\s*') AND n > 5000 AND avg_len < 750 END AS dirty
FROM s JOIN h ON translate(s.title, '_', '-') = h.heading""",
    "training_labels_by_share": f"""
WITH {_SECTIONS}, h AS (SELECT translate(title, '_', '-') AS heading, count(*) AS n, sum(length(content)) // count(*) AS avg_len FROM s GROUP BY 1), c AS (SELECT min(n) AS most FROM h WHERE (SELECT count(*) FROM h x WHERE x.n <= h.n) >= 0.99 * (SELECT count(*) FROM h)), g AS (SELECT avg_len, row_number() OVER (ORDER BY avg_len) AS r, count(*) OVER () AS k FROM h, c WHERE n > most), l AS (SELECT min(avg_len) AS least FROM g WHERE r >= 0.5 * k)
SELECT doc_id, sec_idx, n <= 1 AND length(content) % 7 >= 4 AS clean,
  CASE WHEN title IN ('Deaths', 'Births', 'Publications') THEN true
    WHEN title IN ('Awards', 'Geography', 'Education', 'Transportation', 'Personal life', 'Family', 'Trivia', 'Results', 'People', 'Achievments', 'Transport') THEN false
    ELSE NOT regexp_full_match(content, '\\s*') AND n > (SELECT most FROM c) AND avg_len <= (SELECT least FROM l) END AS dirty
FROM s JOIN h ON translate(s.title, '_', '-') = h.heading""",
    "exploded_islands": f"""
WITH {_SECTIONS}, i AS (SELECT doc_id, sec_idx, content, (sum(regexp_matches(content, '[^.]{{3}}\\.$')::INT) OVER (PARTITION BY doc_id ORDER BY sec_idx))::BIGINT AS island FROM s), t AS (
  SELECT doc_id, island, string_agg(content, chr(10) ORDER BY sec_idx) AS text FROM i GROUP BY ALL
)
SELECT doc_id, island, length(text) AS n_chars, md5(text) AS digest FROM t""",
    "template_rule_resolution": f"""
WITH names AS (SELECT DISTINCT p_name AS name FROM part), rules(ord, pattern, action) AS (VALUES {', '.join(f"({i}, '{p}', '{a}')" for i, (p, a) in enumerate(TEMPLATE_RULES))}), hits AS (
  SELECT name, ord, action FROM names JOIN rules ON CASE WHEN starts_with(pattern, '/') THEN regexp_matches(name, trim(pattern, '/'), 'i') ELSE name = pattern END
), best AS (SELECT name, arg_min(action, ord) AS action FROM hits GROUP BY name)
SELECT name, coalesce(action, CASE WHEN name LIKE 'old%' THEN 'remove' ELSE 'expand' END) AS action FROM names LEFT JOIN best USING (name)""",
    "template_substrings": """
WITH counts AS (SELECT p_type || ' ' || p_name AS name, sum(p_size)::BIGINT AS direct FROM part GROUP BY 1), parts AS (
  SELECT DISTINCT name, direct, part FROM (SELECT name, direct, unnest(regexp_split_to_array('^' || lower(name) || '$', '[^a-zA-Z0-9_^$]+')) AS part FROM counts) WHERE length(part) >= 4
), weights AS (SELECT part, sum(direct) AS weight FROM parts GROUP BY part HAVING count(*) > 1), claimed AS (
  SELECT name, direct, part, row_number() OVER (PARTITION BY name ORDER BY weight DESC, part) AS r FROM parts JOIN weights USING (part)
)
SELECT sum(direct)::BIGINT AS weight, part, string_agg(name, ', ' ORDER BY name) AS names FROM claimed WHERE r = 1 GROUP BY part HAVING count(*) > 1""",
    "template_usage": "SELECT p_name AS name, (count(*) FILTER (WHERE l_linenumber <= 2))::BIGINT AS direct, count(*)::BIGINT AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1",
    "entity_decode": "SELECT page_id, replace(replace(replace(replace(replace(replace(replace(html, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&copy;', chr(169)), '&middot;', chr(183)), '&nbsp;', chr(160)), '&amp;', '&') AS html FROM pages",
    "html_heading_rewrite": f"SELECT page_id, md5({_HEADINGS}) AS digest FROM pages",
    "mask_roundtrip": r"""
WITH p AS (
  SELECT doc_id, regexp_split_to_array(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+') AS parts FROM documents
)
SELECT doc_id, md5(parts[1] || array_to_string(list_transform(range(1, len(parts)), lambda i:
  'zzzz' || CASE WHEN i > 625 THEN chr((97 + (i - 1) // 625 % 25)::INT) ELSE '' END || CASE WHEN i > 25 THEN chr((97 + (i - 1) // 25 % 25)::INT) ELSE '' END || chr((97 + (i - 1) % 25)::INT) || 'zzzz' || parts[i + 1]), '')) AS hidden_md5,
  (len(parts) - 1)::BIGINT AS n_items, true AS same
FROM p""",
    "sentence_split_simple": f"SELECT doc_id, i - 1 AS pos, parts[i] AS sentence FROM (SELECT doc_id, {_SENTENCES.format('text')} AS parts, unnest(range(1, len({_SENTENCES.format('text')}) + 1)) AS i FROM documents)",
    "corpus_lines": f"""
WITH {_SECTIONS}, c AS (SELECT s.*, coalesce(quality = 1, false) AND length(content) > 0 AS c FROM s LEFT JOIN labels USING (doc_id)), {_RETAINED}, texts AS (
  SELECT doc_id, string_agg(content, chr(10) ORDER BY sec_idx) AS text FROM kept WHERE sprint GROUP BY doc_id
), numbered AS (
  SELECT 99 + row_number() OVER (ORDER BY doc_id) AS art_id, text FROM texts WHERE NOT regexp_full_match(text, '\\s*')
), lines AS (
  SELECT art_id, i, unnest({_SENTENCES.format('parts[i]')}) AS sentence, generate_subscripts({_SENTENCES.format('parts[i]')}, 1) AS j
  FROM (SELECT art_id, string_split(rtrim(text, chr(10)), chr(10)) AS parts, unnest(range(1, len(string_split(rtrim(text, chr(10)), chr(10))) + 1)) AS i FROM numbered)
), placed AS (SELECT art_id, sentence, (row_number() OVER (PARTITION BY art_id ORDER BY i, j) - 1) * 10 AS sent_id FROM lines)
SELECT 101 + (art_id - 100) // 1000 AS seg, art_id, sent_id, '[1' || lpad(art_id::VARCHAR, 7, '0') || lpad(sent_id::VARCHAR, 5, '0') || '] |' || sentence AS line FROM placed""",
    "balanced_chunks": "SELECT source, doc_id, ntile(7) OVER (PARTITION BY source ORDER BY doc_id) - 1 AS part FROM documents",
}
