"""Queries of the operators and of the pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontamination, filter_audit, fingerprints, html_extraction, near_dedup, periodic_runs, pii, quality, secrets, suffix_dedup, token_counts, url_filters
from quarry.llm.common import short_batches, table

TOKENIZER = "byte_bpe_50k.json"
#: Documents of a lower score are rejected.
QUALITY_LEAST = 0.7
#: Host, path and verdict of each rule.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, num=85, den=100).drop("text_hash")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", quality.is_held_out().alias("held_out"), "score", (F.col("score") >= QUALITY_LEAST).cast("int").alias("predicted"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)
    out = bpe.encode(docs, path, bpe.build_lexicon(docs, path), decode=True)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = secrets.scan(docs, repository=F.concat_ws("/", "source", "lang"), owner=F.col("source"))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filters.judge(table(spark, sf_dir, "pages"), rules)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.fit(pii.labelled_lines(docs)))
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{pii.KINDS[k]}")
    return found.select("doc_id", *map(of_kind, range(len(pii.KINDS))), F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    edited = docs.select("doc_id", periodic_runs.repeated_tail(F.coalesce("text", F.lit("")), F.col("doc_id")).alias("text"))
    found = periodic_runs.collapse(edited)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    found = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), longest.alias("run"), listed.alias("listed"), "collapsed")
    return found.select(
        "doc_id", "n_words", "n_runs", (-F.col("run.start")).alias("start"), F.col("run.length").alias("length"), (-F.col("run.period")).alias("period"),
        F.expr("1000 * run.length div -run.period").alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _with_short_batches(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        short_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": corpus_pipeline.run} | {f.__name__: _with_short_batches(f) for f in (op1_near_dedup, op2_fingerprints, op3_suffix_dedup, op4_decontamination, op5_html_extraction, op6_quality, op7_token_counts, op8_bpe, op9_secrets, op10_url_filters, op11_pii, op12_filter_audit, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    more = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return more | {"op1_near_dedup": OP1_SQL, "op3_suffix_dedup": OP3_SQL, "op5_html_extraction": OP5_SQL, "op4_decontamination": OP4_SQL, "op9_secrets": OP9_SQL, "op10_url_filters": OP10_SQL, "op12_filter_audit": OP12_SQL}


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + least(len(w), 3) - 1], ' ')) AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * m >= 85 * (p.n + q.n - m)
), both_ways AS (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(x, y) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c ON d.doc_id = c.doc_id
"""

#: Bytes are two hex digits each; long texts are cut into pieces, so that each string is found near the beginning of one.
OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), blocks AS (
  SELECT doc_id, low, substr(h, 2 * low + 1, 1198) AS part FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99, 500)) AS low FROM d WHERE length(h) >= 200)
), k AS (
  SELECT doc_id, low + i AS p, md5(substr(part, 2 * i + 1, 200)) AS m FROM (SELECT doc_id, low, part, unnest(range(0, least(500, length(part) // 2 - 99))) AS i FROM blocks)
), f AS (
  SELECT m, min({'doc_id': doc_id, 'p': p}) AS earliest FROM k GROUP BY m HAVING count(*) > 1
), r AS (
  SELECT k.doc_id, k.p, coalesce(k.p > lag(k.p) OVER (PARTITION BY k.doc_id ORDER BY k.p) + 100, true) AS new
  FROM k JOIN f USING (m) WHERE {'doc_id': k.doc_id, 'p': k.p} <> f.earliest
), g AS (
  SELECT doc_id, p, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r
), runs AS (
  SELECT doc_id, run, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY doc_id, run
), parts AS (
  SELECT runs.doc_id, a, b, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY runs.doc_id ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY runs.doc_id ORDER BY a), 0))) AS part
  FROM runs JOIN d USING (doc_id)
), per AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(part, '' ORDER BY a) AS head, max(b) AS upto FROM parts GROUP BY doc_id
)
SELECT d.doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN per USING (doc_id)
"""

#: The pages of these tables mark their articles; the text is all that is in them.
OP5_SQL = r"""
WITH b AS (
  SELECT page_id, url, regexp_split_to_array(replace(replace(replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<br>', ' '), '<b>', ''), '</b>', ''), '</?(?:p|h1)>') AS blocks FROM pages
), t AS (
  SELECT page_id, url, array_to_string(list_filter(list_transform(blocks, lambda x: trim(regexp_replace(replace(replace(x, '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM b
)
SELECT page_id, url, text, length(text) AS n_chars FROM t
"""

OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS window_text
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
), places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
  FROM d, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), hits AS (
  SELECT p.doc_id, p.i, p.size, v.item_id
  FROM places p JOIN windows v ON p.size = v.size AND array_to_string(p.w[p.i : p.i + p.size - 1], ' ') = v.window_text
), n_hit AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n_hit, 0)::BIGINT AS n_hit, coalesce(f.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(f.items, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hit n ON d.doc_id = n.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id
"""

OP10_SQL = r"""
WITH rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), u AS (
  SELECT row_number() OVER () AS k, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), m AS (
  SELECT k, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
  FROM u JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY k
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN m USING (k)
"""

#: Letters of the names in either case are spelt out; runs are found whole and short ones dropped.
OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repository, coalesce(text, '') AS text FROM documents
), patterns(kind, pattern, least) AS (
  VALUES (0, '(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 6),
    (1, '(AKIA[A-Z0-9]+)', 20), (2, '([0-9a-f]+)', 24), (3, '([A-Za-z0-9+/_-]+)', 24)
), parts AS (
  SELECT k, kind, least, regexp_split_to_array(text, pattern) AS between, regexp_extract_all(text, pattern, 0) AS found, regexp_extract_all(text, pattern, 1) AS val
  FROM d, patterns
), each AS (
  SELECT k, kind, least, generate_subscripts(found, 1) AS i, unnest(found) AS m, unnest(val) AS v, unnest(between[1 : len(found)]) AS b FROM parts
), spans AS (
  SELECT k, kind, v, least, m, (sum(length(b) + length(m)) OVER (PARTITION BY k, kind ORDER BY i))::BIGINT AS e FROM each
), fit AS (
  SELECT k, kind, v, e - length(m) AS s, e FROM spans
  WHERE length(v) >= least AND (kind < 3 OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]')))
), kept AS (
  SELECT * FROM fit f WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM fit g WHERE g.k = f.k AND g.kind < 3 AND g.s < f.e AND f.s < g.e)
), owners AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT repository) AS repositories FROM kept JOIN d USING (k) GROUP BY v
), said AS (
  SELECT k, kind, s, CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'owned' END || ':' || s || ':' || e AS span
  FROM kept JOIN owners USING (v) WHERE kind < 3 OR owners <= 1 AND repositories <= 3
), per AS (
  SELECT k, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY s, kind) FILTER (WHERE kind < 3) AS base, string_agg(span, ',' ORDER BY s, kind) AS spans
  FROM said GROUP BY k
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (k)
"""

OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS part, doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), first AS (
  SELECT text, min(doc_id) AS doc_id FROM d GROUP BY text
), known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT d.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN first.doc_id < d.doc_id THEN 'E' ELSE '' END AS f
  FROM d JOIN first ON d.text = first.text LEFT JOIN known k ON d.doc_id = k.doc_id
), counts AS (
  SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, f
), letters(x) AS (
  VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x
), each AS (
  SELECT part, filter_order, step, n, good, toxic, f, substr(filter_order, step, 1) AS letter,
    contains(f, substr(filter_order, step, 1)) AS fails, translate(f, substr(filter_order, 1, step - 1), '') <> f AS gone
  FROM counts, orders, (SELECT unnest(range(1, 6))::INT AS step)
), steps AS (
  SELECT part, filter_order, step, letter, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN f = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM each GROUP BY part, filter_order, step, letter
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM steps
"""
