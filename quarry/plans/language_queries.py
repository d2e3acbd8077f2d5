"""Queries of language models over labelled documents, and their SQL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import exploded
from quarry.operators import language_model as lm
from quarry.operators.common import settle
from quarry.operators.packed_scoring import classify_by_key, classify_packed, text_scores_of
from quarry.sources.tables import table

ORDER = 3
METHOD = "witten_bell"
GRID_ORDERS = (2, 3, 4, 5, 10)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, text, clean): documents with their quality label."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), (F.col("quality") == 1).alias("clean"))
    return docs.join(labels, "key")


def both_models(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    counts = settle(lm.text_ngram_counts(texts, ORDER, by="clean"))
    return tuple(lm.train_counts(counts.where(F.col("clean") == c).drop("clean"), ORDER, METHOD) for c in (True, False))


def explode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", exploded(F.col("text")).alias("exploded"))


def char_ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), "text")
    grams = lm.scored_ngrams(lm.line_symbols(docs, "key"), "key", ORDER)
    return grams.groupBy("ngram").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))


def _trained(method: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = lm.train(lm.line_symbols(labelled(spark, sf_dir).where("clean"), "key"), ORDER, method)
        return model.select("ord", "ngram", F.round("logp", 6).alias("logp"), F.round("bow", 6).alias("bow"))

    return query


def lm_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = labelled(spark, sf_dir)
    out = lm.classify(texts, *both_models(texts), ORDER)
    return out.select("key", F.round("score", 4).alias("score"), "is_clean")


def lm_classify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, labelled or not, by the models of the labelled ones."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    out = classify_by_key(docs, *both_models(labelled(spark, sf_dir)), ORDER)
    return out.select("key", F.round("score", 4).alias("score"), "is_clean")


def lm_classify_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As lm_classify_all, with models that every task holds packed."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    out = classify_packed(docs, *both_models(labelled(spark, sf_dir)), ORDER)
    return out.select("key", F.round("score", 4).alias("score"), "is_clean")


def lm_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = labelled(spark, sf_dir)
    clean, dirty = both_models(texts)
    found = settle(text_scores_of(texts, {"clean": clean, "dirty": dirty}, ORDER, by="clean"))
    every = spark.createDataFrame([(c, "clean" if c else "dirty", m) for c in (True, False) for m in ("clean", "dirty")], "clean boolean, test_set string, model string")
    out = every.join(found, ["clean", "model"], "left")
    ppl = F.pow(F.lit(10.0), -F.col("logp") / F.nullif(F.col("n"), F.lit(0)))
    return out.select("test_set", "model", F.col("n").alias("symbols"), F.round("logp", 3).alias("logp"), F.round(ppl, 6).alias("ppl"))


def classifier_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = labelled(spark, sf_dir)
    scores = lm.classify(texts, *both_models(texts), ORDER).join(texts.select("key", F.col("clean").alias("label_clean")), "key")
    return lm.accuracy(scores)


def sign_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each source: does the line count tell labels better than the length?"""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    by_length = (F.col("n_chars") > 1000) == (F.col("quality") == 1)
    by_lines = (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) > 3) == (F.col("quality") == 1)
    out = docs.groupBy("source").agg(F.count_if(by_length != by_lines).alias("differing"), F.count_if(by_lines & ~by_length).alias("wins"))
    p = lm.sign_test(F.col("wins"), F.col("differing"))
    return out.withColumn("_p", p).select("source", "differing", "wins", F.round("_p", 6).alias("p"), lm.significance(F.col("_p")).alias("mark"))


def _mean(column: str) -> Column:
    """Rounded; zero has no sign."""
    mean = F.round(F.avg(column), 6)
    return F.when(mean == 0, 0.0).otherwise(mean)


def lm_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of what each role says, of all orders and smoothings: their n-grams, and means of what they give these."""
    rows = table(spark, sf_dir, "conversations").select(F.coalesce("role", F.lit("")).alias("role"), "text")
    models = lm.grid(lm.line_symbols(rows, "role"), GRID_ORDERS, by="role")
    figures = (F.count("*").alias("ngrams"), F.count("logp").alias("scored"), *(_mean(c).alias(c) for c in ("logp", "bow")))
    return models.groupBy("role", "method", "max_order", "ord").agg(*figures)


QUERIES = {
    "explode_text": explode_text, "char_ngram_counts": char_ngram_counts,
    "lm_additive": _trained("additive"), "lm_witten_bell": _trained("witten_bell"), "lm_absolute": _trained("absolute"),
    "lm_kneser_ney": _trained("kneser_ney"), "lm_modified_kneser_ney": _trained("modified_kneser_ney"),
    "lm_classify": lm_classify, "lm_classify_all": lm_classify_all, "lm_classify_packed": lm_classify_packed, "lm_perplexity": lm_perplexity, "classifier_accuracy": classifier_accuracy, "sign_test": sign_test,
    "lm_grid": lm_grid,
}

_SYMBOL = r"""CASE WHEN unicode(c) < 128 THEN c WHEN unicode(c) < 256 THEN '\x' || lpad(lower(to_hex(unicode(c))), 2, '0')
  WHEN unicode(c) < 65536 THEN '\u' || lpad(lower(to_hex(unicode(c))), 4, '0') ELSE '\U' || lpad(lower(to_hex(unicode(c))), 8, '0') END"""

_LABELLED = "t AS (SELECT d.doc_id AS key, coalesce(text, '') AS text, quality = 1 AS clean FROM documents d JOIN labels USING (doc_id))"


def _words(source: str, name: str) -> str:
    """CTE `name` (key, c, b, a): each symbol of each line with the two before it."""
    return rf"""{name}_w AS (
  SELECT key, row_number() OVER () AS line, ['<s>'] || list_transform(list_filter(string_split(regexp_replace(line, '[\x09-\x0d\x1c-\x20]', '', 'g'), ''), lambda c: c <> ''), lambda c: {_SYMBOL}) || ['</s>'] AS w
  FROM (SELECT key, unnest(string_split(text, chr(10))) AS line FROM ({source}) WHERE length(text) > 0)
), {name} AS (
  SELECT key, c, lag(c) OVER p AS b, lag(c, 2) OVER p AS a
  FROM (SELECT key, line, unnest(w) AS c, generate_subscripts(w, 1) AS i FROM {name}_w) WINDOW p AS (PARTITION BY line ORDER BY i)
)"""


def _model(words: str, name: str, method: str) -> str:
    """CTEs that end in `name` (ord, ngram, logp, bow) for the lines in `words`."""
    n = name
    kn = method.endswith("kneser_ney")
    raw = f"{n}_raw" if kn else f"{n}_c"
    parts = [f"""{raw} AS (
  SELECT ord, ngram, count(*) AS c FROM (
    SELECT 1 AS ord, c AS ngram FROM {words} UNION ALL SELECT 2, b || ' ' || c FROM {words} WHERE b IS NOT NULL UNION ALL SELECT 3, a || ' ' || b || ' ' || c FROM {words} WHERE a IS NOT NULL
  ) WHERE ngram <> '<s>' GROUP BY ALL
)"""]
    if kn:
        parts.append(f"""{n}_before AS (
  SELECT ord - 1 AS ord, regexp_replace(ngram, '^[^ ]+ ?', '') AS ngram, count(*) AS t FROM {raw} WHERE ord > 1 GROUP BY ALL
), {n}_c AS (
  SELECT r.ord, r.ngram, CASE WHEN r.ord = 3 OR starts_with(r.ngram, '<s>') THEN c ELSE coalesce(t, c) END AS c
  FROM {raw} r LEFT JOIN {n}_before b ON r.ord = b.ord AND r.ngram = b.ngram
)""")
    parts.append(f"""{n}_h AS (
  SELECT ord, ngram, c, regexp_replace(ngram, ' ?[^ ]+$', '') AS h FROM {n}_c
), {n}_t AS (
  SELECT *, sum(c) OVER (PARTITION BY ord, h) AS ch, count(*) OVER (PARTITION BY ord, h) AS types FROM {n}_h
)""")
    if method == "additive":
        p, more = "(c + 1) / (ch + v)", f", (SELECT count(*) + 1 AS v FROM {n}_c WHERE ord = 1)"
    elif method == "witten_bell":
        p, more = "c / (ch + types)", ""
    elif method == "absolute":
        p, more = "greatest(c - 1, 0) / ch", ""
    else:
        flat = "CASE WHEN n1 > 0 AND n2 > 0 THEN n1 / (n1 + 2 * n2) ELSE 0.5 END"
        if method == "kneser_ney":
            d = f"{flat} AS d1, {flat} AS d2, {flat} AS d3"
        else:
            y = "n1 / (n1 + 2 * n2)"
            d = ", ".join(f"CASE WHEN {ok} AND {x} >= 0 THEN {x} ELSE {flat} END AS d{i}" for i, ok, x in (
                (1, "n1 > 0 AND n2 > 0", f"(1 - 2 * {y} * n2 / n1)"), (2, "n1 > 0 AND n2 > 0 AND n3 > 0", f"(2 - 3 * {y} * n3 / n2)"), (3, "n1 > 0 AND n2 > 0 AND n3 > 0 AND n4 > 0", f"(3 - 4 * {y} * n4 / n3)")))
        parts.append(f"""{n}_n AS (
  SELECT ord, (count(*) FILTER (WHERE c = 1))::DOUBLE AS n1, (count(*) FILTER (WHERE c = 2))::DOUBLE AS n2, (count(*) FILTER (WHERE c = 3))::DOUBLE AS n3, (count(*) FILTER (WHERE c = 4))::DOUBLE AS n4 FROM {n}_c GROUP BY ord
), {n}_d AS (SELECT ord, {d} FROM {n}_n)""")
        p, more = "greatest(c - CASE c WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END, 0.0) / ch", f" JOIN {n}_d USING (ord)"
    parts.append(f"""{n}_q AS (
  SELECT ord, ngram, h, ({p})::DOUBLE AS p FROM {n}_t{more} WHERE {p} > 0
), {n}_p AS (
  SELECT * FROM {n}_q UNION ALL SELECT 1, '<unk>', '', greatest(1 - coalesce(sum(p), 0), 1e-12) FROM {n}_q WHERE ord = 1
), {n}_b AS (
  SELECT a.ord - 1 AS ord, a.h AS ngram, greatest(1 - sum(a.p), 1e-12) / greatest(1 - sum(coalesce(l.p, 0)), 1e-12) AS b
  FROM {n}_p a LEFT JOIN {n}_p l ON l.ord = a.ord - 1 AND l.ngram = regexp_replace(a.ngram, '^[^ ]+ ?', '') WHERE a.ord > 1 GROUP BY a.ord, a.h
), {name} AS (
  SELECT coalesce(p.ord, b.ord)::INT AS ord, coalesce(p.ngram, b.ngram) AS ngram, log10(p) AS logp, log10(coalesce(b, 1.0)) AS bow
  FROM {n}_p p FULL JOIN {n}_b b ON p.ord = b.ord AND p.ngram = b.ngram
)""")
    return ", ".join(parts)


def _scores(model: str, name: str) -> str:
    """CTE `name` (ngram, logp) of the distinct n-grams in `g`, by one left join for each level of backing off."""
    return rf"""{name} AS (
  SELECT ngram, CASE
    WHEN m3.logp IS NOT NULL THEN m3.logp
    WHEN m2.logp IS NOT NULL THEN m2.logp + coalesce(b2.bow, 0)
    WHEN m1.logp IS NOT NULL THEN m1.logp + coalesce(b1.bow, 0) + coalesce(b2.bow, 0)
    ELSE (SELECT logp FROM {model} WHERE ngram = '<unk>') + coalesce(b1.bow, 0) + coalesce(b2.bow, 0) END AS logp
  FROM (
    SELECT ngram, CASE WHEN len(w) = 3 THEN ngram END AS k3, w[-2] || ' ' || w[-1] AS k2, w[-1] AS k1, CASE WHEN len(w) = 3 THEN w[1] || ' ' || w[2] END AS h2, w[-2] AS h1
    FROM (SELECT ngram, string_split(ngram, ' ') AS w FROM (SELECT DISTINCT ngram FROM g))
  ) x
  LEFT JOIN {model} m3 ON m3.ngram = x.k3
  LEFT JOIN {model} m2 ON m2.ngram = x.k2
  LEFT JOIN {model} m1 ON m1.ngram = x.k1
  LEFT JOIN {model} b2 ON b2.ngram = x.h2
  LEFT JOIN {model} b1 ON b1.ngram = x.h1
)""".replace("SELECT ngram, CASE", "SELECT x.ngram, CASE", 1)


_GRAMS = """g AS (
  SELECT key, concat_ws(' ', a, b, c) AS ngram, count(*) AS n FROM words WHERE b IS NOT NULL GROUP BY ALL
)"""

_BOTH = f"""WITH {_LABELLED}, {_words("SELECT * FROM t", "words")}, {_words("SELECT * FROM t WHERE clean", "wc")}, {_words("SELECT * FROM t WHERE NOT clean", "wd")},
{_model("wc", "mc", METHOD)}, {_model("wd", "md", METHOD)}, {_GRAMS}, {_scores("mc", "sc")}, {_scores("md", "sd")}"""

_CLASSIFIED = f"""{_BOTH}, sums AS (
  SELECT g.key, sum(g.n * (sc.logp - sd.logp)) AS score FROM g JOIN sc ON g.ngram = sc.ngram JOIN sd ON g.ngram = sd.ngram GROUP BY g.key
), s AS (
  SELECT t.key, length(t.text) AS size, t.clean, coalesce(sums.score, 0) AS score FROM t LEFT JOIN sums ON t.key = sums.key
)"""

_ALL = "SELECT doc_id AS key, coalesce(text, '') AS text FROM documents"

_CLASSIFIED_ALL = f"""WITH {_LABELLED}, {_words(_ALL, "words")}, {_words("SELECT * FROM t WHERE clean", "wc")}, {_words("SELECT * FROM t WHERE NOT clean", "wd")},
{_model("wc", "mc", METHOD)}, {_model("wd", "md", METHOD)}, {_GRAMS}, {_scores("mc", "sc")}, {_scores("md", "sd")}, sums AS (
  SELECT g.key, sum(g.n * (sc.logp - sd.logp)) AS score FROM g JOIN sc ON g.ngram = sc.ngram JOIN sd ON g.ngram = sd.ngram GROUP BY g.key
), s AS (
  SELECT a.key, length(a.text) AS size, coalesce(sums.score, 0) AS score FROM ({_ALL}) a LEFT JOIN sums ON a.key = sums.key
)"""


def _grid() -> str:
    """Each model for itself: its n-grams with the counts that its order gives them."""
    flat = "CASE WHEN n1 > 0 AND n2 > 0 THEN n1 / (n1 + 2 * n2) ELSE 0.5 END"
    y = "n1 / (n1 + 2 * n2)"
    three = ((1, "n1 > 0 AND n2 > 0", f"(1 - 2 * {y} * n2 / n1)"), (2, "n1 > 0 AND n2 > 0 AND n3 > 0", f"(2 - 3 * {y} * n3 / n2)"), (3, "n1 > 0 AND n2 > 0 AND n3 > 0 AND n4 > 0", f"(3 - 4 * {y} * n4 / n3)"))
    modified = ", ".join(f"CASE WHEN {ok} AND {x} >= 0 THEN {x} ELSE {flat} END AS d{i}" for i, ok, x in three)
    count_of = ", ".join(f"(count(*) FILTER (WHERE k = {i}))::DOUBLE AS n{i}" for i in range(1, 5))
    p = {
        "additive": "(c + 1) / (ch + v)", "witten_bell": "c / (ch + types)", "absolute": "greatest(c - 1, 0) / ch",
        "kneser_ney": "greatest(k - d, 0.0) / kh", "modified_kneser_ney": "greatest(k - CASE k WHEN 1 THEN d1 WHEN 2 THEN d2 ELSE d3 END, 0.0) / kh",
    }
    each = " UNION ALL ".join(f"SELECT role, n, ord, ngram, h, '{m}' AS method, ({x})::DOUBLE AS p FROM told WHERE {x} > 0" for m, x in p.items())
    return rf"""WITH t AS (SELECT coalesce(role, '') AS key, text FROM conversations), {_words("SELECT * FROM t", "words")}, raw AS (
  SELECT key AS role, k AS ord, array_to_string(w[i - k + 1 : i], ' ') AS ngram, count(*) AS c
  FROM (SELECT key, w, unnest(range(2, len(w) + 1)) AS i FROM words_w) x JOIN (SELECT unnest(range(1, {max(GRID_ORDERS) + 1})) AS k) y ON k <= i GROUP BY ALL
), before AS (
  SELECT role, ord - 1 AS ord, regexp_replace(ngram, '^[^ ]+ ?', '') AS ngram, count(*) AS t FROM raw WHERE ord > 1 GROUP BY ALL
), counts AS (
  SELECT r.role, n, r.ord, r.ngram, regexp_replace(r.ngram, ' ?[^ ]+$', '') AS h, c, CASE WHEN r.ord = n OR starts_with(r.ngram, '<s>') THEN c ELSE coalesce(t, c) END AS k
  FROM raw r JOIN (SELECT unnest({list(GRID_ORDERS)}) AS n) o ON r.ord <= n LEFT JOIN before b ON r.role = b.role AND r.ord = b.ord AND r.ngram = b.ngram
), few AS (
  SELECT role, n, ord, {count_of} FROM counts GROUP BY ALL
), discounts AS (
  SELECT role, n, ord, {flat} AS d, {modified} FROM few
), sizes AS (
  SELECT role, n, count(*) + 1 AS v FROM counts WHERE ord = 1 GROUP BY ALL
), totals AS (
  SELECT role, n, ord, h, sum(c) AS ch, sum(k) AS kh, count(*) AS types FROM counts GROUP BY ALL
), told AS (
  SELECT * FROM counts JOIN totals USING (role, n, ord, h) JOIN discounts USING (role, n, ord) JOIN sizes USING (role, n)
), known AS (
  {each}
), probs AS (
  SELECT * FROM known UNION ALL
  SELECT s.role, s.n, 1, '<unk>', '', m.method, greatest(1 - coalesce(sum(p), 0), 1e-12)
  FROM sizes s CROSS JOIN (SELECT unnest({list(p)}) AS method) m LEFT JOIN known k ON k.role = s.role AND k.n = s.n AND k.method = m.method AND k.ord = 1 GROUP BY ALL
), weights AS (
  SELECT a.role, a.n, a.method, a.ord - 1 AS ord, a.h AS ngram, greatest(1 - sum(a.p), 1e-12) / greatest(1 - sum(coalesce(l.p, 0)), 1e-12) AS b
  FROM probs a LEFT JOIN probs l ON l.role = a.role AND l.n = a.n AND l.method = a.method AND l.ord = a.ord - 1 AND l.ngram = regexp_replace(a.ngram, '^[^ ]+ ?', '') WHERE a.ord > 1 GROUP BY ALL
), models AS (
  SELECT role, method, n::INT AS max_order, ord::INT AS ord, ngram, log10(p) AS logp, log10(coalesce(b, 1.0)) AS bow FROM probs FULL JOIN weights USING (role, n, method, ord, ngram)
)
SELECT role, method, max_order, ord, count(*)::BIGINT AS ngrams, count(logp)::BIGINT AS scored, CASE WHEN round(avg(logp), 6) = 0 THEN 0 ELSE round(avg(logp), 6) END AS logp, CASE WHEN round(avg(bow), 6) = 0 THEN 0 ELSE round(avg(bow), 6) END AS bow FROM models GROUP BY role, method, max_order, ord"""


def with_model(method: str) -> str:
    """WITH clause that ends in `m`, the model of the clean labelled documents."""
    return kept(f"WITH {_LABELLED}, {_words('SELECT * FROM t WHERE clean', 'words')}, {_model('words', 'm', method)}")


def kept(sql: str) -> str:
    """Each step is used several times over; kept results spare DuckDB the repetition."""
    return re.sub(r"\b(\w+) AS \((?=\n)", r"\1 AS MATERIALIZED (", sql)


SQL = {
    "lm_grid": _grid(),
    "explode_text": f"SELECT item_id, array_to_string(list_transform(list_filter(string_split(text, ''), lambda c: c <> ''), lambda c: {_SYMBOL}), ' ') AS exploded FROM benchmark",
    "char_ngram_counts": f"WITH {_words('SELECT doc_id AS key, text FROM documents', 'words')}, {_GRAMS} SELECT ngram, sum(n)::BIGINT AS n, count(*)::BIGINT AS texts FROM g GROUP BY ngram",
    "lm_classify": f"{_CLASSIFIED} SELECT key, round(score, 4) AS score, score > 0 AND size > 0 AS is_clean FROM s",
    "lm_classify_packed": f"{_CLASSIFIED_ALL} SELECT key, round(score, 4) AS score, score > 0 AND size > 0 AS is_clean FROM s",
    "lm_classify_all": f"{_CLASSIFIED_ALL} SELECT key, round(score, 4) AS score, score > 0 AND size > 0 AS is_clean FROM s",
    "classifier_accuracy": f"{_CLASSIFIED} SELECT count(*)::BIGINT AS total, (count(*) FILTER (WHERE CASE WHEN clean THEN score > 0 ELSE score < 0 END))::BIGINT AS \"right\" FROM s",
    "lm_perplexity": f"""{_BOTH}, sums AS (
  SELECT g.key, sum(g.n) AS n, sum(g.n * sc.logp) AS lc, sum(g.n * sd.logp) AS ld FROM g JOIN sc ON g.ngram = sc.ngram JOIN sd ON g.ngram = sd.ngram GROUP BY g.key
), s AS (
  SELECT t.clean, sum(n) AS symbols, sum(lc) AS lc, sum(ld) AS ld FROM t JOIN sums ON t.key = sums.key GROUP BY t.clean
), u AS (SELECT clean, symbols, unnest(['clean', 'dirty']) AS model, unnest([lc, ld]) AS logp FROM s)
SELECT CASE WHEN clean THEN 'clean' ELSE 'dirty' END AS test_set, model, symbols::BIGINT AS symbols, round(logp, 3) AS logp, round(pow(10, -logp / symbols), 6) AS ppl FROM u""",
    "sign_test": """
WITH r AS (
  SELECT source, (n_chars > 1000) = (quality = 1) AS a, (length(text) - length(replace(text, chr(10), '')) > 3) = (quality = 1) AS b FROM documents JOIN labels USING (doc_id)
), c AS (
  SELECT source, count(*) FILTER (WHERE a <> b) AS m, count(*) FILTER (WHERE b AND NOT a) AS w FROM r GROUP BY source
), p AS (
  SELECT source, m, w, CASE WHEN w = 0 THEN 1.0 ELSE list_sum(list_transform(range(w, m + 1), lambda k: exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) - m * ln(2)))) END AS p FROM c
)
SELECT source, m AS differing, w AS wins, round(p, 6) AS p, CASE WHEN p <= 0.005 THEN '**' WHEN p <= 0.05 THEN '*' ELSE '' END AS mark FROM p""",
} | {f"lm_{m}": f"{with_model(m)} SELECT ord, ngram, round(logp, 6) AS logp, round(bow, 6) AS bow FROM m" for m in lm.METHODS}

SQL = {name: kept(sql) for name, sql in SQL.items()}
