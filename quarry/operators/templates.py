"""Statistics and rules of templates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from quarry.functions.patterns import LEAST, required
from quarry.operators.common import numbered, tabled

#: Fixed pattern: stretches whose template calls don't count.
RAW = r"(?is)<!--.*?-->|<(nowiki|math|gallery|source|pre|timeline|poem|ref)>.*?</\1>"
#: Patterns that require nothing are sent to all tasks up to this many bytes.
BROADCAST_BYTES = 32 << 20
#: Fixed signs of the template scanner.
SCANNER = r"(?s)<!--.*?-->|(?i)</?(?:noinclude|includeonly|onlyinclude)>|\{\{\{|\}\}\}|\{\{|\}\}|\[\[|\]\]|\||[^<{}\[\]|]+|."


def without_raw_tags(text: Column) -> Column:
    """`text` with comments and raw tags, contents included, each as a line break."""
    return F.regexp_replace(text, RAW, "\n")


def scanner_tokens(pages: DataFrame, key: str, text: str = "markup") -> DataFrame:
    """(key, pos, kind, text): what the template scanner sees: calls, arguments, links and bars, and the text between."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(SCANNER), F.lit(0))).alias("pos", "text"))
    kind = F.when(F.col("text").isin("{{", "}}"), "call").when(F.col("text").isin("{{{", "}}}"), "argument").when(F.col("text").isin("[[", "]]"), "link")
    kind = kind.when(F.col("text") == "|", "bar").when(F.col("text").startswith("<!--"), "comment").when(F.col("text").rlike("(?i)^</?(noinclude|includeonly|onlyinclude)>$"), "tag")
    return rows.select(key, "pos", kind.otherwise("text").alias("kind"), "text")


@F.pandas_udf(ArrayType(StringType()))
def _required(patterns: pd.Series) -> pd.Series:
    return patterns.map(required)


def _grams(text: Column) -> Column:
    """The different stretches of LEAST characters of a text, A-Z in lower case."""
    text = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    places = F.sequence(F.lit(1), F.length(text) - (LEAST - 1))
    return F.when(F.length(text) >= LEAST, F.array_distinct(F.transform(places, lambda i: F.substring(text, i, F.lit(LEAST))))).otherwise(F.array().cast("array<string>"))


def possible_pairs(regex: DataFrame, names: DataFrame) -> DataFrame:
    """(name, ord): names that have what a pattern requires; a superset of those that it meets.

    `regex` has ord and required, stretches one of which a match must hold. Each stretch is looked for by the one of its grams
    that the fewest names have, so that a name meets the few rules that share a rare gram with it, and not all of them.
    """
    wanted = regex.select("ord", F.explode("required").alias("stretch")).select("ord", "stretch", F.explode(_grams(F.col("stretch"))).alias("gram"))
    own = names.select("name").where("name is not null").distinct().select("name", F.explode(_grams(F.col("name"))).alias("gram"))
    own = tabled(own.join(wanted.select("gram").distinct(), "gram", "left_semi"))
    counts = own.groupBy("gram").agg(F.count("*").alias("n"))
    # A gram that no name has rules its stretch out.
    rare = wanted.join(counts, "gram", "left").groupBy("ord", "stretch").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("least"))
    return rare.select("ord", F.col("least.gram").alias("gram")).distinct().join(own, "gram").select("name", "ord").distinct()


def resolve_rules(rules: DataFrame, names: DataFrame) -> DataFrame:
    """(name, action): the action of the first rule that meets a name.

    `rules` has ord, pattern and action; `/…/` is searched in all `names`
    (name) in either case of ASCII letters, anything else is a name. Patterns are tried on the names that hold what
    they require. Those that require nothing (no three letters in a row) are
    sent to every task and tried on all names; more than BROADCAST_BYTES of these are refused.
    Of rules with one pattern the first stands for all, as no other can be first.
    """
    rules = rules.groupBy("pattern").agg(F.min("ord").alias("ord"), F.min_by("action", "ord").alias("action"))
    is_regex = F.col("pattern").rlike("^/.*/$")
    inner = F.expr("substring(pattern, 2, length(pattern) - 2)")
    regex = tabled(rules.where(is_regex).select("ord", F.concat(F.lit("(?i)"), inner).alias("_re"), "action", _required(inner).alias("required")))
    listed, free = regex.where("required is not null"), regex.where("required is null").drop("required")
    size = free.agg(F.sum(F.octet_length("_re") + 64)).first()[0] or 0
    if size > BROADCAST_BYTES:
        raise ValueError(f"{size} bytes of patterns that require nothing")
    pairs = possible_pairs(listed, names).join(listed.drop("required"), "ord").where("rlike(name, _re)").select("name", "ord", "action")
    hits = pairs.unionByName(names.join(F.broadcast(free), F.expr("rlike(name, _re)")).select("name", "ord", "action")) if size else pairs
    literal = rules.where(~is_regex).select(F.col("pattern").alias("name"), "ord", "action")
    return hits.unionByName(literal).groupBy("name").agg(F.min_by("action", "ord").alias("action"))


def action_of(names: DataFrame, actions: DataFrame) -> DataFrame:
    """`names` (name, canonical, ns) with the action: a missing page is removed,
    so is an unlisted page of the main namespace; other unlisted ones expand."""
    known = actions.select(F.col("name").alias("_n"), F.col("action").alias("_a"))
    out = names.join(known, F.col("canonical") == F.col("_n"), "left")
    action = F.when(F.col("canonical").isNull(), "remove").when(F.col("_a").isNotNull(), F.col("_a")).when(F.col("ns") == 0, "remove").otherwise("expand")
    return out.withColumn("action", action).drop("_n", "_a")


def usage_counts(calls: DataFrame) -> DataFrame:
    """(name, direct, total) from calls (article, name, direct): those that an article writes, and all that come of them."""
    return calls.groupBy("name").agg(F.count_if("direct").alias("direct"), F.count("*").alias("total"))


def usage_summary(calls: DataFrame) -> DataFrame:
    """(templates, calls, direct, articles) over all calls (article, name, direct)."""
    return calls.agg(F.count_distinct("name").alias("templates"), F.count("*").alias("calls"), F.count_if("direct").alias("direct"), F.count_distinct("article").alias("articles"))


def substring_cover(counts: DataFrame, skip: int = 0, least: int = 4) -> DataFrame:
    """(weight, part, names): parts of template names and the templates that are left to each.

    Names in lower case between `^` and `$` are split at all but letters,
    digits and `_^$`; parts of `least` characters that several names have are
    weighted by the names' direct counts. Each name goes to its heaviest part;
    parts that keep several names stay.
    """
    if skip:
        ranked = numbered(counts.withColumn("_by", F.struct(-F.col("direct"), "name")), "_by", "_r")
        counts = ranked.where(F.col("_r") >= skip).drop("_by", "_r")
    parts = F.split(F.concat(F.lit("^"), F.lower("name"), F.lit("$")), "[^a-zA-Z0-9_^$]+")
    index = counts.select("name", "direct", F.explode(F.array_distinct(parts)).alias("part")).where(F.length("part") >= least)
    weights = index.groupBy("part").agg(F.sum("direct").alias("weight"), F.count("*").alias("n")).where("n > 1")
    best = F.row_number().over(Window.partitionBy("name").orderBy(F.col("weight").desc(), "part"))
    claimed = index.join(weights, "part").withColumn("_r", best).where("_r = 1")
    out = claimed.groupBy("part").agg(F.sum("direct").alias("weight"), F.sort_array(F.collect_list("name")).alias("names"))
    return out.where(F.size("names") > 1).select("weight", "part", "names")
