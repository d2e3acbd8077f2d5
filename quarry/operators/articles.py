"""Articles as rows: listing, look-up, namespaces, redirects, set difference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.common import join_hot, numbered, tabled

#: A page that only points to another one: the target stands in the first group.
REDIRECT = r"(?i)^\s*#redirect(?:ion)?\s*:?\s*\[\[\s*([^\]|#]*?)\s*(?:[#|][^\]]*)?\]\]"

FIRST_ARTICLE, FIRST_SEGMENT, ARTICLES_PER_SEGMENT = 100, 101, 1_000


def redirect_target(raw: Column) -> Column:
    """The page that a redirect points to, else null."""
    return F.when(raw.rlike(REDIRECT), F.regexp_extract(raw, REDIRECT, 1))


def split_name(name: Column, namespaces: dict[str, int]) -> Column:
    """(ns, local) of a page name: known prefixes before the first colon are namespaces, all else is in 0."""
    prefix = F.lower(F.trim(F.split_part(name, F.lit(":"), F.lit(1))))
    number = F.create_map(*[F.lit(x) for k, v in namespaces.items() for x in (k.lower(), v)])[prefix] if namespaces else F.lit(None)
    in_ns = name.contains(":") & number.isNotNull()
    return F.struct(F.when(in_ns, number).otherwise(0).alias("ns"), F.when(in_ns, F.trim(F.regexp_replace(name, "^[^:]*:", ""))).otherwise(name).alias("local"))


def list_articles(pages: DataFrame, limit: int | None = None, seed: int | None = None) -> DataFrame:
    """Titles of main-namespace pages that are no redirects; with `seed` in random order, with `limit` so many."""
    found = pages.where((F.col("ns") == 0) & redirect_target(F.col("raw")).isNull()).select("title")
    if seed is not None:
        found = found.orderBy(F.xxhash64(F.col("title"), F.lit(seed)))
    return found if limit is None else found.limit(limit)


def markup_of(pages: DataFrame, title: str) -> DataFrame:
    """The raw text of one page; a look-up that the scan's filters serve."""
    return pages.where(F.col("title") == title).select("title", "raw")


def without(articles: DataFrame, unwanted: DataFrame, on: str = "title") -> DataFrame:
    """Articles that aren't listed."""
    return articles.join(unwanted.select(on).distinct(), on, "left_anti")


def only(articles: DataFrame, wanted: DataFrame, on: str = "title") -> DataFrame:
    """Listed names with their articles; a name listed twice comes twice, an unknown one has nulls."""
    return wanted.select(on).join(articles, on, "left")


def follow_redirect(pages: DataFrame) -> DataFrame:
    """Each page with the text of the page it points to: one step, as many redirects as may follow."""
    target = pages.select(F.col("title").alias("_target"), F.col("raw").alias("_raw"))
    out = pages.withColumn("_to", redirect_target(F.col("raw"))).join(target, F.col("_to") == F.col("_target"), "left")
    return out.withColumn("raw", F.when(F.col("_to").isNull(), F.col("raw")).otherwise(F.col("_raw"))).drop("_to", "_target", "_raw")


def resolve_redirects(redirects: DataFrame, rounds: int = 64) -> DataFrame:
    """(src, final, broken) for every redirect (src, dst): the end of its chain.

    A source of several redirects takes the least. Each round doubles the length of the chains that are followed, and takes
    those that have come to their end out. A chain of n redirects also has
    one of every lesser length at its end, so when a round ends none, all that
    are left run in a circle, or into one: final is null and broken true. The number of
    rounds grows with the logarithm of the longest chain that has an end.
    """
    hops = redirects.groupBy("src").agg(F.min("dst").alias("dst")).where("src is not null")
    sources = hops.select(F.col("src").alias("dst"), F.lit(True).alias("_more"))
    state = tabled(join_hot(hops, sources, ["dst"]).select("src", "dst", F.col("_more").isNull().alias("ended")))
    ended, active = [state.where("ended")], state.where("not ended")
    for _ in range(rounds):
        known = reduce(DataFrame.unionByName, [*ended, active]).select(F.col("src").alias("dst"), F.col("dst").alias("_dst"), F.col("ended").alias("_ended"))
        moved = tabled(join_hot(active.select("src", "dst"), known, ["dst"]).select("src", F.col("_dst").alias("dst"), F.col("_ended").alias("ended")))
        active = moved.where("not ended")
        if moved.where("ended").isEmpty():
            break
        ended.append(moved.where("ended"))
    found = reduce(DataFrame.unionByName, ended).select("src", F.col("dst").alias("final"), F.lit(False).alias("broken"))
    return found.unionByName(active.select("src", F.lit(None).cast(found.schema["final"].dataType).alias("final"), F.lit(True).alias("broken")))


def namespace_counts(pages: DataFrame, namespaces: DataFrame) -> DataFrame:
    """(ns, pages, redirects) for every known namespace, also those without pages. `pages` has ns and is_redirect."""
    counts = pages.groupBy("ns").agg(F.count_if(~F.col("is_redirect")).alias("pages"), F.count_if("is_redirect").alias("redirects"))
    zero = F.lit(0).cast("long")
    return namespaces.select("ns").join(counts, "ns", "left").select("ns", F.coalesce("pages", zero).alias("pages"), F.coalesce("redirects", zero).alias("redirects"))


def multiset_difference(rows: DataFrame, unwanted: DataFrame, on: str, order: str) -> DataFrame:
    """`rows` less one copy for each equal row of `unwanted`, the first copies by `order`."""
    counts = unwanted.groupBy(on).agg(F.count("*").alias("_n"))
    # Copies are numbered over sorted ranges, so that those of a common row are shared out.
    copies = numbered(rows.withColumn("_by", F.struct(on, order)), "_by", "_copy").drop("_by")
    ends = copies.groupBy(on).agg(F.min("_copy").alias("_first")).join(counts, on).select(on, (F.col("_first") + F.col("_n")).alias("_end"))
    return copies.join(ends, on, "left").where(F.col("_copy") >= F.coalesce("_end", F.lit(0))).drop("_copy", "_end")


def article_ids(articles: DataFrame, title: str = "title", text: str = "text") -> DataFrame:
    """Articles whose text isn't blank, with art_id and seg: numbers follow the titles' order, a segment holds 1,000 articles."""
    out = numbered(articles.where(~F.col(text).rlike(r"^\s*$")), title)
    art = (F.col("ordinal") + FIRST_ARTICLE).alias("art_id")
    return out.select("*", art, (F.floor(F.col("ordinal") / ARTICLES_PER_SEGMENT) + FIRST_SEGMENT).cast("long").alias("seg")).drop("ordinal")


def corpus_lines(articles: DataFrame, sentences: Column) -> DataFrame:
    """(seg, art_id, sent_id, line): each sentence behind its number; sentence numbers go in tens."""
    out = articles.select("seg", "art_id", F.posexplode(sentences).alias("pos", "sentence"))
    sent = (F.col("pos") * 10).cast("long")
    return out.select("seg", "art_id", sent.alias("sent_id"), F.format_string("[1%07d%05d] |%s", "art_id", sent, "sentence").alias("line"))


def write_corpus(lines: DataFrame, path: str) -> None:
    """One folder of gzipped text for each segment, lines in order."""
    ordered = lines.repartition("seg").sortWithinPartitions("seg", "art_id", "sent_id")
    ordered.select(F.format_string("%05d", "seg").alias("seg"), "line").write.partitionBy("seg").option("compression", "gzip").mode("overwrite").text(path)


def without_title_mark(articles: DataFrame, text: str = "text", mark: str = "⌊δ") -> DataFrame:
    """(articles, missing): how many articles have text, and how many of these lack the mark of their title: a check of what is written."""
    full = F.length(text) > 0
    return articles.agg(F.count_if(full).alias("articles"), F.count_if(full & ~F.contains(F.col(text), F.lit(mark))).alias("missing"))
