"""Sources of articles: dumps, plain files, lists, configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.charsets import VARIANTS, decoded
from quarry.operators.articles import redirect_target
from quarry.operators.common import numbered

PAGE = "title string, ns int, redirect struct<_title:string>, revision struct<text:struct<_VALUE:string>>"


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """(title, ns, raw, redirect_target) of an XML dump's pages."""
    pages = spark.read.format("xml").option("rowTag", "page").schema(PAGE).load(path)
    raw = F.coalesce(F.col("revision.text._VALUE"), F.lit(""))
    return pages.select("title", "ns", raw.alias("raw"), F.coalesce("redirect._title", redirect_target(raw)).alias("redirect_target"))


def read_running_text(spark: SparkSession, path: str, variant: str) -> DataFrame:
    """(path, lang, text) of files of running text in a language variant's charset, a file a row; empty files have none."""
    lang, charset = VARIANTS[variant]
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.lit(lang).alias("lang"), decoded(F.col("content"), charset).alias("text"))


def read_article_files(spark: SparkSession, path: str) -> DataFrame:
    """(title, markup) of plain files: the title, in `<article>` tags, is the first line."""
    files = spark.read.text(path, wholetext=True)
    first = F.split_part("value", F.lit("\n"), F.lit(1))
    return files.select(F.trim(F.regexp_replace(first, "</?article>", "")).alias("title"), F.regexp_replace("value", r"\A[^\n]*\n?", "").alias("markup"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(place, value): the lines of text files with their numbers from 0, by name of the file, then as they stand in it.

    A file may be read in many blocks: each task counts the lines of its own, and blocks are put in order by where they begin.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    return numbered(lines.withColumn("_by", F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("n"))), "_by", "place").select("place", "value")


def read_names(spark: SparkSession, path: str, drop_blank: bool = True) -> DataFrame:
    """(title) of a list, one name a line."""
    names = spark.read.text(path).select(F.trim("value").alias("title"))
    return names.where("title <> ''") if drop_blank else names


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """(ord, pattern, action) of a `_`-separated file whose first line is a header."""
    parts = F.split("value", "_")
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("ord", "value")).where("ord > 0")
    return rows.select("ord", F.trim(parts[0]).alias("pattern"), F.lower(F.trim(F.get(parts, F.lit(1)))).alias("action")).where("pattern <> '' and action <> ''")


def read_node_rules(spark: SparkSession, path: str) -> DataFrame:
    """(name, action, start, end, separator, parameters) of a tab-separated file whose first line is a header.

    Rows without name or action are notes. Without a start mark, kept nodes get
    `<Name>` and `</Name>`, replaced ones `<Name />`, others nothing; a start
    mark alone has no end mark. `markup.rules_of` makes rules of the rows.
    """
    parts = F.split("value", "\t")
    cell = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(""))
    rows = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("_n", "value")).where("_n > 0")
    rows = rows.select(F.trim(cell(0)).alias("name"), F.lower(F.trim(cell(1))).alias("action"), *(F.trim(cell(i)).alias(c) for i, c in ((2, "start"), (3, "end"), (4, "separator"))), F.filter(F.slice(parts, 6, 100), lambda p: F.trim(p) != "").alias("parameters"))
    rows = rows.where(F.col("action").isin("keep", "remove", "purge", "replace") & (F.col("name") != ""))
    bare, kept = F.col("start") == "", F.col("action") == "keep"
    start = F.when(bare & kept, F.concat(F.lit("<"), "name", F.lit(">"))).when(bare & (F.col("action") == "replace"), F.concat(F.lit("<"), "name", F.lit(" />"))).otherwise(F.col("start"))
    end = F.when((F.col("end") == "") & bare & kept, F.concat(F.lit("</"), "name", F.lit(">"))).otherwise(F.col("end"))
    return rows.select("name", "action", start.alias("start"), end.alias("end"), "separator", F.transform("parameters", F.trim).alias("parameters"))


def read_config(text: str, folder: str = "") -> dict[str, str]:
    """`key = value` lines; all after `#` is a comment. With `folder`, values are paths in it unless they are absolute."""
    out = {}
    for line in text.splitlines():
        key, eq, value = line.split("#", 1)[0].partition("=")
        if eq and key.strip():
            value = value.strip()
            out[key.strip()] = value if not folder or value.startswith("/") or "://" in value else f"{folder.rstrip('/')}/{value}"
    return out


def read_siteinfo(spark: SparkSession, path: str) -> DataFrame:
    """(ns, name) of the namespaces in a site's JSON description."""
    site = spark.read.schema("query struct<namespaces:map<string,struct<id:int,`*`:string>>>").option("multiLine", True).json(path)
    return site.select(F.explode(F.map_values("query.namespaces")).alias("n")).select(F.col("n.id").alias("ns"), F.col("n.`*`").alias("name"))
