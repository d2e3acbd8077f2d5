"""Ordered sections of articles: outline filters, labels, heading statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import exploded, normalised_heading

# Titles that end an article's useful part, and titles that are dropped where they come last.
ENDING_TITLES = ("^related web sites", "^external links", "^bibliography", "^footnotes")
CLOSING_TITLES = ("^see also$", "^notes.*", "^references.*", "^sources.*")
#: Of a closing title only the last occurrence, or the fourth, ends an article.
CLOSING_MEMORY = 3
# Titles whose label doesn't depend on statistics.
DIRTY_TITLES = ("Deaths", "Births", "Publications")
OTHER_TITLES = ("Awards", "Geography", "Education", "Transportation", "Personal life", "Family", "Trivia", "Results", "People", "Achievments", "Transport")
CLEAN_PARAGRAPHS, DIRTY_COUNT, DIRTY_LENGTH = 4, 5_000, 750
# Fixed patterns of files of sections.
HEADING_LINE = r"^<h[1-6]>.*</h[1-6]>$"
EXPLODED_HEADING_LINE = r"^< h [1-6] >.*< / h [1-6] >$"
DELIMITER, LABEL_LINE = "-" * 54, r"^\[\d+\] (clean|dirty): $"


def line_sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines of a text as sections: the first is the article, the others have a level from 2 to 5 by their length."""
    out = docs.select(id_col, F.posexplode(F.split(text_col, "\n")).alias("sec_idx", "content"))
    level = F.when(F.col("sec_idx") == 0, 1).otherwise(2 + F.length("content") % 4)
    return out.select(id_col, "sec_idx", level.cast("int").alias("level"), F.split_part("content", F.lit(" "), F.lit(1)).alias("title"), "content")


def heading_stats(sections: DataFrame, heading: str = "title", content: str = "content") -> DataFrame:
    """(heading, count, avg_len): how often a heading occurs, and the mean length under it, rounded down."""
    out = sections.groupBy(normalised_heading(F.col(heading)).alias("heading")).agg(F.count("*").alias("count"), F.sum(F.length(content)).alias("_sum"))
    return out.select("heading", "count", F.expr("_sum div count").alias("avg_len"))


def retain_headings(sections: DataFrame, article: str) -> DataFrame:
    """`sprint`: whether a section or its heading is printed.

    Clean sections that have content are printed. Of the others those headings
    are that lead to one: from the end of the article back, a heading is kept
    if its level is under that of all sections since the last clean one.
    """
    back = Window.partitionBy(article).orderBy(F.col("sec_idx").desc())
    useful = F.col("clean") & (F.length("content") > 0)
    out = sections.withColumn("_c", F.coalesce(useful, F.lit(False)))
    out = out.withColumn("_g", F.sum(F.col("_c").cast("int")).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    since = Window.partitionBy(article, "_g").orderBy(F.col("sec_idx").desc()).rowsBetween(Window.unboundedPreceding, -1)
    leads = (F.col("_g") > 0) & ((F.col("sec_idx") == 0) | (F.col("level") < F.min("level").over(since)))
    return out.withColumn("sprint", F.col("_c") | F.coalesce(leads, F.lit(False))).drop("_c", "_g")


def title_state(title: Column) -> Column:
    """`c`, `p` for titles that end the article, or `d:` and the number of the closing title."""
    title = F.lower(F.trim(title))
    state = F.lit("c")
    for pattern in ENDING_TITLES:
        state = F.when(title.rlike(pattern), "p").otherwise(state)
    for k, pattern in enumerate(CLOSING_TITLES):
        state = F.when(title.rlike(pattern), f"d:{k}").otherwise(state)
    return state


def cut_closing(sections: DataFrame, article: str) -> DataFrame:
    """`kept`: whether a section stands before the first title that ends its article."""
    out = sections.withColumn("_state", title_state(F.col("title")))
    same = Window.partitionBy(article, "_state")
    number, total = F.row_number().over(same.orderBy("sec_idx")), F.count("*").over(same)
    out = out.withColumn("_number", number).withColumn("_total", total)
    ends = (F.col("_state") == "p") | (F.col("_state").startswith("d:") & (F.col("_number") >= F.least(F.lit(CLOSING_MEMORY + 1), "_total")))
    upto = Window.partitionBy(article).orderBy("sec_idx").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("_end", ends.cast("int")).withColumn("kept", F.sum("_end").over(upto) == 0).drop("_state", "_number", "_total", "_end")


def training_labels(sections: DataFrame, stats: DataFrame, rare: int = 1, common: int = DIRTY_COUNT, short: int = DIRTY_LENGTH, paragraphs: int = CLEAN_PARAGRAPHS) -> DataFrame:
    """`clean` and `dirty` of sections with title, content and n_par.

    Clean: a heading that occurs once at most and enough paragraphs. Dirty: by
    title, or a heading of many short sections, if there is any content.
    """
    known = stats.select(F.col("heading").alias("_h"), F.col("count").alias("_n"), F.col("avg_len").alias("_len"))
    out = sections.join(known, normalised_heading(F.col("title")) == F.col("_h"), "left")
    has = F.col("_h").isNotNull()
    clean = has & (F.col("_n") <= rare) & (F.col("n_par") >= paragraphs)
    by_count = has & ~F.col("content").rlike(r"^\s*$") & (F.col("_n") > common) & (F.col("_len") < short)
    dirty = F.when(F.col("title").isin(*DIRTY_TITLES), True).when(F.col("title").isin(*OTHER_TITLES), False).otherwise(by_count)
    return out.withColumn("clean", F.coalesce(clean, F.lit(False))).withColumn("dirty", F.coalesce(dirty, F.lit(False))).drop("_h", "_n", "_len")


def limits_of(stats: DataFrame, common: float = 0.99, short: float = 0.5) -> dict[str, int]:
    """Limits for `training_labels` that follow from the headings themselves: the count that the share `common` of all headings doesn't
    exceed, and the average length that the share `short` of those of a greater count doesn't exceed. No limits without headings."""
    at = lambda c, q: f"percentile_disc({q}) WITHIN GROUP (ORDER BY {c})"
    count = stats.agg(F.expr(at("count", common))).first()[0]
    if count is None:
        return {}
    length = stats.where(F.col("count") > count).agg(F.expr(at("avg_len", short))).first()[0]
    return {"common": int(count)} | ({} if length is None else {"short": int(length) + 1})


def is_exploded(lines: DataFrame) -> Column:
    """For use in an aggregate over lines (line_no, line): true or false by the first heading line, null without any."""
    kind = F.when(F.col("line").rlike(HEADING_LINE), False).when(F.col("line").rlike(EXPLODED_HEADING_LINE), True)
    return F.min_by(kind, F.when(kind.isNotNull(), F.col("line_no")))


def islands(lines: DataFrame, group: str, pattern: str = EXPLODED_HEADING_LINE, drop_marks: bool = False) -> DataFrame:
    """(group, island, text): runs of lines, each heading line beginning one. With
    `drop_marks`, delimiters and label lines of an unexploded file are left out."""
    if drop_marks:
        lines = lines.where(~F.col("line").contains(DELIMITER) & ~F.col("line").rlike(LABEL_LINE))
    upto = Window.partitionBy(group).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    out = lines.withColumn("island", F.sum(F.col("line").rlike(pattern).cast("long")).over(upto))
    rows = out.groupBy(group, "island").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_rows"))
    return rows.select(group, "island", F.array_join(F.transform("_rows", lambda r: r["line"]), "\n").alias("text"))


def file_sections(lines: DataFrame, group: str) -> DataFrame:
    """(group, island, text) of files of sections (group, line_no, line), each read as its first heading line says: exploded, or not (so are files without any)."""
    kinds = lines.groupBy(group).agg(is_exploded(lines).alias("_exploded"))
    told = lines.join(kinds, group)
    done = islands(told.where("_exploded"), group)
    plain = islands(told.where(~F.coalesce("_exploded", F.lit(False))), group, HEADING_LINE, drop_marks=True)
    return done.unionByName(plain.withColumn("text", F.array_join(F.transform(F.split("text", "\n"), exploded), "\n")))


def character_totals(sections: DataFrame, content: str = "content") -> DataFrame:
    """(clean, dirty): the characters of clean and of dirty sections."""
    size = lambda flag: F.coalesce(F.sum(F.when(F.col(flag), F.length(content))), F.lit(0)).cast("long").alias(flag)
    return sections.agg(size("clean"), size("dirty"))
