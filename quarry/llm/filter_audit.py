"""Interaction of filters: what each filter removes in every order of application.

Every filter is a condition of failure on a document; one more fails documents
whose text a smaller id has already. A left-semi join of the table with itself
on hash, exact text and smaller id marks the latter. Their ids, united with
those of the other failures, give the combination of filters that each document
fails. Combinations are counted, and all orders are worked out from the counts.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import join_hot, settle

#: Rows of one hash that meet in a task; larger groups are dealt into so many parts.
GROUP = 10_000
#: Hashes that repeat are sent to all tasks up to this size, else they are shuffled.
BROADCAST_BYTES = 32 << 20


def repeated_rows(rows: DataFrame) -> DataFrame:
    """The rows of `rows` (id, _h, text, and more) whose text a row of a smaller id has, too.

    `_h` is a hash of `text`, which is not null. A null id is no smaller id and
    has none. Only rows whose hash repeats travel with their texts; a group of
    copies is folded by each task before its first id is sent, and its rows
    are dealt into parts of about GROUP.
    """
    groups = settle(rows.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1"))
    if groups.count() * 16 <= BROADCAST_BYTES:
        copies = rows.join(F.broadcast(groups), "_h")
    else:
        copies = join_hot(rows, groups, ["_h"]).where("_n is not null")
    parts = F.ceil(F.col("_n") / GROUP).cast("int")
    firsts = copies.where("id is not null").groupBy("_h", "text").agg(F.min("id").alias("_first"), F.max("_n").alias("_n"))
    firsts = firsts.select("_h", "text", "_first", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_part"))
    dealt = copies.withColumn("_part", F.pmod(F.xxhash64("id"), parts).cast("int")).drop("_n")
    a, b = dealt.alias("a"), firsts.alias("b")
    same = (F.col("a._h") == F.col("b._h")) & (F.col("a._part") == F.col("b._part")) & (F.col("a.text") == F.col("b.text"))
    return a.join(b, same & (F.col("b._first") < F.col("a.id")), "left_semi").select(*rows.columns)


def combinations(docs: DataFrame, conditions: dict[str, Column], duplicates: str, part: Column, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part, failed, n, good, toxic): documents by the letters of the filters that they fail, in ascending order.

    `conditions` on the columns of `docs` have a letter each; `duplicates` is the letter of
    the filter on repeated texts. A null text is an empty one, a null part the empty string, a null condition no failure.
    Rows that share an id count each on their own. good and toxic count documents of
    which some row of `labels` has 1; rows without an id have no label.
    """
    bit = {k: 1 << i for i, k in enumerate(sorted([*conditions, duplicates]))}
    text = F.coalesce(F.col(text_col), F.lit(""))
    clean = docs.withColumn(text_col, text)
    bits = sum((F.when(c, bit[k]).otherwise(0) for k, c in conditions.items()), F.lit(0))
    rows = clean.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("_h"), F.coalesce(part, F.lit("")).alias("part"), F.col(text_col).alias("text"), bits.alias("bits"))
    again = repeated_rows(rows.drop("bits")).select("id", "_h", "part", F.lit(bit[duplicates]).alias("bits"), F.lit(0).alias("n"))
    failures = rows.select("id", "_h", "part", "bits", F.lit(1).alias("n")).unionByName(again)
    each = failures.groupBy("id", "_h", "part").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    # A hot id, and the rows without one, are a row for each combination from here on.
    each = each.groupBy("id", "part", "bits").agg(F.sum("n").alias("n"))
    known = labels.groupBy(F.col("doc_id").alias("id")).agg(F.max((F.col(good) == 1).cast("int")).alias("good"), F.max((F.col(toxic) == 1).cast("int")).alias("toxic"))
    told = each.join(known.where("id is not null"), "id", "left")
    failed = F.concat(*(F.when(F.col("bits").bitwiseAND(v) != 0, k).otherwise("") for k, v in bit.items()))
    counts = told.groupBy("part", "bits").agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")))
    return counts.select("part", failed.alias("failed"), "n", "good", "toxic")


def orders(counts: DataFrame, letters: str) -> DataFrame:
    """What every filter does in each order, from (part, failed, n, good, toxic).

    Gives a row, zeros included, for every part, order (filter_order) and step from 1:
    documents kept after the step, removed at it, redundant (they fail its
    filter, but are gone already), unique_fails (they fail it alone), good and toxic ones
    among the removed, and shapley: what its filter removes, summed over all orders.
    """
    every = ["".join(p) for p in itertools.permutations(sorted(letters))]
    rows = counts.withColumn("filter_order", F.explode(F.split(F.lit(",".join(every)), ",")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    letter = F.expr("substring(filter_order, step, 1)")
    fails = F.expr("instr(failed, substring(filter_order, step, 1)) > 0")
    gone = F.expr("translate(failed, substring(filter_order, 1, step - 1), '') <> failed")
    total = lambda condition, c="n": F.sum(F.when(condition, F.col(c)).otherwise(0)).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails).alias("kept"), total(~gone & fails).alias("removed"), total(gone & fails).alias("redundant"),
        total(F.col("failed") == letter).alias("unique_fails"), total(~gone & fails, "good").alias("good_lost"), total(~gone & fails, "toxic").alias("toxic_lost"),
        # A document goes by each filter that it fails in an equal share of the orders.
        F.sum(F.when(fails, F.expr(f"n * (div({len(every)}, length(failed)))")).otherwise(0)).cast("long").alias("shapley"),
    )


def words(text: Column) -> Column:
    """The words of a text, between ASCII white space."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def text_conditions(text: Column, words: Column) -> dict[str, Column]:
    """The four conditions of failure that look at a text and its words alone.

    A: under 200 words. B: less than half of the words are distinct, case counting. C: over 3 of 100
    characters are A-Z. D: it holds one of # $ % & * |.
    """
    n = F.length(text)
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * (n - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 3 * n,
        "D": text.rlike("[#$%&*|]"),
    }


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over `docs` (doc_id, text, lang), part by part of lang: see `combinations` and `orders`.
    An empty table has no part, so no row."""
    rows = docs.select("doc_id", "lang", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("words", words(F.col("text")))
    return orders(combinations(rows, text_conditions(F.col("text"), F.col("words")), "E", F.col("lang"), labels), "ABCDE")
