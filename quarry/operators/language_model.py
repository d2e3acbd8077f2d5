"""Character n-gram language models: counting, smoothing, scoring, evaluation.

A model is a DataFrame (ord, ngram, logp, bow) with logarithms to base 10;
symbols of an n-gram are joined by blanks. Only relational steps are used, so
that a model may be larger than any machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.packed_model import longest_counts, text_codes
from quarry.functions.text import characters, symbol
from quarry.operators.common import join_hot, settle, short_batches

START, END, UNKNOWN = "<s>", "</s>", "<unk>"
METHODS = ("additive", "witten_bell", "absolute", "kneser_ney", "modified_kneser_ney")
#: ASCII white space holds no symbol; other blanks are symbols through their escapes.
BLANK = r"[\x09-\x0d\x1c-\x20]"


def symbols(line: Column) -> Column:
    """`<s>`, the line's characters other than ASCII white space, `</s>`."""
    found = characters(F.regexp_replace(line, BLANK, ""))
    # ASCII characters are their own symbols.
    return F.concat(F.array(F.lit(START)), F.when(line.rlike(r"\A[\x00-\x7f]*\z"), found).otherwise(F.transform(found, symbol)), F.array(F.lit(END)))


def line_symbols(texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, w): the symbols of each line of a text. An empty text has no line; empty lines between others have `<s> </s>`."""
    rows = texts.where(F.length(text) > 0).select(key, F.explode(F.split(text, "\n", -1)).alias("line"))
    return rows.select(key, symbols(F.col("line")).alias("w"))


def scored_ngrams(rows: DataFrame, key: str, order: int) -> DataFrame:
    """(key, ngram, n): for each symbol after `<s>` the longest n-gram up to `order` that ends there, with counts."""
    return rows.select(key, F.explode(_longest(order)).alias("ngram")).groupBy(key, "ngram").agg(F.count("*").alias("n"))


def _longest(order: int) -> Column:
    """For each symbol of a line after `<s>` the longest n-gram up to `order` that ends there."""
    # Single look-ups: a slice would copy the line for each symbol. What lies before the line is null, which isn't joined.
    return F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", *(F.get(F.col("w"), i - k) for k in range(order - 1, -1, -1))))


def ngram_counts(rows: DataFrame, order: int) -> DataFrame:
    """(ord, ngram, c) of all n-grams up to `order`, without `<s>` alone.

    Lines give one n-gram for each symbol; the shorter ones are the ends of
    these, and counted from the distinct ones.
    """
    return _all_lengths(rows.select(F.explode(_longest(order)).alias("ngram")).groupBy("ngram").agg(F.count("*").alias("c")))


def _all_lengths(longest: DataFrame) -> DataFrame:
    return longest.select(F.explode(_ends(F.col("ngram"))).alias("x"), "c").groupBy("x.ord", "x.ngram").agg(F.sum("c").alias("c")).select("ord", "ngram", "c")


def text_ngram_counts(texts: DataFrame, order: int, by: str, text: str = "text") -> DataFrame:
    """(`by`, ord, ngram, c): what `ngram_counts` gives for the lines of the texts of each value of `by`, in one pass over all of them.

    A task counts the symbols of a batch as arrays, so that only its different n-grams leave it.
    """
    short_batches(texts.sparkSession)
    kind = texts.schema[by].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of: dict = {}
            for value, t in zip(b.column(0).to_pylist(), b.column(1)):
                if t := t.as_py():
                    of.setdefault(value, []).append(text_codes(t))
            for value, codes in of.items():
                grams, counts = longest_counts(np.concatenate(codes), order)
                yield pa.RecordBatch.from_arrays([pa.array([value] * len(grams), b.column(0).type), pa.array(grams, pa.string()), pa.array(counts, pa.int64())], [by, "ngram", "c"])

    longest = texts.select(by, text).mapInArrow(run, f"`{by}` {kind}, ngram string, c long").groupBy(by, "ngram").agg(F.sum("c").alias("c"))
    return longest.select(by, F.explode(_ends(F.col("ngram"))).alias("x"), "c").groupBy(by, "x.ord", "x.ngram").agg(F.sum("c").alias("c")).select(by, "ord", "ngram", "c")


def _ends(ngram: Column) -> Column:
    """(ord, ngram) of the ends of an n-gram, itself among them."""
    size = F.length(ngram) - F.length(F.replace(ngram, F.lit(" "), F.lit(""))) + 1
    return F.transform(F.sequence(F.lit(1), size), lambda k: F.struct(k.alias("ord"), F.call_function("substring_index", ngram, F.lit(" "), -k).alias("ngram")))


def _context(ngram: Column) -> Column:
    return F.substring(ngram, F.lit(1), F.length(ngram) - F.length(F.substring_index(ngram, " ", -1)) - 1)


def _suffix(ngram: Column) -> Column:
    blank = F.instr(ngram, " ")
    return F.when(blank == 0, "").otherwise(F.substring(ngram, blank + 1, F.length(ngram)))


def _sorted(table: DataFrame) -> DataFrame:
    """For a join: `table` is never broadcast. Sizes are estimated from texts, and don't know how many n-grams come of them."""
    return table.hint("merge")


def continuation_counts(counts: DataFrame, order: int) -> DataFrame:
    """Counts for Kneser-Ney: below the highest order the number of symbols seen
    before an n-gram; n-grams that begin a line keep their counts."""
    before = counts.where(F.col("ord") > 1).select((F.col("ord") - 1).alias("ord"), _suffix(F.col("ngram")).alias("ngram"))
    before = before.groupBy("ord", "ngram").agg(F.count("*").alias("t"))
    out = counts.join(_sorted(before), ["ord", "ngram"], "left")
    keep = (F.col("ord") == order) | F.col("ngram").startswith(START)
    return out.select("ord", "ngram", F.when(keep, F.col("c")).otherwise(F.coalesce("t", F.col("c"))).cast("long").alias("c"))


def _counts_of_counts(c: Column) -> list[Column]:
    return [F.count_if(c == i).cast("double") for i in range(1, 5)]


def _three_discounts(n: list[Column], modified: bool) -> list[Column]:
    """The discounts of counts 1, 2 and more by the counts of counts 1 to 4; where these are lacking, 0.5."""
    y = n[0] / (n[0] + 2 * n[1])
    ok = (n[0] > 0) & (n[1] > 0)
    flat = F.when(ok, y).otherwise(0.5)
    if not modified:
        return [flat] * 3
    ok3, ok4 = ok & (n[2] > 0), ok & (n[2] > 0) & (n[3] > 0)
    d1 = F.when(ok, 1 - 2 * y * n[1] / n[0]).otherwise(flat)
    d2 = F.when(ok3, 2 - 3 * y * n[2] / F.nullif(n[1], F.lit(0.0))).otherwise(flat)
    d3 = F.when(ok4, 3 - 4 * y * n[3] / F.nullif(n[2], F.lit(0.0))).otherwise(flat)
    # A negative discount would raise a probability: the single discount serves then.
    return [F.when(d >= 0, d).otherwise(flat) for d in (d1, d2, d3)]


def _discounts(counts: DataFrame, modified: bool) -> DataFrame:
    """(ord, d1, d2, d3): the discounts of each order."""
    n = counts.groupBy("ord").agg(*(x.alias(f"n{i}") for i, x in enumerate(_counts_of_counts(F.col("c")), 1)))
    return n.select("ord", *(d.alias(f"d{i}") for i, d in enumerate(_three_discounts([F.col(f"n{i}") for i in range(1, 5)], modified), 1)))


def train(rows: DataFrame, order: int, method: str) -> DataFrame:
    """The model (ord, ngram, logp, bow) of lines of symbols (w).

    additive: (c + 1) / (c(h) + V); absolute: (c - 1) / c(h); witten_bell:
    c / (c(h) + T(h)); kneser_ney and modified_kneser_ney: c less a discount
    from counts of counts, lower orders by continuation counts. V counts the
    symbols, `</s>` and `<unk>`; what single symbols leave goes to `<unk>`.
    N-grams without probability are left out. bow spreads what a context's
    n-grams leave over those of the next lower order.
    """
    return train_counts(ngram_counts(rows, order), order, method)


def train_counts(counts: DataFrame, order: int, method: str) -> DataFrame:
    """As `train`, of counts (ord, ngram, c)."""
    if method not in METHODS:
        raise ValueError(method)
    # Counts are used many times over; they are kept, so that texts are read once.
    counts = settle(counts)
    if method.endswith("kneser_ney"):
        counts = settle(continuation_counts(counts, order))
    counts = counts.withColumn("h", _context(F.col("ngram")))
    totals = counts.groupBy("ord", "h").agg(F.sum("c").alias("ch"), F.count("*").alias("types"))
    if method == "additive":
        v = counts.where("ord = 1").agg((F.count("*") + 1).alias("v"))
        p = (F.col("c") + 1) / (F.col("ch") + F.col("v"))
        joined = counts.join(_sorted(totals), ["ord", "h"]).crossJoin(F.broadcast(v))
    elif method == "witten_bell":
        p = F.col("c") / (F.col("ch") + F.col("types"))
        joined = counts.join(_sorted(totals), ["ord", "h"])
    elif method == "absolute":
        p = F.greatest(F.col("c") - 1, F.lit(0)) / F.col("ch")
        joined = counts.join(_sorted(totals), ["ord", "h"])
    else:
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        p = F.greatest(F.col("c") - d, F.lit(0.0)) / F.col("ch")
        joined = counts.join(_sorted(totals), ["ord", "h"]).join(F.broadcast(_discounts(counts, method.startswith("modified"))), "ord")
    probs = settle(joined.select("ord", "ngram", "h", p.alias("p")).where("p > 0"))
    rest = F.greatest(1 - F.coalesce(F.sum("p"), F.lit(0.0)), F.lit(1e-12))
    unknown = probs.where("ord = 1").agg(rest.alias("p")).select(F.lit(1).alias("ord"), F.lit(UNKNOWN).alias("ngram"), F.lit("").alias("h"), "p")
    probs = probs.unionByName(unknown)
    lower = probs.select((F.col("ord") + 1).alias("ord"), F.col("ngram").alias("s"), F.col("p").alias("q"))
    mass = probs.where("ord > 1").withColumn("s", _suffix(F.col("ngram"))).join(_sorted(lower), ["ord", "s"], "left")
    mass = mass.groupBy("ord", "h").agg(F.sum("p").alias("sp"), F.sum(F.coalesce("q", F.lit(0.0))).alias("sq"))
    bow = mass.select((F.col("ord") - 1).alias("ord"), F.col("h").alias("ngram"), (F.greatest(1 - F.col("sp"), F.lit(1e-12)) / F.greatest(1 - F.col("sq"), F.lit(1e-12))).alias("b"))
    out = probs.join(_sorted(bow), ["ord", "ngram"], "full")
    return settle(out.select("ord", "ngram", F.log10("p").alias("logp"), F.log10(F.coalesce("b", F.lit(1.0))).alias("bow")))


def ngram_scores(grams: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """(ngram, logp) for distinct `grams` (ngram): the longest suffix that the
    model has, plus the weights of the longer contexts; the last symbol as
    `<unk>` where even that is unknown.

    One join: every n-gram sends its suffixes and contexts as keys. The score
    of `<unk>` is one value, which comes after the join.
    """
    w = F.split("ngram", " ")
    size = F.size(w)
    suffix = F.transform(F.sequence(F.lit(1), size), lambda k: F.struct(k.alias("k"), F.lit("p").alias("use"), F.array_join(F.slice(w, size - k + 1, k), " ").alias("key")))
    context = F.transform(F.sequence(F.lit(1), F.greatest(size - 1, F.lit(1))), lambda k: F.struct((k + 1).alias("k"), F.lit("b").alias("use"), F.array_join(F.slice(w, size - k, k), " ").alias("key")))
    keys = F.concat(suffix, F.when(size > 1, context).otherwise(F.array().cast("array<struct<k:int,use:string,key:string>>")))
    unknown = model.where((F.col("ord") == 1) & (F.col("ngram") == UNKNOWN)).agg(F.max("logp").alias("_unknown"))
    rows = grams.select("ngram", F.explode(keys).alias("x")).select("ngram", "x.k", "x.use", "x.key")
    table = model.select(F.col("ngram").alias("key"), "logp", "bow")
    hit = rows.join(table, "key", "left")
    best = F.max(F.when((F.col("use") == "p") & F.col("logp").isNotNull(), F.struct("k", "logp")))
    weights = F.collect_list(F.when((F.col("use") == "b") & F.col("bow").isNotNull(), F.struct("k", "bow")))
    found = hit.groupBy("ngram").agg(best.alias("best"), weights.alias("weights")).crossJoin(F.broadcast(unknown))
    # With the last symbol unknown, the context of one symbol backs off as well.
    more = F.aggregate(F.filter("weights", lambda x: x["k"] > F.coalesce(F.col("best.k"), F.lit(0))), F.lit(0.0), lambda a, x: a + x["bow"])
    return found.select("ngram", (F.coalesce("best.logp", "_unknown") + more).alias("logp"))


def text_scores(texts: DataFrame, model: DataFrame, order: int, key: str = "key", text: str = "text") -> DataFrame:
    """(key, logp, n): the sum of log10 probabilities of a text's symbols and line ends, and their number; 0 for an empty text."""
    grams = settle(scored_ngrams(line_symbols(texts, key, text), key, order))
    scores = ngram_scores(grams.select("ngram").distinct(), model, order)
    sums = join_hot(grams, scores, ["ngram"]).groupBy(key).agg(F.sum(F.col("n") * F.col("logp")).alias("logp"), F.sum("n").alias("n"))
    return texts.select(key).join(sums, key, "left").select(key, F.coalesce("logp", F.lit(0.0)).alias("logp"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def classify(texts: DataFrame, clean: DataFrame, dirty: DataFrame, order: int, key: str = "key", text: str = "text") -> DataFrame:
    """(key, score, is_clean): the difference of the clean and the dirty model's
    log probability. Clean is over 0; an empty text scores 0 and is dirty."""
    grams = settle(scored_ngrams(line_symbols(texts, key, text), key, order))
    distinct = grams.select("ngram").distinct()
    c, d = ngram_scores(distinct, clean, order), ngram_scores(distinct, dirty, order)
    delta = c.withColumnRenamed("logp", "lc").join(d.withColumnRenamed("logp", "ld"), "ngram").select("ngram", (F.col("lc") - F.col("ld")).alias("delta"))
    sums = join_hot(grams, delta, ["ngram"]).groupBy(key).agg(F.sum(F.col("n") * F.col("delta")).alias("score"))
    out = texts.select(key, text).join(sums, key, "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    return out.select(key, "score", ((F.col("score") > 0) & (F.length(text) > 0)).alias("is_clean"))


def perplexity(texts: DataFrame, model: DataFrame, order: int, key: str = "key", text: str = "text") -> DataFrame:
    """(symbols, logp, ppl) over all texts."""
    scores = text_scores(texts, model, order, key, text)
    out = scores.agg(F.sum("n").alias("symbols"), F.sum("logp").alias("logp"))
    return out.select("symbols", "logp", F.pow(F.lit(10.0), -F.col("logp") / F.nullif(F.col("symbols"), F.lit(0))).alias("ppl"))


def accuracy(scores: DataFrame) -> DataFrame:
    """(total, right) from (is_clean_label, score): clean ones score over 0, dirty ones under; a tie is wrong in both."""
    right = F.when(F.col("label_clean"), F.col("score") > 0).otherwise(F.col("score") < 0)
    return scores.agg(F.count("*").alias("total"), F.count_if(right).alias("right"))


def sign_test(wins: Column, differing: Column) -> Column:
    """One-sided binomial probability of at least `wins` of `differing` fair trials.

    The tail is summed from its greatest term on, each term from the one before; of the lesser half of the
    trials the other tail is taken. Terms beyond twelve square roots of the trials are too small
    to count, so that a billion trials take as little memory as a thousand.
    """
    m, w = differing.cast("double"), wins.cast("double")
    upper = 2 * w > m
    k = F.when(upper, w).otherwise(m - w + 1)
    n = F.least(m - k, F.ceil(12 * F.sqrt(m)) + 60).cast("int")
    start = F.struct(F.lit(1.0).alias("term"), F.lit(0.0).alias("sum"))

    def step(a: Column, j: Column) -> Column:
        term = F.when(j == 0, 1.0).otherwise(a["term"] * (m - k - j + 1) / (k + j))
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"))

    tail = F.exp(_log_share(m, k)) * F.aggregate(F.sequence(F.lit(0), F.greatest(n, F.lit(0))), start, step)["sum"]
    return F.when(w <= 0, 1.0).when(w > m, 0.0).when(upper, tail).otherwise(1 - tail)


def _log_share(m: Column, k: Column) -> Column:
    """Logarithm of the share of exactly k wins of m fair trials. With many of both, by Stirling's series around a half, where great terms cancel out before they are worked out."""
    few = _lgamma(m + 1) - _lgamma(k + 1) - _lgamma(m - k + 1) - m * F.log(F.lit(2.0))
    d = (2 * k - m) / m
    off = m / 2 * ((1 + d) * F.log1p(d) + (1 - d) * F.log1p(-d))
    rest = 1 / (12 * m) - 1 / (12 * k) - 1 / (12 * (m - k)) - 1 / (360 * F.pow(m, F.lit(3.0))) + 1 / (360 * F.pow(k, F.lit(3.0))) + 1 / (360 * F.pow(m - k, F.lit(3.0)))
    return F.when((m - k > 32) & (k > 32), rest - off - 0.5 * F.log(6.283185307179586 * k * (m - k) / m)).otherwise(few)


def _lgamma(x: Column) -> Column:
    """Logarithm of (x - 1)! for whole x >= 1: exact sums up to 32, Stirling's series beyond."""
    y = x.cast("double")
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3.0))) + 1 / (1260 * F.pow(y, F.lit(5.0)))
    exact = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(x - 1, F.lit(32)), F.lit(1)).cast("int")), F.lit(0.0), lambda a, k: a + F.log(k.cast("double")))
    return F.when(x <= 33, exact).otherwise(series)


def significance(p: Column) -> Column:
    return F.when(p <= 0.005, "**").when(p <= 0.05, "*").otherwise("")


#: More training sets than this, times orders, have no place in one grid: their figures are broadcast.
GRID_FIGURES = 100_000


def grid(rows: DataFrame, orders: tuple[int, ...], methods: tuple[str, ...] = METHODS, by: str | None = None) -> DataFrame:
    """(method, max_order, ord, ngram, logp, bow): the models that `train` gives for every order and method, and with
    `by` (a column of `rows`, which comes first) for every training set.

    N-grams are counted once, up to the highest order. Probabilities of a length and what a context of that length
    leaves are the same in all orders beyond it; only Kneser-Ney takes plain counts for the longest n-grams and
    counts of continuations for all others, so that it has two of each. They stand side by side in one row for each
    n-gram, and models are picked out of these rows at the end: joins and groupings are as many as for one model.
    A null of `by` is a training set like others; a set without lines has no model.
    """
    if not set(methods) <= set(METHODS) or min(orders, default=0) < 1:
        raise ValueError((orders, methods))
    top = max(orders)
    key = ["g", "ord", "ngram"]
    # An array, as a null in it equals another.
    longest = rows.select(F.array(by if by else F.lit(0)).alias("g"), F.explode(_longest(top)).alias("ngram")).groupBy("g", "ngram").agg(F.count("*").alias("c"))
    counts = settle(longest.select("g", F.explode(_ends(F.col("ngram"))).alias("x"), "c").groupBy("g", "x.ord", "x.ngram").agg(F.sum("c").alias("c")).select(*key, "c"))
    before = counts.where("ord > 1").select("g", (F.col("ord") - 1).alias("ord"), _suffix(F.col("ngram")).alias("ngram")).groupBy(*key).agg(F.count("*").alias("t"))
    continued = F.when(F.col("ngram").startswith(START), F.col("c")).otherwise(F.coalesce("t", "c"))
    counts = settle(counts.join(_sorted(before), key, "left").select(*key, _context(F.col("ngram")).alias("h"), "c", continued.alias("k")))

    figures = counts.groupBy("g", "ord").agg(F.count("*").alias("n"), *(x.alias(f"{c}{i}") for c in "ck" for i, x in enumerate(_counts_of_counts(F.col(c)), 1)))
    figures = settle(figures)
    if figures.count() > GRID_FIGURES:
        raise ValueError("too many training sets for one grid")
    discounts = {(c, modified): _three_discounts([F.col(f"{c}{i}") for i in range(1, 5)], modified) for c in "ck" for modified in (False, True)}
    symbols_of = figures.where("ord = 1").select("g", (F.col("n") + 1).alias("v"))
    told = figures.select("g", "ord", *(d.alias(f"d_{c}_{m:d}_{i}") for (c, m), three in discounts.items() for i, d in enumerate(three, 1))).join(F.broadcast(symbols_of), "g")
    totals = counts.groupBy("g", "ord", "h").agg(F.sum("c").alias("ch"), F.sum("k").alias("kh"), F.count("*").alias("types"))
    joined = counts.join(_sorted(totals), ["g", "ord", "h"]).join(F.broadcast(told), ["g", "ord"])

    def discounted(c: str, modified: bool) -> Column:
        d = F.when(F.col(c) == 1, F.col(f"d_{c}_{modified:d}_1")).when(F.col(c) == 2, F.col(f"d_{c}_{modified:d}_2")).otherwise(F.col(f"d_{c}_{modified:d}_3"))
        return F.greatest(F.col(c) - d, F.lit(0.0)) / F.col(f"{c}h")

    # For each method the places of its probability below the highest order and at it.
    kinds, places = [], {}
    for m in methods:
        if m.endswith("kneser_ney"):
            places[m] = (len(kinds), len(kinds) + 1)
            kinds += [discounted("k", m.startswith("modified")), discounted("c", m.startswith("modified"))]
        else:
            places[m] = (len(kinds), len(kinds))
            kinds.append({"additive": (F.col("c") + 1) / (F.col("ch") + F.col("v")), "witten_bell": F.col("c") / (F.col("ch") + F.col("types")), "absolute": F.greatest(F.col("c") - 1, F.lit(0)) / F.col("ch")}[m])
    p, q, b = ([f"{x}{i}" for i in range(len(kinds))] for x in "pqb")
    inner = {i: pair[0] for pair in places.values() for i in pair}
    probs = settle(joined.select(*key, "h", *(F.when(x > 0, x).alias(p[i]) for i, x in enumerate(kinds))).where(F.coalesce(*p).isNotNull()))
    rest = (F.greatest(1 - F.coalesce(F.sum(x), F.lit(0.0)), F.lit(1e-12)).alias(x) for x in p)
    unknown = probs.where("ord = 1").groupBy("g").agg(*rest).select("g", F.lit(1).alias("ord"), F.lit(UNKNOWN).alias("ngram"), F.lit("").alias("h"), *p)
    # A method may leave no single symbol a probability: its `<unk>` has all of it.
    every = figures.where("ord = 1").select("g").join(unknown, "g", "left")
    unknown = every.select("g", F.lit(1).alias("ord"), F.lit(UNKNOWN).alias("ngram"), F.lit("").alias("h"), *(F.coalesce(x, F.lit(1.0)).alias(x) for x in p))
    probs = probs.unionByName(unknown)
    lower = probs.select("g", (F.col("ord") + 1).alias("ord"), F.col("ngram").alias("s"), *(F.col(p[i]).alias(q[i]) for i in sorted(set(inner.values()))))
    mass = probs.where("ord > 1").withColumn("s", _suffix(F.col("ngram"))).join(_sorted(lower), ["g", "ord", "s"], "left")
    sums = [x for i in range(len(p)) for x in (F.sum(p[i]).alias(f"sp{i}"), F.sum(F.when(F.col(p[i]).isNotNull(), F.coalesce(q[inner[i]], F.lit(0.0)))).alias(f"sq{i}"))]
    left = [(F.greatest(1 - F.col(f"sp{i}"), F.lit(1e-12)) / F.greatest(1 - F.col(f"sq{i}"), F.lit(1e-12))) for i in range(len(p))]
    bow = mass.groupBy("g", "ord", "h").agg(*sums).select("g", (F.col("ord") - 1).alias("ord"), F.col("h").alias("ngram"), *(F.when(F.col(f"sp{i}").isNotNull(), x).alias(b[i]) for i, x in enumerate(left)))
    wide = probs.drop("h").join(_sorted(bow), key, "full").select(*key, F.array(*p).alias("p"), F.array(*b).alias("b"))

    models = F.array(*(F.struct(F.lit(m).alias("method"), F.lit(n).alias("max_order"), F.lit(places[m][0]).alias("below"), F.lit(places[m][1]).alias("at")) for n in sorted(set(orders)) for m in methods))
    each = wide.select(*key, "p", "b", F.explode(F.filter(models, lambda x: x["max_order"] >= F.col("ord"))).alias("x")).select(*key, "p", "b", "x.*")
    longer = F.col("max_order") - F.col("ord")
    chosen = F.get("p", F.when(longer > 0, F.col("below")).otherwise(F.col("at")))
    weight = F.when(longer > 0, F.get("b", F.when(longer > 1, F.col("below")).otherwise(F.col("at"))))
    out = each.select("g", "method", "max_order", "ord", "ngram", F.log10(chosen).alias("logp"), weight.alias("weight")).where("logp is not null or weight is not null")
    out = out.withColumn("bow", F.log10(F.coalesce("weight", F.lit(1.0)))).drop("weight")
    return out.withColumn("g", F.get("g", F.lit(0))).withColumnRenamed("g", by) if by else out.drop("g")


def vocabulary_size(model: DataFrame) -> DataFrame:
    """(size): single symbols other than the line marks and `<unk>`."""
    return model.where((F.col("ord") == 1) & ~F.col("ngram").isin(START, END, UNKNOWN)).agg(F.count("*").alias("size"))


def highest_order(model: DataFrame) -> DataFrame:
    """(size): the length of the longest n-grams."""
    return model.agg(F.max("ord").cast("long").alias("size"))


def stored_size(model: DataFrame) -> DataFrame:
    """(bytes, size): how large the model is as ARPA text, in bytes and in words."""
    size = arpa_lines(model).agg(F.sum(F.octet_length("line") + 1).alias("bytes"))
    b = F.col("bytes").cast("double")
    unit = lambda n, name, digits=1: F.concat(F.round(b / 1024**n, digits).cast("string"), F.lit(f" {name}"))
    return size.select("bytes", F.when(b < 1024, unit(0, "b")).when(b < 1024**2, unit(1, "kb")).when(b < 1024**3, unit(2, "mb")).otherwise(unit(3, "gb", 2)).alias("size"))


def tuning_perplexity(clean_texts: DataFrame, dirty_texts: DataFrame, models: dict[str, tuple[DataFrame, DataFrame, int]]) -> DataFrame:
    """(classifier, ppl_clean, ppl_dirty, avg) for each (clean model, dirty model, order): either model on the texts of its kind."""
    rows = []
    for label, (clean, dirty, order) in models.items():
        both = perplexity(clean_texts, clean, order).select(F.col("ppl").alias("ppl_clean")).crossJoin(perplexity(dirty_texts, dirty, order).select(F.col("ppl").alias("ppl_dirty")))
        rows.append(both.select(F.lit(label).alias("classifier"), "ppl_clean", "ppl_dirty", ((F.col("ppl_clean") + F.col("ppl_dirty")) / 2).alias("avg")))
    return reduce(DataFrame.unionByName, rows)


def tuning_accuracy(scores: DataFrame) -> DataFrame:
    """(classifier, clean, acc_clean, dirty, acc_dirty) from (classifier, label_clean, score): how many texts there are of either label, and how many are right."""
    right = lambda clean: F.count_if((F.col("label_clean") == clean) & (F.col("score") > 0 if clean else F.col("score") < 0))
    counts = (F.count_if("label_clean").alias("clean"), right(True).alias("acc_clean"), F.count_if(~F.col("label_clean")).alias("dirty"), right(False).alias("acc_dirty"))
    return scores.groupBy("classifier").agg(*counts)


def sign_test_of(scores: DataFrame, target: str) -> DataFrame:
    """(classifier, differing, wins, p, mark) of `target` against every other classifier.

    `scores` has (classifier, key, label_clean, score), a row for each text and
    classifier; a tie is wrong. Only texts that one of the two gets right
    count, and `wins` are those that the target does.
    """
    right = F.when(F.col("label_clean"), F.col("score") > 0).otherwise(F.col("score") < 0)
    rows = scores.select("classifier", "key", F.coalesce(right, F.lit(False)).alias("right"))
    own = rows.where(F.col("classifier") == target).select("key", F.col("right").alias("own"))
    counts = rows.where(F.col("classifier") != target).join(own, "key").groupBy("classifier").agg(F.count_if(F.col("own") != F.col("right")).alias("differing"), F.count_if(F.col("own") & ~F.col("right")).alias("wins"))
    p = sign_test(F.col("wins"), F.col("differing"))
    return counts.withColumn("p", p).withColumn("mark", significance(F.col("p")))


def sign_test_by_position(target: DataFrame, other: DataFrame) -> DataFrame:
    """(differing, wins, p, mark) of two lists of outcomes (place, right) that have no key: line by line.

    What one list has more of than the other counts for nothing; null outcomes are wrong.
    """
    own = target.select("place", F.coalesce("right", F.lit(False)).alias("own"))
    rows = own.join(other.select("place", F.coalesce("right", F.lit(False)).alias("right")), "place")
    counts = rows.agg(F.count_if(F.col("own") != F.col("right")).alias("differing"), F.count_if(F.col("own") & ~F.col("right")).alias("wins"))
    p = sign_test(F.col("wins"), F.col("differing"))
    return counts.withColumn("p", p).withColumn("mark", significance(F.col("p")))


def arpa_lines(model: DataFrame) -> DataFrame:
    """(ord, place, line): the model in the ARPA text format, to be written in this order."""
    entry = F.concat(F.format_string("%.6f\t%s", F.coalesce("logp", F.lit(-99.0)), "ngram"), F.when(F.col("bow") != 0, F.format_string("\t%.6f", "bow")).otherwise(""))
    heads = model.groupBy("ord").agg(F.count("*").alias("n"))
    counts = heads.select(F.lit(0).alias("ord"), F.col("ord").cast("string").alias("place"), F.format_string("ngram %d=%d", "ord", "n").alias("line"))
    begin = heads.select("ord", F.lit("").alias("place"), F.format_string("\\%d-grams:", "ord").alias("line"))
    return counts.unionByName(begin).unionByName(model.select("ord", F.concat(F.lit(" "), "ngram").alias("place"), entry.alias("line")))


def parse_arpa(lines: DataFrame) -> DataFrame:
    """A model from the entry lines of an ARPA file (value)."""
    parts = F.split("value", "\t")
    rows = lines.where(F.col("value").rlike(r"^-?[0-9.]+\t")).select(parts.alias("x"))
    return rows.select(F.size(F.split(F.col("x")[1], " ")).alias("ord"), F.col("x")[1].alias("ngram"), F.col("x")[0].cast("double").alias("logp"), F.coalesce(F.get("x", F.lit(2)).cast("double"), F.lit(0.0)).alias("bow"))


def classifiers(paths: DataFrame) -> DataFrame:
    """(label, kind, order, path) from paths of models named `clean_<label>_<n>gram_…` and `dirty_…`."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    kind = F.regexp_extract(name, r"^(clean|dirty)_", 1)
    label = F.regexp_replace(F.regexp_replace(name, r"^(clean|dirty)_", ""), r"\.lm(\.gz)?$", "")
    return paths.where(name.rlike(r"^(clean|dirty)_.*\d+gram_")).select(label.alias("label"), kind.alias("kind"), F.regexp_extract(name, r"_(\d+)gram_", 1).cast("int").alias("order"), "path")
