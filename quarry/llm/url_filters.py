"""URL filters: sort-merge range join of urls with nested prefix rules.

A rule is a host, with all its subdomains, and a prefix of the path. The
canonical key of a place is its host's labels in reverse order, a slash, and
its path: `com.example/` + `/en/7`. Everything under a rule has a key that
starts with the rule's key, so that a rule is an interval of the sorted keys,
and two rules' intervals are nested or disjoint. A url is looked up under its host's
domain suffixes, because a rule of `com` also holds for `example.com` with a
path of its own; only those with as many labels as some rule's host can have one.

Rules and urls are dealt into ranges of keys; a rule goes to each range that
its interval meets. Each range is sorted once and swept with a stack of the
rules that are open at the current key; the innermost open rule fits.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import ascii_lower, join_hot, partitions

#: Above every key that starts with a given prefix: no UTF-8 text has this byte.
TOP = b"\xff"
SAMPLE_PER_RANGE = 50


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z in lower case;
    empty for null and for a url without `://`."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty as url_host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), ".")


def _suffix_keys(host: Column, path: Column, sizes: list[int]) -> Column:
    """The keys of a place under those suffixes of its host that have as many labels as some rule's host."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    fit = F.filter(F.array(*map(F.lit, sizes)).cast("array<int>"), lambda k: k <= n)
    return F.transform(fit, lambda k: F.concat(_reversed(F.slice(labels, n - k + 1, k)), F.lit("/"), path))


def _dealer(bounds: list[bytes], schema: pa.Schema):
    """Give each row the number of its range; a rule (kind 0) goes to every range from its key to the end of its interval."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {"part": [], **{c: [] for c in b.schema.names}}
            columns = [b.column(i).to_pylist() for i in range(b.num_columns)]
            at, kind = b.schema.names.index("key"), b.schema.names.index("kind")
            for row in zip(*columns):
                key = row[at].encode()
                low = bisect_right(bounds, key)
                high = low if row[kind] else bisect_right(bounds, key + TOP)
                for p in range(low, high + 1):
                    rows["part"].append(p)
                    for c, v in zip(b.schema.names, row):
                        rows[c].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    return deal


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by range and key, rules before urls of the same key:
    keep the stack of open rules and give each url the innermost one."""
    stack: list[tuple[str, str, str]] = []
    part = None
    for b in batches:
        host, path, rule, verdict = [], [], [], []
        for p, key, kind, h, u, r, v in zip(*(b.column(c).to_pylist() for c in ("part", "key", "kind", "host", "path", "rule", "verdict"))):
            if p != part:
                part, stack = p, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                stack.append((key, r, v))
            elif stack:
                host.append(h)
                path.append(u)
                rule.append(stack[-1][1])
                verdict.append(stack[-1][2])
        yield pa.RecordBatch.from_pydict({"host": host, "path": path, "rule": rule, "verdict": verdict}, schema=pa.schema([(c, pa.string()) for c in ("host", "path", "rule", "verdict")]))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row's url: (id, host, path, rule, verdict).

    `rules` has host, path and verdict. The longest fitting rule wins (by the
    length of host and path together, then of the host, then `block` before
    other verdicts). Repeated rules count once. A rule with a null column is
    ignored. Urls that no rule fits get null and `default`. One row comes out
    for each row of `pages`: null ids and repeated rows are kept, a null url
    has an empty host and path. Other columns are not read.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(id_col).alias("_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rules = rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").na.drop().groupBy("host", "path").agg(F.min(F.struct(F.col("verdict") != "block", "verdict"))["verdict"].alias("verdict"))
    # k different numbers of labels take k * k / 2 labels of rules at least.
    sizes = sorted(r[0] for r in rules.select(F.size(F.split("host", r"\.", -1))).distinct().collect())
    places = urls.select("host", "path").distinct()
    nothing = F.lit(None).cast("string")
    places = places.select(F.explode(_suffix_keys(F.col("host"), F.col("path"), sizes)).alias("key"), F.lit(1).alias("kind"), "host", "path", nothing.alias("rule"), nothing.alias("verdict"))
    rules = rules.select(F.concat(_reversed(F.split("host", r"\.", -1)), F.lit("/"), "path").alias("key"), F.lit(0).alias("kind"), "host", "path", F.concat("host", "path").alias("rule"), "verdict")

    # Split points only balance the ranges; a fixed number of keys of low hash serves.
    n = partitions(spark)
    sample = sorted(r[0].encode() for r in places.select("key").orderBy(F.xxhash64("key", "host")).limit(SAMPLE_PER_RANGE * n).collect())
    bounds = sorted({sample[i * len(sample) // n] for i in range(1, n)}) if sample else []
    kinds = [("part", pa.int32()), ("key", pa.string()), ("kind", pa.int32()), *((c, pa.string()) for c in ("host", "path", "rule", "verdict"))]
    dealt = places.unionByName(rules).mapInArrow(_dealer(bounds, pa.schema(kinds)), "part int, key string, kind int, host string, path string, rule string, verdict string")
    found = dealt.repartitionById(n, "part").sortWithinPartitions("part", "key", "kind").mapInArrow(_sweep, "host string, path string, rule string, verdict string")
    best = found.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), F.coalesce(F.instr("rule", "/"), F.lit(0)).alias("h"), "rule", "verdict")).alias("best"))
    best = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("_verdict"))
    # A url that very many rows have, or null, isn't gathered in one task.
    out = join_hot(urls, best, ["host", "path"])
    return out.select(F.col("_id").alias(id_col), "host", "path", "rule", F.coalesce("_verdict", F.lit(default)).alias("verdict"))
